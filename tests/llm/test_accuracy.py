"""Held-out accuracy of the two classifiers on the given tables."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

DATA = "/root/testdata"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


def test_language_of_held_out_documents(spark):
    found = entry.queries()["op6_language"](spark, f"{DATA}/sf0.01").where("held_out")
    known = found.join(spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("lang IS NOT NULL")
    n, right = known.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 150 and right >= 0.97 * n


def test_toxicity_of_held_out_documents(spark):
    found = entry.queries()["op9_toxicity"](spark, f"{DATA}/sf0.1").where("held_out")
    rows = found.join(spark.read.parquet(f"{DATA}/sf0.1/labels.parquet"), "doc_id").where("toxic IS NOT NULL").select("score", "predicted", "toxic").collect()
    toxic, clean = (np.array([r.score for r in rows if r.toxic == k]) for k in (1, 0))
    auc = (toxic[:, None] > clean).mean() + 0.5 * (toxic[:, None] == clean).mean()
    assert len(toxic) > 50 and auc > 0.95
    assert (toxic >= 0.5).mean() > 0.85 and (clean >= 0.5).mean() < 0.02
