"""The corpus job: toxicity, exact copies, near copies, mixing, packing.

``STAGES`` lists (name, function) pairs. A function takes (spark, docs, sf_dir) and returns what it keeps; the result is
written as Parquet and read again as the docs of the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import exact, jaccard, mixing, packing, toxicity
from ledgerline.llm.common import table, text_batches
from ledgerline.session import pin


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity model rejects.

    Null and empty texts score by the model's bias alone and stay, texts of any length are read whole, equal texts are
    judged alike, an empty table stays empty, and all columns are kept under their names.
    """
    text_batches(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the largest doc_id of equal texts.

    Null counts as empty; rows that share text and doc_id stay together. Texts are compared whole, all columns are kept.
    """
    text_batches(spark, None)
    return exact.drop_exact(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of documents that links of similarity 0.8 and more connect.

    Texts without words link with nothing and stay. All columns are kept.
    """
    text_batches(spark, None)
    return jaccard.drop_near(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents so that tokens meet the target shares of sources, languages and topics.

    Null sources and languages are one value of their own; texts without words go with the cell they are in. The draw
    follows from the doc_id. All columns are kept.
    """
    return mixing.sample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of ids whose lengths are powers of two; null and empty texts are one end id."""
    text_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("jaccard_join", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: The stages learn models and search by hashes; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
