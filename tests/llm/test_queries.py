"""The registered corpus queries against their SQL twins on the smallest test tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from run_checks import rows_of

DATA = "/root/testdata/sf0.001"
TWINS = ["op1_mixing", "op4_exact_dedup", "op5_url_filter", "op8_jaccard_join", "op10_embedding_dedup", "op11_hard_negatives", "op12_quality"]


def test_every_operator_is_registered_once():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(TWINS) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
@pytest.mark.parametrize("name", TWINS)
def test_twin(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = entry.queries()[name](spark, DATA)
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())
