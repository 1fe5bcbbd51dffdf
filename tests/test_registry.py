"""Registered queries against their SQL twins on the smallest test tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from checks import registry
from run_checks import rows_of

DATA = "/root/testdata/sf0.001"
# One of each kind; run_checks.py runs them all.
SAMPLE = [
    "silver_loan_table", "silver_attributes_table", "silver_financials_table", "sequence_in_key", "gold_feature_table", "training_set",
    "rate_by_month", "five_number_balance", "rule_check", "bad_zero_flag", "clean_weather", "target_encode_stack", "label_encode",
    "auc_gini", "final_blend", "ingest_snapshot", "stream_snapshots",
]


def test_names():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert set(registry.QUERIES) <= set(queries)
    assert set(registry.QUERIES) - set(registry.SQL) == {
        "approximate_profile", "classify", "pick_one", "sample_rows", "stratified_split",
    }


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
@pytest.mark.parametrize("name", SAMPLE)
def test_twin(spark, database, name):
    df = entry.queries()[name](spark, DATA)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = database.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows_of(names, cursor.fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
