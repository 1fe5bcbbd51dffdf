"""Bronze to silver to gold over files, by layer and table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import behaviour, customers, lending
from ledgerline.operators.scans import split_hot
from ledgerline.plans.credit import LEDGER_TYPES, gold_features
from ledgerline.sources import files
from ledgerline.sources.views import FEATURES

LAYERS = ("bronze", "silver", "gold")
TABLES = ("loan_daily", "attributes", "financials", "clickstream")
SELECTIONS = {"all": TABLES, "loan": TABLES[:1], "features": TABLES[1:]}

# Columns of the raw files; dirty text stays text.
SCHEMAS: Mapping[str, str] = {
    "loan_daily": "loan_id string, customer_id string, loan_start_date string, tenure int, installment_num int, loan_amt double,"
    " due_amt double, paid_amt double, overdue_amt double, balance double, snapshot_date string",
    "attributes": "customer_id string, name string, age string, ssn string, occupation string, snapshot_date string",
    "financials": "customer_id string, annual_income string, monthly_inhand_salary double, num_bank_accounts int, num_credit_card int,"
    " interest_rate int, num_of_loan string, type_of_loan string, delay_from_due_date int, num_of_delayed_payment string,"
    " changed_credit_limit string, num_credit_inquiries double, credit_mix string, outstanding_debt string,"
    " credit_utilization_ratio double, credit_history_age string, payment_of_min_amount string, total_emi_per_month double,"
    " amount_invested_monthly string, payment_behaviour string, monthly_balance string, snapshot_date string",
    "clickstream": ", ".join(f"{f} double" for f in FEATURES) + ", customer_id string, snapshot_date string",
}
DATE_COLUMNS = {"loan_daily": ["loan_start_date", "snapshot_date"]}


def _silver_loan(bronze: DataFrame) -> DataFrame:
    return split_hot(bronze, ["loan_id"], lending.by_installment(bronze), lending.silver_ledger)


def _silver_clicks(bronze: DataFrame) -> DataFrame:
    # Rows of one day have no order of their own; their values make it total.
    return behaviour.clickstream_detail(bronze, FEATURES, FEATURES)


SILVER: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "loan_daily": _silver_loan,
    "attributes": customers.silver_attributes,
    "financials": customers.silver_financials,
    "clickstream": _silver_clicks,
}


def _bronze(spark: SparkSession, root: str, source: str, table: str) -> None:
    dates = DATE_COLUMNS.get(table, ["snapshot_date"])
    path = f"{source.rstrip('/')}/{table}.csv"
    files.write_layer(files.ingest_bronze(spark, path, SCHEMAS[table], table, dates), root, "bronze", table)


def _silver(spark: SparkSession, root: str, table: str) -> None:
    made = SILVER[table](files.read_layer(spark, root, "bronze", table))
    files.write_layer(files.metadata_stamp(made), root, "silver", table)
    if table == "clickstream":
        # Aggregate the written detail instead of computing it twice.
        detail = files.read_layer(spark, root, "silver", table)
        aggregated = behaviour.feature_aggregates(detail, FEATURES)
        files.write_layer(files.metadata_stamp(aggregated), root, "silver", "clickstream_aggregated")


def _gold(spark: SparkSession, root: str) -> None:
    names = ("loan_daily", "attributes", "financials", "clickstream_aggregated")
    gold = gold_features(*[files.read_layer(spark, root, "silver", n) for n in names])
    files.write_layer(files.metadata_stamp(gold, "gold_process_timestamp"), root, "gold", "features")
    written = files.read_layer(spark, root, "gold", "features")
    files.write_layer(customers.label_table(written, ["gold_process_timestamp"]), root, "gold", "labels")


def run(spark: SparkSession, root: str, source: str, layer: str = "all", table: str = "all") -> None:
    """Run the selected layers (in order) for the selected tables.

    ``table`` is one table, ``loan`` (the ledger), ``features`` (the three customer tables) or ``all``. Gold needs
    every silver table, so it runs for ``all`` and ``features`` only and is left alone for the others.
    """
    if layer not in (*LAYERS, "all") or table not in (*TABLES, *SELECTIONS):
        raise ValueError(f"unknown layer or table: {layer}, {table}")
    tables = SELECTIONS.get(table, (table,))
    for step in LAYERS if layer == "all" else (layer,):
        if step == "gold":
            if table in ("all", "features"):
                _gold(spark, root)
            continue
        for name in tables:
            if step == "bronze":
                _bronze(spark, root, source, name)
            else:
                _silver(spark, root, name)


# ---------------------------------------------------------------- label store

MONTH = "snapshot_month"


MANIFEST = "snapshot_month date, row_count bigint, mark decimal(38,0), run bigint"


def _in_months(rows: DataFrame, months: Sequence[date | None] | None) -> DataFrame:
    if months is None:
        return rows
    known = F.col(MONTH).isin(*[F.lit(m) for m in months if m is not None])
    return rows.where(F.coalesce(known, F.lit(None in months)))


def fingerprints(rows: DataFrame, columns: Sequence[str], *settings) -> DataFrame:
    """Rows and a mark of every month: a sum of row hashes, which doesn't depend on their order."""
    mark = F.xxhash64(*[F.lit(x) for x in settings], *[F.col(c) for c in columns]).cast("decimal(38,0)")
    return rows.groupBy(MONTH).agg(F.count(F.lit(1)).alias("row_count"), F.sum(mark).alias("mark"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The latest entry of every month; empty before the first run."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    entry = F.max_by(F.struct("row_count", "mark"), "run").alias("entry")
    return spark.read.schema(MANIFEST).parquet(path).groupBy(MONTH).agg(entry, F.max("run").alias("run")).select(MONTH, "entry.*", "run")


def backfill_labels(
    spark: SparkSession, root: str, source: str, months: Sequence[date] | None = None, dpd: int = 30, mob: int = 6
) -> str:
    """Ledger file to bronze, silver and gold label partitions, one per month; returns the path of the label store.

    A manifest beside the layers has a fingerprint of every month's rows and of the settings. Without ``months`` only
    months whose fingerprint has changed are made, by one job per layer, and months that the source no longer has are
    removed; a repeated run writes nothing. Months that are given are made in any case. A partition is swapped in when
    all of it is written, and its month is noted after that, so a run that broke off is made good by the next.
    """
    paths = {layer: files.layer_path(root, layer, "label_store") for layer in LAYERS}
    manifest = f"{root.rstrip('/')}/manifest/label_store"
    raw = files.ingest_bronze(spark, source, SCHEMAS["loan_daily"], "loan_daily", DATE_COLUMNS["loan_daily"])
    bronze = raw.withColumn(MONTH, F.trunc("snapshot_date", "month"))
    columns = [c.split()[0] for c in SCHEMAS["loan_daily"].split(", ")]
    known = read_manifest(spark, manifest)
    now = fingerprints(_in_months(bronze, months), columns, dpd, mob)
    before = known.select(F.col(MONTH).alias("_month"), F.col("row_count").alias("_rows"), F.col("mark").alias("_mark"))
    both = now.join(before, F.col(MONTH).eqNullSafe(F.col("_month")), "left" if months else "full")
    if months is None:
        both = both.where(~(F.col("row_count").eqNullSafe(F.col("_rows")) & F.col("mark").eqNullSafe(F.col("_mark"))))
        both = both.where(F.col("row_count").isNotNull() | (F.col("_rows") > 0))
    found = both.collect()  # one row per month
    gone = [r["_month"] for r in found if r["row_count"] is None]
    made = [r for r in found if r["row_count"] is not None]
    for month in gone:
        for path in paths.values():
            files.drop_partition(spark, path, MONTH, month)
    if made:
        chosen = [r[MONTH] for r in made]
        files.ingest_snapshots(_in_months(bronze, chosen), paths["bronze"], MONTH)
        typed = customers.enforce_types(_in_months(files.read_partitions(spark, paths["bronze"]), chosen), LEDGER_TYPES)
        files.ingest_snapshots(files.metadata_stamp(lending.days_past_due(typed)), paths["silver"], MONTH, laid_out=True)
        labels = lending.dpd_label(_in_months(files.read_partitions(spark, paths["silver"]), chosen), dpd, mob)
        files.ingest_snapshots(labels.withColumn(MONTH, F.trunc("snapshot_date", "month")), paths["gold"], MONTH)
    if found:
        run = 1 + (known.agg(F.max("run")).first()[0] or 0)
        entries = [(r[MONTH], r["row_count"], r["mark"], run) for r in made] + [(m, 0, None, run) for m in gone]
        spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(manifest)
    return paths["gold"]
