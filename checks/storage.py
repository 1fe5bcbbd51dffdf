"""Round trips through files in the shared folder."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

import checks.credit  # noqa: F401  (defines the label views)
from checks.helpers import rounded
from checks.registry import query
from checks.views_sql import using
from ledgerline.plans import credit, layers
from ledgerline.session import lean_writes, stage_path
from ledgerline.sources import files, views
from ledgerline.streaming.snapshots import stream_snapshots

_LEDGER_ROUNDED = "SELECT * REPLACE (round(overdue_amt, 4) AS overdue_amt, round(balance, 4) AS balance) FROM ledger"


@query(
    "read_bronze_csv",
    """SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment, round(c_acctbal, 2) AS balance, TRUE AS stamped FROM customer""",
)
def read_bronze_csv(spark, sf):
    path = stage_path(spark, "customer.csv")
    rows = views.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    rows.write.option("header", True).csv(path)
    bronze = files.ingest_bronze(spark, path, "customer_id bigint, name string, segment string, balance double", "customer")
    stamped = F.col("bronze_ingest_timestamp").isNotNull() & (F.col("bronze_source_file") == path.rsplit("/", 1)[-1])
    return bronze.select("customer_id", "name", "segment", "balance", stamped.alias("stamped"))


@query(
    "month_starts",
    """SELECT CAST(unnest(generate_series(DATE '1995-01-01', (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 MONTH)) AS DATE) AS snapshot_date""",
)
def month_starts(spark, sf):
    """Calendar up to the last order."""
    last = views.table(spark, sf, "orders").agg(F.max(F.to_date("o_orderdate"))).first()[0]
    return files.month_starts(spark, date(1995, 1, 15), last)


@query(
    "ingest_snapshot",
    using("ledger", "SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS snapshot_date, loan_id, installment_num FROM ledger"),
)
def ingest_snapshot(spark, sf):
    """All monthly snapshots; one is written twice and stays single, and one that the source lost is removed."""
    path = stage_path(spark, "snapshots")
    rows = views.ledger(spark, sf).select(
        F.trunc("snapshot_date", "month").alias("snapshot_date"), "loan_id", "installment_num"
    )
    lost = rows.limit(1).withColumn("snapshot_date", F.lit(date(1990, 1, 1)))
    files.ingest_snapshots(rows.unionByName(lost), path)
    files.ingest_snapshot(rows, date(1997, 2, 1), path)
    files.ingest_snapshot(rows, date(1990, 1, 1), path)
    return files.read_partitions(spark, path)


@query(
    "read_partitions",
    using("labels_store", "SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS snapshot_month, count(*) AS row_count, CAST(sum(label) AS BIGINT) AS bad FROM label_rows GROUP BY 1"),
)
def read_partitions(spark, sf):
    """The label store written by month and read back as one table."""
    path = stage_path(spark, "label-store")
    labels = credit.label_store(views.ledger(spark, sf)).withColumn("snapshot_month", F.trunc("snapshot_date", "month"))
    files.ingest_snapshots(labels, path, "snapshot_month")
    return files.read_partitions(spark, path).groupBy("snapshot_month").agg(
        F.count("*").alias("row_count"), F.sum("label").alias("bad")
    )


@query("write_layer", using("ledger", _LEDGER_ROUNDED))
def write_layer(spark, sf):
    root = stage_path(spark, "lake")
    files.write_layer(views.ledger(spark, sf), root, "silver", "loan")
    return rounded(files.read_layer(spark, root, "silver", "loan"), 4, ["overdue_amt", "balance"])


@query("write_predictions", using("predictions", "SELECT row_id, round(pred0, 4) AS meter_reading FROM predictions"))
def write_predictions(spark, sf):
    path = stage_path(spark, "predictions")
    files.write_predictions(views.predictions(spark, sf).select("row_id", F.col("pred0").alias("meter_reading")), path)
    return files.read_bronze_csv(spark, path, "row_id bigint, meter_reading double")


@query("materialize", using("readings", "SELECT building_id, meter, timestamp, meter_reading FROM readings"))
def materialize(spark, sf):
    return files.materialize(views.readings(spark, sf), "readings")


@query("load_named", "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, 'parquet' AS kind FROM orders UNION ALL SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE), 'csv' FROM orders")
def load_named(spark, sf):
    """The same orders by a Parquet and by a CSV name; the CSV columns come back with their types."""
    path = f"{stage_path(spark, 'named')}.csv"
    views.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate")).write.option("header", True).csv(path)
    names = {"stored": f"{sf}/orders.parquet", "listed": path}
    stored = files.load_named(spark, names, "stored").select(F.col("o_orderkey"), "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), F.lit("parquet").alias("kind"))
    listed = files.load_named(spark, names, "listed")
    cast = [F.col(c).cast(stored.schema[c].dataType).alias(c) for c in listed.columns if listed.schema[c].dataType.typeName() != "string"]
    return stored.unionByName(listed.select(*cast, F.lit("csv").alias("kind")))


@query(
    "metadata_stamp",
    using("silver_attributes", "SELECT customer_id, TRUE AS stamped FROM silver_attributes"),
)
def metadata_stamp(spark, sf):
    stamped = files.metadata_stamp(credit.silver_attributes(spark, sf))
    return stamped.select("customer_id", F.col("silver_process_timestamp").isNotNull().alias("stamped"))


@query(
    "require_non_empty",
    "SELECT l_returnflag, count(*) AS row_count, TRUE AS emptied_raises FROM lineitem GROUP BY 1",
)
def require_non_empty(spark, sf):
    """Every group of the table passes as it is; emptied, each is refused."""
    lines = views.table(spark, sf, "lineitem")
    counted = files.require_non_empty(lines, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("row_count"))
    try:
        files.require_non_empty(lines.where("l_quantity < 0"), "lineitem")
        refused = False
    except files.EmptySourceError:
        refused = True
    return counted.withColumn("emptied_raises", F.lit(refused))


@query(
    "stream_snapshots",
    using("ledger", "SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS snapshot_date, count(*) AS row_count FROM ledger GROUP BY 1"),
)
def streamed(spark, sf):
    """Files of all years arrive in two batches; each is taken once."""
    landing, target, marks = (stage_path(spark, n) for n in ("landing", "streamed", "marks"))
    rows = views.ledger(spark, sf).select(F.trunc("snapshot_date", "month").alias("snapshot_date"), "loan_id", "installment_num")
    for early in (True, False):
        rows.where((F.year("snapshot_date") < 1997) == early).write.mode("append").option("header", True).csv(landing)
        schema = "snapshot_date date, loan_id bigint, installment_num int"
        stream_snapshots(spark, landing, schema, target, marks).awaitTermination()
    return files.read_partitions(spark, target).groupBy("snapshot_date").agg(F.count("*").alias("row_count"))




def _raw(spark, sf, name: str):
    """A raw table, columns in the order of its schema."""
    view = {"loan_daily": views.ledger, "attributes": views.attributes, "financials": views.financials, "clickstream": views.clicks}[name]
    return view(spark, sf).select(*[c.split()[0] for c in layers.SCHEMAS[name].split(", ")])


def _write_sources(spark, sf, names=layers.TABLES) -> str:
    """The raw tables (all four, or the named ones) as CSV."""
    folder = stage_path(spark, "raw")
    for name in names:
        _raw(spark, sf, name).write.option("header", True).csv(f"{folder}/{name}.csv")
    return folder


@query(
    "layer_run",
    using("gold", "SELECT CAST(customer_id AS VARCHAR) AS customer_id, has_defaulted, default_risk_score, has_clickstream_data FROM gold"),
)
def layer_run(spark, sf):
    """Bronze, silver and gold over files; silver attributes are run twice, a table of its own leaves gold alone."""
    root, source = stage_path(spark, "lake"), _write_sources(spark, sf)
    layers.run(spark, root, source)
    layers.run(spark, root, source, "all", "attributes")
    return files.read_layer(spark, root, "gold", "labels").select("customer_id", "has_defaulted", "default_risk_score", "has_clickstream_data")


@query(
    "label_store_backfill",
    using("labels_store", "SELECT loan_id, customer_id, label, label_def, snapshot_date, CAST(date_trunc('month', snapshot_date) AS DATE) AS snapshot_month FROM label_rows"),
)
def label_store_backfill(spark, sf):
    """All months from a ledger file, then one month again: the store stays the same."""
    root, source = stage_path(spark, "store"), f"{_write_sources(spark, sf, layers.SELECTIONS['loan'])}/loan_daily.csv"
    layers.backfill_labels(spark, root, source)
    return files.read_partitions(spark, layers.backfill_labels(spark, root, source, [date(1997, 2, 1)]))


@query(
    "backfill_manifest",
    using(
        "labels_store",
        """WITH months AS (SELECT count(DISTINCT date_trunc('month', snapshot_date)) AS n FROM ledger)
           SELECT run, CASE run WHEN 1 THEN n WHEN 2 THEN 0 ELSE 1 END::BIGINT AS months_made, CASE run WHEN 4 THEN n - 1 ELSE n END::BIGINT AS months_held
           FROM months, (SELECT unnest([1, 2, 3, 4]) AS run)""",
    ),
)
def backfill_manifest(spark, sf):
    """A first run, a second one that finds nothing to do, one month with a changed row, and one month less.

    The rows that all ledgers have are written once, in a folder of their own, and the files are compressed: three full
    ledgers as plain text would take most of the disk. A run reads all folders of its ledger.
    """
    root, raw = stage_path(spark, "manifest"), stage_path(spark, "raw")
    ledger = _raw(spark, sf, "loan_daily")
    month = F.col("snapshot_date").cast("string").startswith("1997-02")
    # Rows without a day go with the changed month: the last ledger is without them as well.
    parts = ledger.withColumn("loan_daily", F.when(~month, "kept").otherwise("first"))
    with lean_writes(spark):
        parts.write.partitionBy("loan_daily").options(header=True, compression="gzip").csv(raw)
    first = spark.read.option("header", True).csv(raw).where("loan_daily = 'first'").drop("loan_daily")
    changed = first.withColumn("paid_amt", F.when(month, "0.5").otherwise(F.col("paid_amt")))
    changed.write.options(header=True, compression="gzip").csv(f"{raw}/loan_daily=changed")
    told, seen = [], 0
    for run, held_in in enumerate(("{kept,first}", "{kept,first}", "{kept,changed}", "kept"), 1):
        path = f"{raw}/loan_daily={held_in}"
        layers.backfill_labels(spark, root, path)
        entries = spark.read.parquet(f"{root}/manifest/label_store")
        count = entries.count()
        held = layers.read_manifest(spark, f"{root}/manifest/label_store").where("row_count > 0").count()
        told.append((run, count - seen, held))
        seen = count
    return spark.createDataFrame(told, "run int, months_made bigint, months_held bigint")
