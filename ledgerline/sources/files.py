"""Bronze ingest, layer tables, snapshot partitions, stage tables and prediction files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.cleaning import DATE_FORMATS, parse_date
from ledgerline.session import lean_writes, pin

SNAPSHOT = "snapshot_date"
CORRUPT = "_corrupt_record"


class EmptySourceError(ValueError):
    """A source has no rows."""


# ---------------------------------------------------------------- bronze


def read_bronze_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header row and a declared schema, so the file is read once.

    Columns are matched by the header: a file that has them in another order is refused by Spark rather than read
    into the wrong columns. Rows that don't fit keep their text in ``_corrupt_record`` where the schema names it.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def with_corrupt(schema: str) -> str:
    """The schema with a column that keeps the text of rows that don't fit."""
    return f"{schema}, {CORRUPT} string"


def parse_dates(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: parse_date(F.col(c), formats) for c in present}) if present else df


def add_ingest_metadata(df: DataFrame, source: str | None = None) -> DataFrame:
    """Ingest time and source file; without a name the file each row came from is taken from its metadata."""
    name: Column = F.lit(source) if source else F.col("_metadata.file_name")
    return df.select("*", F.current_timestamp().alias("bronze_ingest_timestamp"), name.alias("bronze_source_file"))


def metadata_stamp(df: DataFrame, column: str = "silver_process_timestamp") -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def require_non_empty(df: DataFrame, source: str) -> DataFrame:
    """Raise when there is no row; reads at most one."""
    if df.isEmpty():
        raise EmptySourceError(f"{source} has no rows")
    return df


def ingest_bronze(
    spark: SparkSession, path: str, schema: StructType | str, source: str, date_columns: Sequence[str] = ()
) -> DataFrame:
    raw = require_non_empty(read_bronze_csv(spark, path, schema), source)
    return add_ingest_metadata(parse_dates(raw, date_columns), path.rstrip("/").rsplit("/", 1)[-1])


# ---------------------------------------------------------------- layers and snapshots


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{layer}_{table}"


def write_layer(df: DataFrame, root: str, layer: str, table: str) -> str:
    """Overwrite one Parquet table of a layer."""
    path = layer_path(root, layer, table)
    df.write.mode("overwrite").parquet(path)
    return path


def read_layer(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(layer_path(root, layer, table))


def month_starts(spark: SparkSession, start: date, end: date) -> DataFrame:
    """First days of the months from that of ``start`` up to ``end``."""
    months = F.sequence(F.trunc(F.lit(start), "month"), F.lit(end), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias(SNAPSHOT))


def ingest_snapshots(df: DataFrame, path: str, day: str = SNAPSHOT, laid_out: bool = False) -> str:
    """Write every snapshot present in ``df`` to its own partition; a re-run replaces those partitions only.

    Adaptive execution splits a snapshot with most of the rows by its size and merges small ones, so a
    snapshot is written by as many tasks as it needs. Rows read from a table that is partitioned in the same way
    are ``laid_out``: the files that a task reads hold few snapshots each, so they are written without a shuffle.
    The shuffle carries all rows; its files go when the snapshots are written, and rows aren't sorted by snapshot.
    """
    spread = df if laid_out else df.hint("rebalance", day)
    with lean_writes(df.sparkSession):
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    return path


def ingest_snapshot(df: DataFrame, snapshot: date, path: str, day: str = SNAPSHOT) -> str:
    """Keep one snapshot and write it; one that the source no longer has is removed from the target."""
    rows = df.where(F.col(day) == F.lit(snapshot))
    if rows.isEmpty():
        drop_partition(df.sparkSession, path, day, snapshot)
        return path
    return ingest_snapshots(rows, path, day)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, on whatever file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def drop_partition(spark: SparkSession, path: str, day: str, snapshot: date | None) -> None:
    """Remove one snapshot's folder, on whatever file system it lies."""
    name = snapshot.isoformat() if snapshot else "__HIVE_DEFAULT_PARTITION__"
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{day}={name}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """All snapshots as one table; filters on the snapshot prune partitions."""
    return spark.read.parquet(path)


# ---------------------------------------------------------------- stages and outputs


def write_predictions(df: DataFrame, path: str, key: str = "row_id", value: str = "meter_reading") -> str:
    """CSV with a header, values to four decimals."""
    df.select(key, F.format_string("%.4f", F.col(value)).alias(value)).write.mode("overwrite").option("header", True).csv(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a stage table to the shared folder and continue from the copy."""
    return pin(df, name)


def load_named(spark: SparkSession, registry: Mapping[str, str], name: str) -> DataFrame:
    """A table by its logical name; the format follows from the file ending. Column types of a CSV file are inferred."""
    if name not in registry:
        raise KeyError(f"unknown table {name!r}; known: {sorted(registry)}")
    path = registry[name]
    if path.endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.parquet(path)
