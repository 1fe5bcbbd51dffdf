"""Incremental backfill: new snapshot files become partitions, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerline.sources.files import SNAPSHOT


def stream_snapshots(spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str) -> StreamingQuery:
    """Take all files not seen before, append their rows to their snapshot's partition, then stop.

    The checkpoint remembers the files read, and the file sink commits a batch as a whole, so a run that
    is cut short and started again neither loses nor repeats rows.
    """
    rows: DataFrame = spark.readStream.schema(schema).option("header", True).csv(source)
    return (
        rows.writeStream.format("parquet")
        .partitionBy(SNAPSHOT)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
