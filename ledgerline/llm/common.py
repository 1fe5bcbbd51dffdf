"""Small helpers that several operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column has it."""
    while name in df.columns:
        name += "_"
    return name


def held_out(doc_id: str | Column) -> Column:
    """True for the fifth of the documents that nothing is learned from."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5 == 0


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hash of ``key``: a repeatable sample of bounded size.

    A first cut by the hash leaves about twice as many rows, however many the table has, so that few are sorted and
    sent on.
    """
    steps = 1 << 30
    cut = min(steps, (2 * rows + 64) * steps // max(df.count(), 1) + 1)
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(steps))
    return df.where(place < cut).orderBy(place, F.col(key)).limit(rows)


def partitions_for(spark: SparkSession, wanted: int = 0) -> int:
    """Partitions of a shuffle that Python tasks read: the session's number, or more if ``wanted``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession, rows: int | None = 1_000) -> None:
    """Send this many whole texts to a Python task at a time from now on; None goes back to the session's own number.

    By default ten thousand rows travel together, whatever their length.
    """
    spark.conf.unset(ARROW_ROWS)
    if rows and not 0 < int(spark.conf.get(ARROW_ROWS)) <= rows:
        spark.conf.set(ARROW_ROWS, str(rows))


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``key``.

    At most one group and ``rows`` rows (or one batch) are held at a time, however many groups a task has.
    """
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        held += batch.num_rows
        if held < rows:
            continue
        whole = pa.Table.from_batches(waiting)
        keys = whole.column(key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1], side="left"))
        if last:
            yield whole.slice(0, last)
        waiting = whole.slice(last).combine_chunks().to_batches()
        held = whole.num_rows - last
    if waiting:
        yield pa.Table.from_batches(waiting)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]
