"""Session construction and the shared staging folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
SHIPPED_KEY = "ledgerline.shipped"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
OPEN_FILES_KEY = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 100


def build_session(app_name: str = "ledgerline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and no web page."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # Python call sites are only for error messages, and cost a round trip per expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per session: they may be started where it can't be imported."""
    if spark.conf.get(SHIPPED_KEY, None):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="ledgerline-package-"), "ledgerline"), "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    spark.conf.set(SHIPPED_KEY, "true")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; a cluster without the setting is an
    error, since a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set(CHECKPOINT_KEY, folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/ledgerline/{name}-{uuid.uuid4().hex}"


@contextmanager
def lean_writes(spark: SparkSession) -> Iterator[None]:
    """Writes within leave nothing on the executors' disks, and partitions are written as their rows come.

    Shuffle files are removed as the write ends; otherwise they stay until the driver happens to collect garbage, beside
    those of all later writes. A task keeps up to ``OPEN_FILES`` partitions open instead of sorting, and spilling, its
    rows by partition; the rows of further partitions are sorted.
    """
    wanted = {CLEANUP_KEY: "true", OPEN_FILES_KEY: str(OPEN_FILES)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def pin(df: DataFrame, name: str = "pin") -> DataFrame:
    """Cut lineage: write the rows once to the shared folder and go on from that table.

    Later readers see one fixed copy, read only the columns they need, and the planner knows its size.
    The copy outlives the executors that wrote it.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
