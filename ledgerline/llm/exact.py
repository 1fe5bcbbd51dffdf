"""Exact duplicates through an extendible-hash index kept in files of the shared folder.

1. Every text gets a 64-bit key. Keys are counted per prefix, and a directory is grown from these counts: while a
   bucket holds more than ``capacity`` entries, it is split by one more bit of the key, and the directory doubles when
   a split needs a bit that it doesn't have yet. A bucket is a range of keys, and one owner task at a time has it.
2. Rows become entries of the index. Equal texts that lie in the same batch are merged into one entry first, so that a
   text copied onto a third of all rows reaches its owner as one entry per batch, not per row.
3. Owners read their range in key order and chain the texts of one key: an entry joins the link whose bytes equal its
   own, or adds a link. The index is written to the shared folder, one folder per bucket.
4. Sizes and survivors are summed per link and joined back, and the entries are unfolded into one row per document.

Null texts count as empty, empty texts equal each other, an empty table gives an empty result. Rows that repeat a
doc_id count as rows of their own. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import free_name, partitions_for, texts_of
from ledgerline.session import pin, stage_path

CAPACITY = 2_000_000
#: The directory is grown from counts per prefix of this many bits, which bounds its size.
MAX_DEPTH = 14
MIN_DEPTH = 6

ENTRY = "bucket int, h bigint, text binary, doc_ids array<bigint>, n bigint, top bigint"
LINK = "bucket int, h bigint, link int, doc_ids array<bigint>, n bigint, top bigint, text_sha256 string"


def grow_directory(counts: dict[int, int], capacity: int = CAPACITY, depth: int = MAX_DEPTH) -> list[tuple[int, int]]:
    """The buckets (prefix, bits) of a directory whose buckets hold at most ``capacity`` entries.

    ``counts`` has the entries per prefix of ``depth`` bits. A bucket of ``depth`` bits isn't split further: its
    owner reads it in key order and needs memory for the texts of one key only.
    """
    buckets: list[tuple[int, int]] = []
    open_ = [(p, MIN_DEPTH) for p in range(1 << MIN_DEPTH)]
    while open_:
        prefix, bits = open_.pop()
        low, high = prefix << (depth - bits), (prefix + 1) << (depth - bits)
        if bits < depth and sum(counts.get(p, 0) for p in range(low, high)) > capacity:
            open_ += [(prefix * 2, bits + 1), (prefix * 2 + 1, bits + 1)]
        else:
            buckets.append((prefix, bits))
    return sorted((prefix << (depth - bits), bits) for prefix, bits in buckets)


def _entries(lows: np.ndarray):
    """Merge the equal texts of a batch and look their bucket up in the directory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged: dict[str, list] = {}
            for doc, text, key in zip(batch.column("doc_id").to_pylist(), texts_of(batch), batch.column("h").to_pylist(), strict=True):
                merged.setdefault(text, [key]).append(doc)
            keys = np.array([v[0] for v in merged.values()], dtype=np.int64)
            prefixes = (keys.view(np.uint64) >> np.uint64(64 - MAX_DEPTH)).astype(np.int64)
            ids = [v[1:] for v in merged.values()]
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(np.searchsorted(lows, prefixes, side="right") - 1, pa.int32()),
                    "h": pa.array(keys),
                    "text": pa.array([t.encode() for t in merged], pa.binary()),
                    "doc_ids": pa.array(ids, pa.list_(pa.int64())),
                    "n": pa.array([len(v) for v in ids], pa.int64()),
                    "top": pa.array([max((x for x in v if x is not None), default=None) for v in ids], pa.int64()),
                }
            )

    return run


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Give every entry the number of its link in the chain of its key; entries come in key order."""
    now, chain = None, {}
    for batch in batches:
        links, shas = [], []
        for key, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if key != now:
                now, chain = key, {}
            if text not in chain:  # a dict compares the bytes of texts that hash alike
                chain[text] = (len(chain), hashlib.sha256(text).hexdigest())
            link, sha = chain[text]
            links.append(link)
            shas.append(sha)
        yield pa.RecordBatch.from_arrays(
            [batch.column("bucket"), batch.column("h"), pa.array(links, pa.int32()), *(batch.column(c) for c in ("doc_ids", "n", "top")), pa.array(shas, pa.string())],
            names=["bucket", "h", "link", "doc_ids", "n", "top", "text_sha256"],
        )


def build_index(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The index: one row per entry, in one folder per bucket."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    prefixes = keyed.groupBy(F.shiftrightunsigned("h", 64 - MAX_DEPTH).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    counts = {r["p"]: r["n"] for r in prefixes.collect()}  # at most 2 ** MAX_DEPTH rows
    lows = np.array([low for low, _ in grow_directory(counts, capacity)])
    entries = keyed.mapInArrow(_entries(lows), ENTRY)
    owned = entries.repartition(partitions_for(spark), "bucket").sortWithinPartitions("bucket", "h")
    path = stage_path(spark, "hash-index")
    owned.mapInArrow(_chain, LINK).write.partitionBy("bucket").parquet(path)
    return spark.read.schema(LINK).parquet(path)


def exact_groups(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays; of rows with that same doc_id and text, all are marked so. A
    null doc_id is smaller than any other.
    """
    index = build_index(docs, capacity)
    links = index.groupBy("h", "link").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))
    groups = index.join(links, ["h", "link"]).select(F.explode("doc_ids").alias("doc_id"), "keep_id", "group_size", "text_sha256")
    return groups.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The documents whose row stays, with all their columns."""
    sha = free_name(docs, "_sha")
    gone = exact_groups(docs, capacity).where(~F.col("kept")).select("doc_id", F.col("text_sha256").alias(sha)).distinct()
    keyed = docs.withColumn(sha, F.sha2(F.coalesce("text", F.lit("")), 256))
    return keyed.join(pin(gone, "exact-copies").hint("merge"), ["doc_id", sha], "left_anti").select(*docs.columns)
