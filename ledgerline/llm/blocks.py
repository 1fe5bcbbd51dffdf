"""Comparing the members of buckets without one row per pair and without one task per bucket.

A bucket with more than ``BLOCK`` members is dealt into blocks by a hash of the member, and each pair of blocks becomes
a cell; a smaller bucket is one cell. A task holds one cell at a time, compares its members and passes on two things:
how many links each member has there, and pairs that connect what is connected in the cell. So a group of n copies
gives rows in proportion to n for each of its cells, although all its pairs are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import partitions_for, sorted_groups

T = TypeVar("T")

BLOCK = 512
FOUND = "a bigint, b bigint, n bigint"


def deal(members: DataFrame, keys: list[str], member: str, block: int = BLOCK) -> DataFrame:
    """Rows of buckets with two members or more, each with its cell, whether it is of the cell's second block, or neither.

    ``side`` is 0 or 1 in a cell of two blocks, and 2 in a cell that is compared with itself.
    """
    sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / block).cast("int")
    own = F.pmod(F.xxhash64(F.col(member), F.lit(17)), F.col("_blocks")).cast("int")
    dealt = members.join(sizes, keys).withColumn("_blocks", blocks).withColumn("_own", own)
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    side = F.when(F.col("_own") == F.col("_other"), 2).otherwise((F.col("_own") > F.col("_other")).cast("int"))
    return dealt.withColumn("cell", F.xxhash64(*keys, low, high)).withColumn("side", side).drop("_n", "_blocks", "_own", "_other")


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the links a-b connect, as a pair of each member with the smallest one that it reaches.

    Cells that hold the same group give the same pairs, so a group that many cells hold stays small when pairs merge.
    """
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    pairs = [(x, r) for x in parent if (r := root(x)) != x]
    return np.array([x for x, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int64)


def compare(dealt: DataFrame, member: str, prepare: Callable[[pa.Table], T], links: Callable[[T, np.ndarray, np.ndarray], np.ndarray], weight: str | None = None) -> DataFrame:
    """Rows (a, null, n): n links of member a in some cell; and rows (a, b, 0): links of the cell connect a with b.

    ``prepare`` turns the rows of many cells into arrays. ``links(prepared, left, right)`` gets the numbers of the rows
    to compare, all of one cell, and returns a boolean matrix; it decides which cell of several reports a pair. ``weight`` is a column of how many rows a member stands for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in sorted_groups(batches, "cell"):
            cells, side, ids = groups.column("cell").to_numpy(), groups.column("side").to_numpy(), groups.column(member).to_numpy()
            heavy = groups.column(weight).to_numpy() if weight else np.ones(len(ids), np.int64)
            edge = np.concatenate([[0], np.flatnonzero(np.diff(cells)) + 1, [len(cells)]])
            out_a, out_b, out_n = [], [], []
            prepared = prepare(groups)
            for low, high in zip(edge[:-1], edge[1:], strict=True):
                if high - low < 2:
                    continue
                kind = side[low:high]
                inner, first, second = (low + np.flatnonzero(kind == k) for k in (2, 0, 1))
                for left, right in ((inner, inner), (first, second)):
                    if not len(left) or not len(right) or left is right and len(left) < 2:
                        continue
                    found = links(prepared, left, right)
                    if left is right:
                        found = found | found.T
                    found &= ids[left][:, None] != ids[right]
                    at_l, at_r = np.nonzero(found)
                    if not len(at_l):
                        continue
                    a, b = ids[left], ids[right]
                    wl, wr = heavy[left], heavy[right]
                    count_l = np.bincount(at_l, wr[at_r], len(left)).astype(np.int64)
                    out_a.append(a[count_l > 0])
                    out_n.append(count_l[count_l > 0])
                    out_b.append(np.full((count_l > 0).sum(), -1))
                    if left is not right:
                        count_r = np.bincount(at_r, wl[at_l], len(right)).astype(np.int64)
                        out_a.append(b[count_r > 0])
                        out_n.append(count_r[count_r > 0])
                        out_b.append(np.full((count_r > 0).sum(), -1))
                    ta, tb = stars(a[at_l], b[at_r])
                    out_a.append(ta)
                    out_b.append(tb)
                    out_n.append(np.zeros(len(ta), np.int64))
            if out_a:
                a, b, n = np.concatenate(out_a), np.concatenate(out_b), np.concatenate(out_n)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64(), mask=n > 0), pa.array(n, pa.int64())], names=["a", "b", "n"])

    spread = dealt.repartition(partitions_for(dealt.sparkSession), "cell").sortWithinPartitions("cell")
    return spread.mapInArrow(run, FOUND)
