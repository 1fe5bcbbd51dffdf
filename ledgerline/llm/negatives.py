"""Hard negatives by exact integer scores from a residue number system.

Components become whole numbers, floor(scale x component). Scores are integer inner products of anchors with all rows.
A block of rows and a batch of anchors are multiplied modulo several small primes: residues are balanced around zero, so
that sums of products stay below 2^24 and a float32 product is exact (longer vectors are summed in stretches). Balanced
mixed-radix digits, the signed form of Chinese remaindering, give back the exact score; the number of primes follows
from the largest component and the longest vector of the table.

Rows stay in blocks, one per task, and each block is visited by all anchors, batch by batch; a task holds one block and
one tile of scores. It passes on the best of the block per anchor only, and windows pick the best of all blocks. A first
pass finds an anchor's positives, a second one its negatives within the share of each positive's score.

A row without an id or a label, or whose vector is null or holds null or non-finite components takes no part. Rows that
repeat id, label and vector count once; rows that share an id but differ are rows of their own, and none is a positive
or negative of an anchor with its id. Vectors of different lengths aren't compared. Equal scores go by the smaller id.
An empty table gives an empty result, further columns are ignored. Components so large that a score may need more than
64 bits raise a ValueError.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import partitions_for
from ledgerline.session import pin

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Hundredths of the positive's score between which a negative's score lies.
LOW, HIGH = 30, 90
#: Components that a block of rows holds, and scores of a tile.
BLOCK_CELLS, TILE = 8_000_000, 2_000_000
#: Whole numbers up to here are exact in float32.
EXACT = 1 << 24


def primes_for(bound: int) -> list[int]:
    """The largest primes of eight bits, as many as tell apart all whole numbers from -bound to bound."""
    chosen, product = [], 1
    for p in range(255, 2, -1):
        if product > 2 * bound:
            return chosen or [251]
        if all(p % q for q in range(2, math.isqrt(p) + 1)):
            chosen.append(p)
            product *= p
    raise ValueError("the scores are too large for the residue number system")


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Residues from -(p - 1) / 2 to (p - 1) / 2."""
    half = p // 2
    return np.remainder(x + half, p) - half


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [balanced(x, p).astype(np.float32) for p in primes]


def products(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of left with all rows of right, given their residues."""
    found: list[np.ndarray] = []
    for p, a, b in zip(primes, left, right, strict=True):
        step = EXACT // (p // 2) ** 2
        total = np.zeros((len(a), len(b)), np.int32)
        for low in range(0, a.shape[1], step):
            total = balanced(total + balanced((a[:, low : low + step] @ b[:, low : low + step].T).astype(np.int32), p), p)
        found.append(total)
    return signed(found, primes)


def signed(found: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Whole numbers from their balanced residues, digit by digit; sums wrap at 64 bits, which the result does not."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        have, weight = np.zeros_like(found[0]), 1
        for q, digit in zip(primes, digits, strict=False):
            have = balanced(have + digit * np.int32(weight), p)
            weight = weight * q % p
        digits.append(balanced((found[k] - have) * np.int32(pow(weight, -1, p)), p))
    value, weight = np.zeros(found[0].shape, np.int64), 1
    with np.errstate(over="ignore"):
        for p, digit in zip(primes, digits, strict=True):
            value += digit.astype(np.int64) * np.uint64(weight % (1 << 64)).astype(np.int64)
            weight *= p
    return value


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Of the given rows those with the highest scores, smaller ids first among equals."""
    if len(rows) > most:
        own = scores[rows]
        rows = rows[own >= np.partition(own, len(own) - most)[len(own) - most]]
    return rows[np.lexsort((ids[rows], -scores[rows]))][:most]


def whole(column: pa.ListArray, size: int, scale: int) -> np.ndarray:
    """Vectors of one length as rows of whole numbers."""
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    return flat.astype(np.int64).reshape(len(column), size)


Pick = Callable[[dict, np.ndarray, np.ndarray, np.ndarray], Iterator[tuple]]


def visit(rows: DataFrame, anchors: DataFrame, blocks: int, primes: list[int], scale: int, pick: Pick, schema: str) -> DataFrame:
    """What ``pick`` finds for each anchor in each block: it gets the anchor's columns, scores, ids and labels of rows."""
    extra = [c for c in anchors.columns if c not in rows.columns]
    kept = rows.withColumns({c: F.lit(None).cast(anchors.schema[c].dataType) for c in extra}).withColumn("kind", F.lit(0))
    sent = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("kind", F.lit(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held: dict[int, tuple] = {}
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            split = int(np.searchsorted(kinds, 1))
            if split:
                waiting.append(batch.slice(0, split))
            if split == batch.num_rows:
                continue
            if waiting:  # the anchors begin: turn the block to arrays, one set per length
                block = pa.Table.from_batches(waiting)
                sizes = pc.list_value_length(block.column("embedding")).to_numpy()
                for size in np.unique(sizes).tolist():
                    own = block.filter(pa.array(sizes == size)).combine_chunks()
                    vectors = own.column("embedding").combine_chunks()
                    ids, labels = (own.column(c).to_numpy() for c in ("vec_id", "label"))
                    held[size] = ids, labels, residues(whole(vectors, size, scale), primes)
                waiting = []
            visitors = batch.slice(split)
            sizes = pc.list_value_length(visitors.column("embedding")).to_numpy()
            found: list[tuple] = []
            for size in np.unique(sizes).tolist():
                if size not in held:
                    continue
                ids, labels, right = held[size]
                own = visitors.filter(pa.array(sizes == size))
                step = max(1, TILE // max(len(ids), 1))
                for low in range(0, own.num_rows, step):
                    part = own.slice(low, step)
                    scores = products(residues(whole(part.column("embedding"), size, scale), primes), right, primes)
                    for k, anchor in enumerate(part.drop_columns(["embedding"]).to_pylist()):
                        found += pick(anchor, scores[k], ids, labels)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)

    names = [c.split()[0] for c in schema.split(", ")]
    dealt = kept.unionByName(sent).repartitionById(blocks, F.col("block")).sortWithinPartitions("kind")
    return dealt.mapInArrow(run, schema)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vec_id, embedding, label.

    Anchors are the rows where ``is_anchor`` holds; ``label`` replaces the label column. A row with an anchor's label
    is one of its positives if it is among the first so many by score; rows of other labels are its negatives where
    low x positive's score <= 100 x score <= high x positive's score, the first so many for each positive.
    """
    spark = vectors.sparkSession
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    labelled = vectors.select("vec_id", (F.col("label") if label is None else label).cast("bigint").alias("label"), "embedding", is_anchor.alias("anchor"))
    rows = pin(labelled.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(fine).distinct(), "vectors")
    reach = F.greatest(F.abs(F.array_max("embedding")), F.abs(F.array_min("embedding")))
    cells, longest, largest = rows.agg(F.sum(F.greatest(F.size("embedding"), F.lit(1))), F.max(F.size("embedding")), F.max(reach)).first()
    bound = max(longest or 0, 1) * (math.floor(scale * float(largest or 0)) + 1) ** 2
    if bound * 100 >= 1 << 63:
        raise ValueError("components too large: scores may need more than 64 bits")
    primes = primes_for(bound)
    blocks = max(partitions_for(spark), -(-(cells or 0) // block_cells))
    key = F.xxhash64("vec_id", "label", "embedding")
    block = F.pmod(key, F.lit(blocks)).cast("int")
    dealt = rows.select("vec_id", "label", "embedding", block.alias("block"))
    anchors = rows.where("anchor").select("vec_id", "label", "embedding", key.alias("key"))

    def near(anchor: dict, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Iterator[tuple]:
        same = np.flatnonzero((labels == anchor["label"]) & (ids != anchor["vec_id"]))
        for k in best(scores, ids, same, positives):
            yield anchor["vec_id"], anchor["key"], ids[k], scores[k]

    one = ["anchor_id", "key"]
    found = visit(dealt, anchors, blocks, primes, scale, near, "anchor_id bigint, key bigint, id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy(*one).orderBy(F.desc("score"), "id"))
    first = found.withColumn("place", place).where(F.col("place") <= positives)
    lists = first.groupBy(*one).agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("near"))  # no more than so many each
    armed = anchors.withColumnRenamed("vec_id", "anchor_id").join(lists, one).withColumnRenamed("anchor_id", "vec_id")

    def hard(anchor: dict, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Iterator[tuple]:
        other = np.flatnonzero((labels != anchor["label"]) & (ids != anchor["vec_id"]))
        values = scores[other]
        for positive in anchor["near"]:
            p = positive["score"]
            inside = other[(values >= -(-low * p // 100)) & (values <= high * p // 100)]
            for k in best(scores, ids, inside, negatives):
                yield anchor["vec_id"], anchor["key"], positive["place"], positive["id"], p, ids[k], scores[k]

    pairs = visit(
        dealt, armed, blocks, primes, scale, hard,
        "anchor_id bigint, key bigint, place bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint",
    )
    order = Window.partitionBy(*one, "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
