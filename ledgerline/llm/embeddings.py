"""Near copies among embeddings by binary codes of randomly rotated vectors.

A unit vector is rotated at random and keeps the signs of its coordinates. The inner product of the code with another
rotated vector, divided by the stored product of the code with its own vector, is an unbiased estimate of the cosine;
its spread follows from the same stored factor, which gives confidence bounds. A pair whose upper bound is below the
threshold is dismissed; all others are computed exactly in double precision.

Pairs are sought in the buckets of independent rotations: the first ``bits`` signs of each name a bucket, and the number
of bits grows with the logarithm of the number of rows, so that buckets stay small. At a cosine of 0.9 two signs differ
with probability 0.144, so a longer key is missed more often; the number of tables grows with the bits in return
(``tables_for``: 40 up to 13 bits, 124 with 20, 233 with 24), and a pair at the threshold is missed by all of them in
0.33 % of cases whatever the number of rows, closer ones far less often. A pair that several tables find counts in the
first of them. Large buckets are dealt in blocks (``blocks``), none is cut off.

Vectors that are null, zero or hold null or non-finite components link with nothing. Rows that share a vec_id don't
link with each other, and each counts in the links of others. An empty table gives an empty result; further columns, labels among them, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import compare, deal
from ledgerline.llm.graph import components
from ledgerline.session import pin

#: Tables at least, and share of the pairs at the threshold that no table may find.
TABLES, MISSED, THRESHOLD = 40, 0.0033, 0.9
#: Standard errors of the confidence bound.
SPREAD = 4.0
SEED = 20


@lru_cache(maxsize=256)
def rotation(size: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def bits_for(rows: int) -> int:
    return int(min(max(math.ceil(math.log2(max(rows, 2) / 8)), 4), 30))


def tables_for(bits: int, threshold: float = THRESHOLD) -> int:
    """Tables of keys of so many bits that miss a pair at the threshold with a probability of ``MISSED`` or less."""
    same = (1 - math.acos(min(max(threshold, -1.0), 1.0)) / math.pi) ** bits
    return TABLES if same >= 1 else max(TABLES, math.ceil(math.log(MISSED) / math.log1p(-same)))


def unit(x: np.ndarray) -> np.ndarray:
    """The vector over its length, in double precision; first over its largest component, so that no square overflows."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max()
    return x / math.sqrt(float(x @ x))


def _usable(column: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows with a direction, and their vectors."""
    rows, vectors = [], []
    for k, v in enumerate(column):
        if v.is_valid and not v.values.null_count:
            x = v.values.to_numpy(zero_copy_only=False)
            if len(x) and np.isfinite(x).all() and np.abs(x).max() > 0:
                rows.append(k)
                vectors.append(x)
    return np.array(rows, np.int64), vectors


def codes(batch: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors, and the product of each code with its vector."""
    turned = batch @ turn.T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / math.sqrt(turned.shape[1])


def estimate(signs: np.ndarray, factor: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of the cosines of coded vectors (rows, bits) with rotated vectors (columns), and their spread."""
    size = turned.shape[1]
    close = ((signs.astype(np.float32) * 2 - 1) @ turned.T.astype(np.float32)) / math.sqrt(size) / factor[:, None]
    return close, np.sqrt((1 - np.minimum(factor, 1) ** 2) / factor**2 / max(size - 1, 1))


class Coded(NamedTuple):
    """Rows of many cells as arrays; ``keys`` has the buckets of the tables before the cell's, from ``at`` on for each row."""

    vector: list[np.ndarray]
    turned: list[np.ndarray]
    signs: list[np.ndarray]
    factor: np.ndarray
    keys: np.ndarray
    at: np.ndarray
    table: np.ndarray


def near_links(vectors: DataFrame, threshold: float = THRESHOLD, tables: int | None = None, seed: int = SEED, bits: int | None = None) -> DataFrame:
    """Links per member and connecting pairs (see ``blocks``) of vec_id, embedding; bits and tables follow the rows if not given."""
    bits = bits or bits_for(vectors.count())
    tables = tables or tables_for(bits, threshold)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            rows, given = _usable(batch.column("embedding"))
            sizes = np.array([len(x) for x in given])
            for size in np.unique(sizes):
                if size not in turns:
                    turns[size] = [rotation(size, seed + t) for t in range(-(-tables * bits // int(size)) + 1)]
                own = np.flatnonzero(sizes == size)
                x = np.stack([unit(given[k]) for k in own])
                code, factor = codes(x, turns[size][0])
                signs = np.concatenate([x @ turn.T > 0 for turn in turns[size][1:]], axis=1)[:, : tables * bits]
                width = signs.shape[1] // bits * bits
                keys = signs[:, :width].reshape(len(x), -1, bits) @ (1 << np.arange(bits, dtype=np.int64))
                for low in range(0, len(x), 2_000):
                    part = slice(low, low + 2_000)
                    n, t = keys[part].shape
                    many = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
                    yield pa.RecordBatch.from_pydict(
                        {
                            "vec_id": pa.array(ids[rows[own[part]]], pa.int64()), "size": pa.array(np.full(n, size), pa.int32()),
                            "code": many(code[part]), "factor": pa.array(factor[part], pa.float64()),
                            "vector": many(np.stack([given[k] for k in own[part]])), "keys": pa.array(list(keys[part].astype(np.int32)), pa.list_(pa.int32())),
                        }
                    )

    schema = "vec_id bigint, size int, code binary, factor double, vector binary, keys array<int>"
    members = pin(vectors.where("vec_id IS NOT NULL").select("vec_id", "embedding").mapInArrow(coded, schema), "codes")
    dealt = deal(members.select("size", "vec_id", F.posexplode("keys").alias("table", "key")), ["size", "table", "key"], "vec_id")
    cells = dealt.join(members.drop("size").hint("merge"), "vec_id")  # vectors travel to their cells only
    cells = cells.withColumn("keys", F.slice("keys", F.lit(1), F.col("table")))  # a cell asks for earlier tables only
    kind = np.float32 if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else np.float64

    def prepare(rows: pa.Table) -> Coded:
        sizes = rows.column("size").to_numpy()
        turned: list[np.ndarray | None] = [None] * len(rows)
        vectors = [unit(np.frombuffer(v, kind)) for v in rows.column("vector").to_pylist()]
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            for k, x in zip(own, np.stack([vectors[k] for k in own]) @ rotation(int(size), seed).T, strict=True):
                turned[k] = x
        signs = [np.unpackbits(np.frombuffer(c, np.uint8), count=n) for c, n in zip(rows.column("code").to_pylist(), sizes, strict=True)]
        keys = rows.column("keys").combine_chunks()
        return Coded(vectors, turned, signs, rows.column("factor").to_numpy(), keys.flatten().to_numpy(), keys.offsets.to_numpy() - keys.offsets[0].as_py(), rows.column("table").to_numpy())

    def links(rows: Coded, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        close, spread = estimate(np.stack([rows.signs[k] for k in left]), rows.factor[left], np.stack([rows.turned[k] for k in right]))
        found = close + SPREAD * spread[:, None] >= threshold
        for t in range(rows.table[left[0]]):
            if not found.any():
                return found
            found &= rows.keys[rows.at[left] + t][:, None] != rows.keys[rows.at[right] + t]
        if found.any():  # the rows and columns with such a pair, exactly
            i, j = np.flatnonzero(found.any(1)), np.flatnonzero(found.any(0))
            exact = np.stack([rows.vector[left[k]] for k in i]) @ np.stack([rows.vector[right[k]] for k in j]).T
            found[np.ix_(i, j)] &= exact >= threshold
        return found

    return compare(cells, "vec_id", prepare, links)


def near_groups(vectors: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest vec_id it reaches), kept."""
    found = pin(near_links(vectors, threshold, **options), "vector-links")
    return with_groups(vectors.select("vec_id"), found, "vec_id")


def with_groups(rows: DataFrame, found: DataFrame, member: str) -> DataFrame:
    """Add n_links, component_id and kept to rows of distinct members."""
    counts = found.where("n > 0").groupBy("a").agg(F.sum("n").alias("n_links"))
    groups = components(found.where("n = 0")).withColumnRenamed("id", "a")
    joined = rows.withColumnRenamed(member, "a").join(counts, "a", "left").join(groups, "a", "left")
    component = F.coalesce("component", "a")
    return joined.select(F.col("a").alias(member), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("a").eqNullSafe(component).alias("kept"))
