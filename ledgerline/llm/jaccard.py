"""Similarity join of documents on the Jaccard index of their word five-grams, through MinHash banding.

Words are runs of characters without ASCII white space, in lower case. A text of five words or more has all its runs of
five words as shingles, a shorter one has all its words as its only shingle, one without words has none and links with
nothing. Shingles are compared by 64-bit hashes.

1. Texts are grouped by their SHA-256, and one row per distinct text (the smallest doc_id, how many rows) goes on.
2. Each tree is a band: a prefix of a sequence of minimum hashes, of one length for all texts and trees. It is the
   longest at which a pair at the threshold shares one in some tree with the wanted probability, by formula; no sorted
   forest is built. Bands of one text are left out; within the others, pairs whose signatures make the threshold
   implausible are dismissed, and of the rest as many are passed on as connect the same texts (``blocks``).
3. What these connect is a candidate group, whose texts meet once more with all their shingles. All pairs of a group are
   verified exactly, in blocks; what comes out is links per text and connecting pairs, never a row per pair.

Null texts count as empty. Rows that repeat a doc_id and its text are copies; a doc_id must not stand for two texts; a
row without doc_id links with nothing and is kept. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import compare, deal
from ledgerline.llm.common import mix64, texts_of
from ledgerline.llm.graph import components
from ledgerline.llm.packing import slices
from ledgerline.session import pin

WORDS, THRESHOLD = 5, 0.8
TREES, LONGEST, RECALL = 32, 8, 0.9998
#: Standard errors by which a signature may fall short of the threshold.
SLACK = 5
#: Cells of a dense matrix of shingles that a task may hold.
DENSE = 30_000_000
MULTIPLIERS = mix64(np.arange(1, TREES * LONGEST + 1, dtype=np.uint64)) | np.uint64(1)


def prefix_length(threshold: float, recall: float, trees: int = TREES, longest: int = LONGEST) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with probability ``recall``."""
    length = longest
    while length > 1 and 1 - (1 - threshold**length) ** trees < recall:
        length -= 1
    return length


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, words: int = WORDS, remembered: int = 300_000):
        self.words, self.remembered = words, remembered
        self.hashes: dict[bytes, int] = {}

    def of(self, text: str) -> np.ndarray:
        found = text.lower().encode("utf-8", "surrogatepass").split()
        if not found:
            return np.zeros(0, np.uint64)
        if len(self.hashes) > self.remembered:
            self.hashes.clear()
        known = self.hashes
        for word in set(found).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        n = min(self.words, len(h))
        s = np.zeros(len(h) - n + 1, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                s = mix64(s + h[k : len(h) - n + 1 + k])
        return np.unique(s)


def signature(shingles: np.ndarray, hashes: int) -> np.ndarray:
    """Minimum of each of ``hashes`` hash functions."""
    out = np.empty(hashes, np.uint64)
    for low in range(0, hashes, 16):  # few at a time, so that long texts need little memory
        part = MULTIPLIERS[low : min(low + 16, hashes)]
        out[low : low + 16] = (shingles[None, :] * part[:, None]).min(axis=1)
    return out


def sketches(docs: DataFrame, length: int, trees: int = TREES, words: int = WORDS) -> DataFrame:
    """doc_id, text_sha256, keys (a prefix per tree) and one byte of every minimum hash; no keys without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            keys, marks = [], []
            for text in texts_of(batch):
                s = shingler.of(text)
                if len(s):
                    low = signature(s, trees * length)
                    rolled = low.reshape(trees, length)
                    key = np.zeros(trees, np.uint64)
                    for k in range(length):
                        key = mix64(key + rolled[:, k])
                    keys.append(key.view(np.int64))
                    marks.append((low >> np.uint64(40)).astype(np.uint8).tobytes())
                else:
                    keys.append(np.zeros(0, np.int64))
                    marks.append(b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_sha256"), pa.array(keys, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                names=["doc_id", "text_sha256", "keys", "marks"],
            )

    rows = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    return rows.mapInArrow(run, "doc_id bigint, text_sha256 string, keys array<bigint>, marks binary")


class Marks(NamedTuple):
    keys: np.ndarray
    marks: np.ndarray
    tree: np.ndarray


def candidate_links(classes: DataFrame, length: int, threshold: float, trees: int = TREES) -> DataFrame:
    """Pairs a, b that connect the texts of the forest's nodes whose signatures don't speak against the threshold."""
    least = trees * length * threshold - SLACK * math.sqrt(trees * length * threshold * (1 - threshold))
    nodes = classes.select("rep", F.posexplode("keys").alias("tree", "key"))
    shared = nodes.groupBy("tree", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("tree", "key")
    meeting = pin(nodes.join(shared.hint("merge"), ["tree", "key"]), "forest-nodes")
    dealt = deal(meeting, ["tree", "key"], "rep")
    cells = dealt.join(classes.select("rep", "keys", "marks").hint("merge"), "rep")  # signatures travel to their cells only

    def prepare(rows: pa.Table) -> Marks:
        array = lambda name, kind: np.frombuffer(b"".join(rows.column(name).to_pylist()), kind).reshape(len(rows), -1)
        return Marks(rows.column("keys").combine_chunks().flatten().to_numpy().reshape(len(rows), -1), array("marks", np.uint8), rows.column("tree").to_numpy())

    def links(rows: Marks, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found = np.ones((len(left), len(right)), bool)
        for t in range(rows.tree[left[0]]):  # an earlier tree has the pair
            found &= rows.keys[left, t][:, None] != rows.keys[right, t]
        a, b = rows.marks[left], rows.marks[right]
        for k in np.flatnonzero(found.any(1)):
            found[k] &= (a[k] == b).sum(1) >= least
        return found

    return compare(cells, "rep", prepare, links).where("n = 0").select("a", "b")


class Sets(NamedTuple):
    shingles: list[np.ndarray]
    sizes: np.ndarray


def overlaps(a: list[np.ndarray], b: list[np.ndarray], plausible: np.ndarray) -> np.ndarray:
    """How many elements each set of ``a`` shares with each of ``b``, where plausible."""
    flat = np.concatenate(a + b)
    _, place, seen = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(seen > 1) - 1
    width = int((seen > 1).sum())
    work = plausible.sum() * (len(flat) / (len(a) + len(b))) * 30
    if width and (len(a) + len(b)) * width <= DENSE and len(a) * len(b) * width / 10 <= max(work, 1e7):
        owner = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in a + b])
        some = seen[place] > 1
        matrix = np.zeros((len(a) + len(b), width), np.float32)
        matrix[owner[some], number[place[some]]] = 1
        return (matrix[: len(a)] @ matrix[len(a) :].T).round().astype(np.int64)
    out = np.zeros(plausible.shape, np.int64)
    for i, j in zip(*np.nonzero(plausible), strict=True):
        out[i, j] = len(np.intersect1d(a[i], b[j], assume_unique=True))
    return out


def verified_links(docs: DataFrame, groups: DataFrame, threshold: float, words: int = WORDS) -> DataFrame:
    """Links per text and connecting pairs (see ``blocks``) among the texts (rep, weight) of each candidate group."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            texts = texts_of(batch)
            for part in slices(texts, 500_000):
                sets = [shingler.of(t).tobytes() for t in texts[part]]
                yield pa.RecordBatch.from_arrays([*(batch.column(c)[part] for c in ("rep", "component", "weight")), pa.array(sets, pa.binary())], names=["rep", "component", "weight", "shingles"])

    texts = docs.select(F.col("doc_id").alias("rep"), "text").join(groups.hint("merge"), "rep").select("rep", "component", "weight", "text")
    sets = pin(texts.mapInArrow(shingled, "rep bigint, component bigint, weight bigint, shingles binary").dropDuplicates(["rep"]), "shingles")

    def prepare(rows: pa.Table) -> Sets:
        found = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
        return Sets(found, np.array([len(x) for x in found]))

    def links(rows: Sets, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        na, nb = rows.sizes[left][:, None], rows.sizes[right][None, :]
        plausible = np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9
        if left is right:
            plausible = np.triu(plausible, 1)
        common = overlaps([rows.shingles[k] for k in left], [rows.shingles[k] for k in right], plausible)
        return plausible & (common >= threshold * (na + nb - common) - 1e-9)

    return compare(deal(sets, ["component"], "rep"), "rep", prepare, links, weight="weight")


def jaccard_groups(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its text), n_links (other documents it links with),
    component_id (smallest doc_id it reaches) and kept (whether that is its own)."""
    length = prefix_length(threshold, recall)
    nameless = docs.where("doc_id IS NULL").select("doc_id")
    docs = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    drawn = pin(sketches(docs, length, words=words), "sketches")
    first = F.min(F.struct("doc_id", "keys", "marks"))
    grouped = drawn.groupBy("text_sha256").agg(first.alias("f"), F.count(F.lit(1)).alias("weight"))
    classes = pin(grouped.select("text_sha256", F.col("f.doc_id").alias("rep"), F.col("f.keys").alias("keys"), F.col("f.marks").alias("marks"), "weight"), "classes")
    candidates = components(candidate_links(classes, length, threshold))
    groups = pin(candidates.join(classes.select(F.col("rep").alias("id"), "weight"), "id").select(F.col("id").alias("rep"), "component", "weight"), "candidates")
    found = pin(verified_links(docs, groups, threshold, words), "verified-links")
    counts = found.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    joined = components(found.where("n = 0")).withColumnRenamed("id", "rep")
    some = F.size("keys") > 0
    by_class = classes.join(counts, "rep", "left").join(joined, "rep", "left").select(
        "text_sha256", F.col("rep").alias("class_id"), some.alias("some"), F.when(some, F.col("weight") - 1 + F.coalesce("others", F.lit(0))).otherwise(0).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )
    rows = drawn.select("doc_id", "text_sha256").join(by_class.hint("merge"), "text_sha256")
    component = F.when(F.col("some"), F.col("component")).otherwise(F.col("doc_id"))
    told = rows.select("doc_id", "class_id", "n_links", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
    none = F.lit(None).cast("bigint")
    return told.unionByName(nameless.select("doc_id", none.alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), none.alias("component_id"), F.lit(True).alias("kept")))


def drop_near(docs: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents without those that a linked document of smaller doc_id stands for, with all their columns."""
    gone = pin(jaccard_groups(docs, threshold, **options).where(~F.col("kept")).select("doc_id"), "near-copies")
    return docs.join(gone.hint("merge"), "doc_id", "left_anti")
