"""Quality of texts: plain counts, and how much likelier their n-grams are among trusted texts than in the corpus.

A text's words (runs between ASCII white space), joined by one space with a space before and after, are read as all
runs of three characters, each hashed to one of 65,536 buckets. Counts per bucket over all documents (repeated rows
count again), and over those that ``trusted`` names, give two multinomials, smoothed by half an n-gram per bucket. A
text's score is the mean over its n-grams of ln(share among trusted / share in the corpus), rounded to six places. Every
document is judged alike by a fixed threshold, -ln 2: on average its n-grams are at least half as frequent among trusted
texts as in the corpus. Nothing is drawn at random, so a text always gets the same verdict.

Counts per bucket are the only thing that reaches the driver, 65,536 pairs at most whatever the corpus. Texts are read
twice: once beside the trusted ids (both sorted by id, however few are trusted: their number follows the corpus), once to
be scored where they lie.

Null and empty texts have no words, score 0 and fail the plain rules. Without trusted documents every score is 0 and only
the plain rules decide. Very long texts are read in stretches. Rows that repeat a doc_id are documents of their own; a
null doc_id is never trusted. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import texts_of

BUCKETS, STEP, MODULUS = 1 << 16, 31_337, (1 << 31) - 1
SMOOTH, THRESHOLD = 0.5, round(-math.log(2), 6)
#: Fewer words, or more hundredths of them in repeated windows, fail at once; signs that count as symbols.
LEAST_WORDS, MOST_REPEATED, SYMBOLS = 50, 50, b"#*$%&|<>"
#: Characters of a text that are hashed at a time.
STRETCH = 1_000_000


def bucket_runs(words: list[bytes]) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, stretch by stretch."""
    if not words:
        return
    points = np.frombuffer((b" " + b" ".join(words) + b" ").decode().encode("utf-32-le"), "<u4")
    for low in range(0, len(points) - 2, STRETCH):
        x = points[low : low + STRETCH + 2].astype(np.int64)
        yield ((x[:-2] * STEP + x[1:-1]) * STEP + x[2:]) % MODULUS % BUCKETS


def repeated_words(words: list[bytes]) -> int:
    """Words within three-word windows that the text holds twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    x = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    _, pair = np.unique(x[:-2] * len(numbers) + x[1:-1], return_inverse=True)
    _, window, count = np.unique(pair * len(numbers) + x[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def plain_counts(text: str) -> tuple[list[bytes], tuple[int, ...]]:
    """The words, and (words, their code points, symbols, repeated lines, repeated words)."""
    raw = text.encode()
    words = raw.split()
    letters = sum(map(len, words)) - sum(len(w) - len(w.decode()) for w in words if not w.isascii())
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.split(None, 1)]
    return words, (len(words), letters, symbols, len(lines) - len(set(lines)), repeated_words(words))


def bucket_counts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Rows (bucket, raw, trusted): n-grams of all documents, and of those whose doc_id is in ``trusted``."""
    mark = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("_trusted", F.lit(True))
    marked = docs.select("doc_id", "text").where("text IS NOT NULL").join(mark.hint("merge"), "doc_id", "left").select("text", "_trusted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, known in zip(texts_of(batch), batch.column("_trusted").to_pylist(), strict=True):
                for buckets in bucket_runs(text.encode().split()):
                    own = np.bincount(buckets, minlength=BUCKETS)
                    counts[0] += own
                    if known:
                        counts[1] += own
        seen = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (seen, *counts[:, seen])], names=["bucket", "raw", "trusted"])

    partial = marked.mapInArrow(run, "bucket bigint, raw bigint, trusted bigint")
    return partial.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """ln(share among trusted / share in the corpus) of every bucket."""
    raw, trusted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.collect():  # one row per bucket at most
        raw[row["bucket"]], trusted[row["bucket"]] = row["raw"], row["trusted"]
    if not trusted.any():
        return np.zeros(BUCKETS)
    share = lambda c: (c + SMOOTH) / (c.sum() + SMOOTH * BUCKETS)
    return np.log(share(trusted)) - np.log(share(raw))


SCORED = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, score double, kept boolean"
)


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, the plain counts, base_failed, score, kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                words, plain = plain_counts(text)
                total, n = 0.0, 0
                for buckets in bucket_runs(words):
                    total, n = total + float(ratios[buckets].sum()), n + len(buckets)
                score = round(total / n, 6) if n else 0.0
                failed = plain[0] < LEAST_WORDS or 100 * plain[4] > MOST_REPEATED * plain[0]
                rows.append((doc_id, *plain, failed, score, not failed and score >= threshold))
            kinds = [*[pa.int64()] * 6, pa.bool_(), pa.float64(), pa.bool_()]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in SCORED.split(", ")])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SCORED)


def filter_quality(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Learn from all documents and judge each of them; ``trusted`` has the doc_ids of trusted ones."""
    return judge(docs, log_ratios(bucket_counts(docs, trusted)), threshold)
