"""Maximal repeats of long byte strings across documents, by common-prefix intervals of enhanced suffix arrays.

Every string of ``length`` bytes has an anchor: of its ``GRAM``-byte substrings the one with the smallest hash, the
leftmost of several. Equal strings have equal anchors at equal places, so they meet when rows are dealt by the anchor's
hash. Neighbouring strings of a document with one anchor form a run, whose bytes are a piece of the document.

1. Tasks cut their texts into runs (numpy). Runs with the same bytes are merged per slice of texts before the shuffle,
   so that a passage on a third of all rows reaches its anchor as a row per slice.
2. Runs meet by anchor. Of equal runs all but the first are repeats as a whole. An anchor with one run is done.
3. Runs of an anchor that differ are fetched from the texts and sorted as an enhanced suffix array: all their suffixes
   of ``length`` bytes and more in order, with the common prefix of neighbours. A stack scan walks its interval tree;
   an interval whose occurrences have different bytes on the left (or begin a run) can't be extended and is a maximal
   repeat group, passed on with all its occurrences; the others lie inside a wider one.
   Runs of a heavy anchor are cut into their strings of ``length`` bytes instead, which meet by their own hash as runs do
   in steps 1 and 2, so that no task holds such an anchor.
4. Bytes covered by an occurrence that isn't its group's first (smallest doc_id, then start) are removed.

Runs clip repeats, so a long repeat is found as a chain of overlapping groups; what they cover is the same. Null texts
count as empty; texts shorter than ``length`` have no such string. Rows that repeat a doc_id with its text are one
document and get the same result; a null doc_id takes no part and stays whole. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import mix64, partitions_for, sorted_groups, texts_of
from ledgerline.llm.packing import slices
from ledgerline.session import pin

LENGTH, GRAM = 100, 32
#: Characters of the texts that are cut into runs at a time, and runs whose suffixes are sorted at a time (an anchor with
#: more is heavy).
AT_ONCE, RUNS = 3_000_000, 3_000
BASE = 0x5851F42D4C957F2D
BYTES = mix64(np.arange(1, 257, dtype=np.uint64))

RUN = "k bigint, h bigint, doc_id bigint, start int, size int"
SPAN = "doc_id bigint, start int, size int"


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def runs_of(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, hash of the bytes, begin and end of all runs of a buffer; runs may cross its documents."""
    n = len(data)
    if n < length:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    up, down = powers(1 << max(16, n.bit_length()))
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(BYTES[data] * up[:n], out=total[1:])
    hashes = mix64((total[gram:] - total[:-gram]) * down[: n - gram + 1])
    place = np.uint64((1 << max(1, int(n).bit_length())) - 1)
    least = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    width, wide = 1, length - gram + 1
    while width * 2 <= wide:  # least[i] is the smallest of the ``width`` hashes from i on
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wide:
        least = np.minimum(least[: -(wide - width)], least[wide - width :])
    anchor = (least & place).astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    end = np.append(begin[1:], len(anchor)) - 1 + length
    body = mix64((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
    return hashes[anchor[begin]], body, begin, end


def clipped_runs(bodies: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, hash of the bytes, document, start and size of the runs of each document."""
    parts = []
    for k, body in enumerate(bodies):
        if len(body) >= length:
            anchor, h, begin, end = runs_of(np.frombuffer(body, np.uint8), length, gram)
            parts.append((anchor, h, np.full(len(begin), k), begin, end - begin))
    if not parts:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def joined(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of each document made one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    number = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    shift = number * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate([[True], (start + shift)[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    return doc[first], start[first], (reach - shift)[np.append(first[1:], len(doc)) - 1]


def cut(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Runs (k: anchor) that come first in their slice of texts, and spans (size below 0) of all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_numpy(), texts_of(batch)
            for part in slices(texts, AT_ONCE):
                own = ids[part]
                k, h, doc, start, size = clipped_runs([t.encode("utf-8", "surrogatepass") for t in texts[part]], length, gram)
                doc = own[doc]
                order = np.lexsort((start, doc, h, k))
                k, h, doc, start, size = (c[order] for c in (k, h, doc, start, size))
                same = np.concatenate([[False], (k[1:] == k[:-1]) & (h[1:] == h[:-1])]) if len(k) else np.zeros(0, bool)
                lead = np.flatnonzero(~same)[np.cumsum(~same) - 1] if len(k) else np.zeros(0, np.int64)
                again = (doc != doc[lead]) | (start != start[lead])
                s_doc, s_start, s_end = joined(doc[again], start[again], start[again] + size[again])
                keep = ~same
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([k[keep].view(np.int64), mix64(s_doc.astype(np.uint64)).view(np.int64)])),
                        pa.array(np.concatenate([h[keep].view(np.int64), np.zeros(len(s_doc), np.int64)])),
                        pa.array(np.concatenate([doc[keep], s_doc])),
                        pa.array(np.concatenate([start[keep], s_start]).astype(np.int32)),
                        pa.array(np.concatenate([size[keep], s_start - s_end]).astype(np.int32)),
                    ],
                    names=["k", "h", "doc_id", "start", "size"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, RUN)


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs in the order of anchor, bytes and place: spans (k null), and the first runs of anchors with several."""
    lead, turn = None, 0  # the last first run, and how many others its anchor had before
    for batch in batches:
        k, h, doc, start, size = (batch.column(c).to_numpy() for c in ("k", "h", "doc_id", "start", "size"))
        run = size > 0
        none = np.zeros((~run).sum(), np.int64)
        out = [(doc[~run], start[~run], -size[~run], none, none > 0)]
        k, h, doc, start, size = (c[run] for c in (k, h, doc, start, size))
        if len(k):
            seen = lead is not None
            if seen:
                k, h, doc, start, size = (np.concatenate([[x], c]) for x, c in zip(lead, (k, h, doc, start, size), strict=True))
            new_k = np.concatenate([[True], k[1:] != k[:-1]])
            new_h = new_k | np.concatenate([[True], h[1:] != h[:-1]])
            firsts = np.flatnonzero(new_h)
            opens = np.flatnonzero(new_k[firsts])
            place = np.arange(len(firsts)) - opens[np.cumsum(new_k[firsts]) - 1]
            place[: opens[1] if len(opens) > 1 else None] += turn if seen else 0
            at = firsts[np.cumsum(new_h) - 1]
            again = np.flatnonzero((doc != doc[at]) | (start != start[at]))
            out.append((doc[again], start[again], size[again], np.zeros(len(again), np.int64), np.zeros(len(again), bool)))
            shown = place >= 1
            shown[0] &= not seen
            second = np.flatnonzero(shown & (place == 1))
            f = firsts[np.concatenate([np.flatnonzero(shown), second - 1])]
            out.append((doc[f], start[f], size[f], k[f], np.ones(len(f), bool)))
            lead, turn = tuple(c[firsts[-1]] for c in (k, h, doc, start, size)), int(place[-1])
        doc, start, size, k, shown = (np.concatenate(c) for c in zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(start, pa.int32()), pa.array(size, pa.int32()), pa.array(k, pa.int64(), mask=~shown)], names=["doc_id", "start", "size", "k"]
        )


def suffix_array(keys: np.ndarray, bodies: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Run and offset of all long enough suffixes in order of (key, bytes), and the common prefix with the one before."""
    sizes = np.array([len(b) for b in bodies])
    n_suffixes = sizes - length + 1
    run = np.repeat(np.arange(len(bodies)), n_suffixes)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(n_suffixes) - n_suffixes, n_suffixes)
    longest = int(sizes.max())
    flat = np.zeros((len(bodies), 2 * longest), np.uint8)
    for k, body in enumerate(bodies):
        flat[k, : len(body)] = np.frombuffer(body, np.uint8)
    rows = np.empty((len(run), 8 + longest), np.uint8)
    rows[:, :8] = keys.astype(">u8").view(np.uint8).reshape(-1, 8)[run]
    rows[:, 8:] = np.lib.stride_tricks.sliding_window_view(flat, longest, axis=1)[run, offset]
    order = np.argsort(rows.view(f"S{8 + longest}").ravel(), kind="stable")
    rows, run, offset = rows[order], run[order], offset[order]
    left = sizes[run] - offset
    differ = rows[1:] != rows[:-1]
    same = np.where(differ.any(1), differ.argmax(1), rows.shape[1]) - 8
    lcp = np.zeros(len(run), np.int64)
    lcp[1:] = np.minimum(np.maximum(same, 0), np.minimum(left[1:], left[:-1]))
    return run, offset, lcp


def intervals(lcp: list[int], before: list[int], length: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, end) of the intervals of ``length`` or more with different bytes before their suffixes.

    ``before`` is the byte on the left, or a number of its own below 0.
    """
    stack: list[list[int]] = []  # common prefix, first row, byte on the left (or MIXED)
    n = len(lcp)
    for row in range(1, n + 1):
        now = lcp[row] if row < n else 0
        first, byte = row - 1, before[row - 1]
        while stack and stack[-1][0] > now:
            depth, first, old = stack.pop()
            byte = old if old == byte else -1
            if byte < 0:
                yield depth, first, row
        if now >= length:
            if stack and stack[-1][0] == now:
                stack[-1][2] = byte if stack[-1][2] == byte else -1
            else:
                stack.append([now, first, byte])


def strings_of(doc: np.ndarray, start: np.ndarray, bodies: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document, start and size of the first of equal strings of ``length`` bytes in runs; the others as spans of size below 0."""
    sizes = np.array([len(b) for b in bodies])
    data = np.frombuffer(b"".join(bodies), np.uint8)
    up, down = powers(1 << max(16, len(data).bit_length()))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[data] * up[: len(data)], dtype=np.uint64)])
    count = sizes - length + 1
    run = np.repeat(np.arange(len(bodies)), count)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    at = (np.cumsum(sizes) - sizes)[run] + offset
    h, doc, start = mix64((total[at + length] - total[at]) * down[at]), doc[run], start[run] + offset
    order = np.lexsort((start, doc, h))
    h, doc, start = h[order], doc[order], start[order]
    same = np.concatenate([[False], h[1:] == h[:-1]])
    lead = np.flatnonzero(~same)[np.cumsum(~same) - 1]
    again = (doc != doc[lead]) | (start != start[lead])
    s_doc, s_start, s_end = joined(doc[again], start[again], start[again] + length)
    keep = ~same
    return (
        np.concatenate([h[keep], mix64(s_doc.astype(np.uint64))]).view(np.int64), np.concatenate([doc[keep], s_doc]),
        np.concatenate([start[keep], s_start]), np.concatenate([np.full(keep.sum(), length), s_start - s_end]),
    )


def repeated_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All but the first of equal strings, and spans, in the form of ``maximal_repeats``; one batch is held at a time."""
    lead = None
    for batch in batches:
        k, doc, start, size = (batch.column(c).to_numpy() for c in ("k", "doc_id", "start", "size"))
        span = size < 0
        out = [(k[span], -size[span], doc[span], start[span])]
        k, doc, start, size = (c[~span] for c in (k, doc, start, size))
        if len(k):
            if lead is not None:
                k, doc, start, size = (np.concatenate([[x], c]) for x, c in zip(lead, (k, doc, start, size), strict=True))
            same = np.concatenate([[False], k[1:] == k[:-1]])
            at = np.flatnonzero(~same)[np.cumsum(~same) - 1]
            again = (doc != doc[at]) | (start != start[at])
            out.append((k[again], size[again], doc[again], start[again]))
            lead = tuple(c[at[-1]] for c in (k, doc, start, size))
        k, size, doc, start = (np.concatenate(c) for c in zip(*out, strict=True))
        none = np.zeros(len(k), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k), pa.array(size.astype(np.int32)), pa.array(none), pa.array(doc), pa.array(start.astype(np.int32)), pa.array(none > 0)],
            names=["k", "size", "group", "doc_id", "start", "first"],
        )


def maximal_repeats(batches: Iterator[pa.RecordBatch], length: int = LENGTH) -> Iterator[pa.RecordBatch]:
    """Groups of occurrences: k, size, group (a number in k), doc_id, start, first (whether it is the group's first).

    Runs come first; rows without bytes after them are strings of heavy anchors, of which only repeats are passed on.
    """
    batches, rest = iter(batches), []

    def runs() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows - batch.column("body").null_count
            yield batch.slice(0, n)
            if n < batch.num_rows:
                rest.append(batch.slice(n))
                return

    serial = 0
    for rows in sorted_groups(runs(), "k", RUNS):
        k, doc, start = (rows.column(c).to_numpy() for c in ("k", "doc_id", "start"))
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1])])
        if not new.all():  # rows that repeat a doc_id gave its runs again
            rows, k, doc, start = rows.filter(pa.array(new)), k[new], doc[new], start[new]
        edges = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
        bodies = rows.column("body").to_pylist()
        low = 0
        while low < len(edges) - 1:  # whole anchors, some thousand runs at a time
            high = max(low + 1, int(np.searchsorted(edges, edges[low] + RUNS, side="right")) - 1)
            a, b = int(edges[low]), int(edges[high])
            low = high
            run, offset, lcp = suffix_array(k[a:b].view(np.uint64), bodies[a:b], length)
            run = run + a
            held = np.flatnonzero((lcp >= length) | np.append(lcp[1:] >= length, False))
            if not len(held):
                continue
            run, offset, lcp = run[held], offset[held], lcp[held]
            left = [bodies[r][o - 1] if o else -1 for r, o in zip(run.tolist(), offset.tolist(), strict=True)]
            d, s = doc[run], start[run] + offset
            found = list(intervals(np.where(lcp >= length, lcp, 0).tolist(), left, length))
            if not found:
                continue
            size = np.array([x[2] - x[1] for x in found])
            at = np.repeat([x[1] for x in found], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            group = np.repeat(np.arange(len(found)), size)
            order = np.lexsort((s[at], d[at], group))
            first = np.zeros(len(at), bool)
            first[order[np.concatenate([[0], np.cumsum(size)[:-1]])]] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(k[run[at]]), pa.array(np.repeat([x[0] for x in found], size).astype(np.int32)), pa.array(serial + group), pa.array(d[at]), pa.array(s[at].astype(np.int32)), pa.array(first)],
                names=["k", "size", "group", "doc_id", "start", "first"],
            )
            serial += len(found)
    yield from repeated_strings(chain(rest, batches))


GROUP = "k bigint, size int, group bigint, doc_id bigint, start int, first boolean"


def repeat_groups(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, heavy: int = RUNS) -> tuple[DataFrame, DataFrame]:
    """Whole runs that repeat an earlier one, as spans (doc_id, start, size); and the groups of ``maximal_repeats``."""
    spark = docs.sparkSession
    met = cut(docs, length, gram).repartition(partitions_for(spark), "k").sortWithinPartitions("k", "h", "doc_id", "start")
    met = pin(met.mapInArrow(meet, SPAN + ", k bigint"), "runs")
    shown = met.where("k IS NOT NULL")
    many = pin(shown.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy).select("k", F.lit(True).alias("heavy")), "heavy-anchors")
    wanted = shown.join(many, "k", "left").groupBy("doc_id").agg(F.collect_list(F.struct("k", "start", "size", "heavy")).alias("runs"))
    texts = docs.select("doc_id", "text").join(wanted.hint("merge"), "doc_id")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k", "doc_id", "start", "size", "body"]
        for batch in batches:
            ids, k, start, body = [], [], [], []
            cut_ids, cut_start, cut_body, held = [], [], [], 0
            before = None
            for doc, text, runs in zip(batch.column("doc_id").to_pylist(), texts_of(batch), batch.column("runs").to_pylist(), strict=True):
                if before == (doc, text):  # a row that repeats a doc_id
                    continue
                before = (doc, text)
                data = text.encode("utf-8", "surrogatepass")
                for r in runs:
                    piece = data[r["start"] : r["start"] + r["size"]]
                    if r["heavy"]:
                        cut_ids.append(doc)
                        cut_start.append(r["start"])
                        cut_body.append(piece)
                        held += len(piece)
                    else:
                        ids.append(doc)
                        k.append(r["k"])
                        start.append(r["start"])
                        body.append(piece)
                if held > AT_ONCE:
                    yield pa.RecordBatch.from_arrays(strings(cut_ids, cut_start, cut_body), names=names)
                    cut_ids, cut_start, cut_body, held = [], [], [], 0
            if held:
                yield pa.RecordBatch.from_arrays(strings(cut_ids, cut_start, cut_body), names=names)
            size = pa.array([len(b) for b in body], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(ids, pa.int64()), pa.array(start, pa.int32()), size, pa.array(body, pa.binary())], names=names)

    def strings(ids: list[int], start: list[int], body: list[bytes]) -> list[pa.Array]:
        k, doc, at, size = strings_of(np.array(ids), np.array(start), body, length)
        return [pa.array(k), pa.array(doc, pa.int64()), pa.array(at.astype(np.int32)), pa.array(size.astype(np.int32)), pa.nulls(len(k), pa.binary())]

    bodies = texts.mapInArrow(fetch, "k bigint, doc_id bigint, start int, size int, body binary")
    dealt = bodies.repartition(partitions_for(spark), "k").sortWithinPartitions(F.col("body").isNull(), "k", "doc_id", "start")
    groups = dealt.mapInArrow(lambda batches: maximal_repeats(batches, length), GROUP)
    return met.where("k IS NULL").select("doc_id", "start", "size"), groups


def removed_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, heavy: int = RUNS) -> DataFrame:
    """doc_id, spans: array of (start, size) that repeat earlier bytes; documents without any are not listed."""
    known = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    whole, groups = repeat_groups(known, length, gram, heavy)
    partly = groups.where(~F.col("first")).groupBy("doc_id", "start").agg(F.max("size").alias("size"))
    return whole.unionByName(partly).groupBy("doc_id").agg(F.collect_list(F.struct("start", "size")).alias("spans"))


def drop_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, heavy: int = RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes) of every document."""
    rows = docs.select("doc_id", "text").join(pin(removed_spans(docs, length, gram, heavy), "spans").hint("merge"), "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(texts_of(batch), batch.column("spans").to_pylist(), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                start = np.array([s["start"] for s in spans or ()], np.int64)
                size = np.array([s["size"] for s in spans or ()], np.int64)
                _, low, high = joined(np.zeros(len(start), np.int64), start, start + size)
                edges = [0, *np.stack([low, high], 1).ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(data), len(data) - len(kept), len(low), hashlib.sha256(kept).hexdigest(), kept))
            n, gone, spans, sha, kept = zip(*out, strict=True) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return rows.mapInArrow(run, schema)
