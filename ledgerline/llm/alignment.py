"""Alignment of two tokenizers' tokens by bytes, with corpus-wide counts of the id pairs that meet.

A text is read with one space before it, by a byte-level tokenizer (A) and by a piece model with byte fallback (B), which
adds that space itself. Spans give coarse cuts: character offsets of A are turned to bytes, spans of B's pieces are
bytes already. Where a span isn't as wide as the token's decoded bytes - characters of several bytes that A splits, and
B's fallback bytes - decoded bytes place the cut. Wherever tokens of both end, a group ends; a link is a pair of token
occurrences whose byte ranges overlap. All cuts of both tokenizers part the bytes into stretches, and each stretch lies
in exactly one token of A and one of B, which are the links.

Neither tokenizer joins what stands on both sides of the start of a run of white space (the pieces are searched for such
cases; characters like the carriage return, which some piece has within it, make a text be read in one go). So a text
is cut there into units, and each distinct unit is tokenised and aligned once for as long as a worker remembers it.

A pair's count is the number of documents that hold it linked. Documents are dealt into as many groups as the shuffle has
partitions. The first pass reads the texts of a group and writes three things: its pairs and in how many documents they
are, its units with their pairs, and its documents as lists of units. Windows add the pairs up where they lie, without a join,
and each row goes back to its group, so that each task of the second pass gets the counts of its own pairs only: it sums them per unit and per document, without
the texts, and no table of all pairs is sent to everyone.

Texts that are null or empty, or whose joined bytes of A or B differ from space+text (such as those with U+2581), have no
tokens: zeros and ''. Rows that repeat a doc_id are documents of their own. Equal counts are all best. Very long texts are
read whole. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import partitions_for, texts_of
from ledgerline.llm.packing import Words, slices
from ledgerline.session import pin

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters that the tokenizers take as white space, and the piece model's own sign for a space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SIGN = "▁"
SPACES = {chr(c) for c in range(0x3001) if re.match(f"[{WHITE}]", chr(c))}
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
INNER = re.compile(f"[^{WHITE}{SIGN}]([{WHITE}{SIGN}])")
#: Characters of the units that a worker remembers; pairs that it counts before it adds them up.
REMEMBERED, COUNTED = 6_000_000, 1_000_000
#: Units that are tokenised in one line, and the word that stands before a line which doesn't begin with a space.
LINE, DROPPED = 100, b" a"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Read(NamedTuple):
    """Tokens of a line: ids of A, their character offsets, ids of B, their ends in bytes."""

    a_ids: list[int]
    offsets: list[tuple[int, int]]
    b_ids: list[int]
    b_ends: list[int]


def refined(spans: np.ndarray, widths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ends of tokens: those of the spans, and by decoded bytes wherever a span isn't as wide as its token.

    ``spans`` has the coarse ends; ``starts`` the end of the token before, by decoded bytes.
    """
    return np.where(spans - starts == widths, spans, starts + widths)


class Tokens:
    """Both tokenizers, and the units that were aligned so far."""

    def __init__(self, a_path: str | None = None, b_path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        if a_path is None or b_path is None:
            import public_tokenizers

            a_path = a_path or public_tokenizers.path(A_FILE)
            b_path = b_path or public_tokenizers.path(B_FILE)
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.a_bytes[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(SIGN, " ").encode() for k, p in enumerate(pieces)]
        self.a_width, self.b_width = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.shift = len(pieces).bit_length()
        # White space within a piece after something else: units can't be cut before it.
        inner = {c for k, p in enumerate(pieces) if not self.b.is_byte(k) for c in INNER.findall(p)}
        self.whole = re.compile("[" + "".join(map(re.escape, {SIGN, *inner})) + "]") if SIGN not in inner and " " not in inner else re.compile("")
        self.code_bits = self.shift + len(self.a_bytes).bit_length()
        self.generation = 0
        self.forget()

    def forget(self) -> None:
        self.units = Words()
        self.generation += 1
        self.size = 0
        self.fragments: list[str] = []
        self.bad = np.zeros(0, bool)
        self.numbers = np.zeros((4, 0), np.int64)  # tokens of A, tokens of B, groups, links
        self.pairs, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def units_of(self, text: str) -> list[str]:
        if not text:
            return []
        line = " " + text
        return [line] if self.whole.search(line) else UNIT.findall(line)

    def tokenised(self, line: str, proto: Any, encoding: Any, drop: int) -> Read | None:
        """Tokens of a line behind its first ``drop`` bytes, one token of each; None where the joined bytes differ."""
        first, shift = (1, -1) if drop else (0, 1)
        a_ids, b = encoding.ids, [(p.id, p.end) for p in proto.pieces][first:]
        raw = line.encode()
        if b"".join([self.a_bytes[k] for k in a_ids]) != DROPPED * bool(drop) + raw or b"".join([self.b_bytes[k] for k, _ in b]) != raw:
            return None
        return Read(a_ids[first:], encoding.offsets[first:], [k for k, _ in b], [e + shift for _, e in b])

    def read_lines(self, lines: list[str]) -> list[Read | None]:
        """Both tokenizers on lines that begin with white space.

        B adds a space to what it reads. A line that begins with a space and has more is read without that space; the
        others stand behind a word of one letter, whose token is dropped.
        """
        spaced = [x[0] == " " and len(x) > 1 for x in lines]
        asked = [x if s else DROPPED.decode() + x for x, s in zip(lines, spaced, strict=True)]
        encodings = self.a.encode_batch(asked, add_special_tokens=False)
        protos = self.b.encode([x[1:] for x in asked], return_type="proto", num_threads=1)
        return [self.tokenised(x, p, e, 0 if s else len(DROPPED)) for x, p, e, s in zip(lines, protos, encodings, spaced, strict=True)]

    def learn(self) -> None:
        """Tokenise and align what is pending: many units in a line, and one by one where a line can't hold them."""
        units, self.units.pending = self.units.pending, []
        if not units:
            return
        alone = [k for k, u in enumerate(units) if u[-1] in SPACES or self.whole.search(u)]
        apart = set(alone)
        joined = [k for k in range(len(units)) if k not in apart] if alone else list(range(len(units)))
        joined = [joined[k : k + LINE] for k in range(0, len(joined), LINE)]
        found = self.read_lines(["".join([units[k] for k in line]) for line in joined])
        alone += [k for line, got in zip(joined, found, strict=True) if got is None for k in line]
        held = [(line, got) for line, got in zip(joined, found, strict=True) if got is not None]
        held += [([k], got) for k, got in zip(alone, self.read_lines([units[k] for k in alone]), strict=True) if got is not None]
        n_old, n_new = len(self.bad), len(units)
        bad = np.ones(n_new, bool)
        order = np.array([k for line, _ in held for k in line], np.int64)
        bad[order] = False
        numbers, starts = np.zeros((4, n_new), np.int64), np.zeros(n_new, np.int64)
        self.fragments += [""] * n_new
        if held:
            at = np.cumsum([len(units[k].encode()) for k in order.tolist()])
            a_ids, b_ids, a_ends, b_ends = self.ends([got for _, got in held], ["".join([units[k] for k in line]) for line, _ in held])
            both = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
            again = both[1:] == both[:-1]
            cuts, shared = both[np.append(~again, True)], both[1:][again]
            # Tokens, groups and links belong to the unit whose bytes they lie in.
            owned = [np.bincount(np.searchsorted(at, ends), minlength=len(order)) for ends in (a_ends, b_ends, shared, cuts)]
            numbers[:, order] = owned
            starts[order] = len(self.pairs) + np.cumsum(owned[3]) - owned[3]
            # Each stretch between cuts lies in one token of A and one of B.
            links = a_ids[np.searchsorted(a_ends, cuts)] << self.shift | b_ids[np.searchsorted(b_ends, cuts)]
            self.pairs = np.concatenate([self.pairs, links])
            for k, text in zip(order.tolist(), texts_of_groups(a_ids, a_ends, b_ids, b_ends, shared, owned[2]), strict=True):
                self.fragments[n_old + k] = text
        self.bad, self.numbers, self.starts = np.concatenate([self.bad, bad]), np.concatenate([self.numbers, numbers], axis=1), np.concatenate([self.starts, starts])
        self.size += sum(map(len, units))

    def ends(self, held: list[Read], lines: list[str]) -> tuple[np.ndarray, ...]:
        """Ids of A and B and the ends of their tokens, all lines in one row of bytes."""

        def flat(lists: list[list[int]]) -> np.ndarray:
            return np.fromiter(chain.from_iterable(lists), np.int64)

        a_ids, b_ids = flat([x.a_ids for x in held]), flat([x.b_ids for x in held])
        # Character offsets of A to bytes; a line that stood behind a word is shorter by it.
        points = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4")
        byte_at = np.concatenate([[0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))])
        chars = np.cumsum([0, *map(len, lines)])
        begin = [c - (len(DROPPED) if x.offsets and x.offsets[0][0] >= len(DROPPED) else 0) for c, x in zip(chars[:-1].tolist(), held, strict=True)]
        spans = flat([[y for _, y in x.offsets] for x in held]) + np.repeat(begin, [len(x.a_ids) for x in held])
        b_spans = flat([x.b_ends for x in held]) + np.repeat(byte_at[chars[:-1]], [len(x.b_ids) for x in held])
        a_wide, b_wide = self.a_width[a_ids], self.b_width[b_ids]
        return a_ids, b_ids, refined(byte_at[spans], a_wide, np.cumsum(a_wide) - a_wide), refined(b_spans, b_wide, np.cumsum(b_wide) - b_wide)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of all texts, one text after the other, and where each text begins (one entry more)."""
        if self.size > REMEMBERED:
            self.forget()
        split = list(map(self.units_of, texts))
        at = np.concatenate([[0], np.cumsum([len(x) for x in split], dtype=np.int64)])
        numbers = np.fromiter(map(self.units.__getitem__, chain.from_iterable(split)), np.int64, int(at[-1]))
        self.learn()
        return numbers, at

    def spread(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of the given units, one unit after the other, and how many each has."""
        n = self.numbers[3, units]
        first = np.repeat(self.starts[units] - (np.cumsum(n) - n), n)
        return self.pairs[first + np.arange(n.sum())], n


def texts_of_groups(a_ids: np.ndarray, a_ends: np.ndarray, b_ids: np.ndarray, b_ends: np.ndarray, shared: np.ndarray, groups: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2`` for each unit; ``groups`` has how many groups each has."""
    a, b = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
    a_to, b_to = (np.searchsorted(ends, shared, side="right").tolist() for ends in (a_ends, b_ends))
    texts, i, j = [], 0, 0
    for x, y in zip(a_to, b_to, strict=True):
        texts.append(f"{a[i]}|{b[j]}" if x == i + 1 and y == j + 1 else ",".join(a[i:x]) + "|" + ",".join(b[j:y]))
        i, j = x, y
    out, low = [], 0
    for n in groups.tolist():
        out.append(texts[low] if n == 1 else ";".join(texts[low : low + n]))
        low += n
    return out


@lru_cache(maxsize=1)
def tokens_of(a_path: str | None, b_path: str | None) -> Tokens:
    """One per worker, so that the units of one task serve the next."""
    return Tokens(a_path, b_path)


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of stretches; empty stretches are 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


def without_bad(tokens: Tokens, numbers: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts that hold a unit whose bytes differ lose all their units."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    broken = np.zeros(len(at) - 1, bool)
    broken[owner[tokens.bad[numbers]]] = True
    kept = ~broken[owner]
    return numbers[kept], np.concatenate([[0], np.cumsum(np.where(broken, 0, np.diff(at)))])


def dealt(docs: DataFrame, groups: int) -> DataFrame:
    """Documents with the number of their group, which follows from id and text."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("g"))


KINDS = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
#: What the first pass writes, by kind: 0 pairs of a group and in how many of its documents; 1 units, numbered from
#: ``first``, with the sizes (body) and codes of their pairs; 2 documents with the numbers of their units (body).
READ = "g int, kind int, first bigint, a int, b int, n bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, body binary, codes binary"


def rows_of(schema: str, rows: int, /, **given: Any) -> pa.RecordBatch:
    """So many rows of the schema; columns that aren't given are null."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    arrays = [pa.array(given[c], KINDS[k]) if c in given else pa.nulls(rows, KINDS[k]) for c, k in zip(names, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


class Group:
    """What the first pass knows of one group: numbers of its own for the units, and counts of pairs."""

    def __init__(self, g: int):
        self.g, self.next = g, 0
        self.generation, self.own = -1, np.zeros(0, np.int64)
        self.counted: list[tuple[np.ndarray, np.ndarray]] = []

    def read(self, tokens: Tokens, doc_ids: list[int | None], texts: list[str]) -> Iterator[pa.RecordBatch]:
        numbers, at = without_bad(tokens, *tokens.read(texts))
        if self.generation != tokens.generation:  # forgotten units get another number when they are met again
            self.generation, self.own = tokens.generation, np.zeros(0, np.int64)
        self.own = np.concatenate([self.own, np.full(len(tokens.units) - len(self.own), -1)])
        owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
        once = np.unique(owner * max(len(tokens.units), 1) + numbers)  # each unit once per document
        doc, unit = np.divmod(once, max(len(tokens.units), 1))
        seen = np.unique(unit)
        new = seen[self.own[seen] < 0]
        self.own[new] = self.next + np.arange(len(new))
        if len(new):
            codes, sizes = tokens.spread(new)
            yield rows_of(READ, 1, g=[self.g], kind=[1], first=[self.next], body=[sizes.astype("<i4").tobytes()], codes=[codes.astype("<i8").tobytes()])
            self.next += len(new)
        self.count(tokens, doc, unit)
        fragments, listed, edges = tokens.fragments, numbers.tolist(), at.tolist()
        digests = [hashlib.sha256(";".join([fragments[k] for k in listed[lo:hi]]).encode()).hexdigest() if hi > lo else "" for lo, hi in pairwise(edges)]
        own = self.own[numbers].astype("<i4")
        sizes = dict(zip(("n_a", "n_b", "n_groups", "n_links"), (sums(x[numbers], at) for x in tokens.numbers), strict=True))
        n = len(texts)
        yield rows_of(READ, n, g=[self.g] * n, kind=[2] * n, first=[0] * n, doc_id=doc_ids, groups_sha256=digests, body=[own[lo:hi].tobytes() for lo, hi in pairwise(edges)], **sizes)

    def count(self, tokens: Tokens, doc: np.ndarray, unit: np.ndarray) -> None:
        pairs, n = tokens.spread(unit)
        held = np.sort(np.repeat(doc, n) << tokens.code_bits | pairs)
        held = held[np.append(True, held[1:] != held[:-1])[: len(held)]] & ((1 << tokens.code_bits) - 1)
        self.counted.append(np.unique(held, return_counts=True))
        if sum(len(c) for c, _ in self.counted) > COUNTED + 2 * len(self.counted[0][0]):
            self.counted = [self.total()]

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        codes, inverse = np.unique(np.concatenate([c for c, _ in self.counted]), return_inverse=True)
        return codes, np.bincount(inverse, np.concatenate([n for _, n in self.counted]), len(codes)).astype(np.int64)

    def pairs(self, shift: int) -> Iterator[pa.RecordBatch]:
        codes, counts = self.total()
        for low in range(0, len(codes), 50_000):
            c, n = codes[low : low + 50_000], counts[low : low + 50_000]
            yield rows_of(READ, len(c), g=np.full(len(c), self.g), kind=np.zeros(len(c), np.int32), a=c >> shift, b=c & ((1 << shift) - 1), n=n)


def read_groups(docs: DataFrame, groups: int, a_path: str | None, b_path: str | None) -> DataFrame:
    """The first pass: both tokenizers on every document, group by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(a_path, b_path)
        states: dict[int, Group] = {}
        for batch in batches:
            own, ids, texts = batch.column("g").to_numpy(), batch.column("doc_id").to_pylist(), texts_of(batch)
            for g in np.unique(own).tolist():
                mine = np.flatnonzero(own == g).tolist()
                group = states.setdefault(g, Group(g))
                for part in slices([texts[k] for k in mine]):
                    yield from group.read(tokens, [ids[k] for k in mine[part]], [texts[k] for k in mine[part]])
        for group in states.values():
            yield from group.pairs(tokens.shift)

    return dealt(docs, groups).repartitionById(groups, F.col("g")).mapInArrow(run, READ)


def counted(batches: Iterator[pa.RecordBatch], shift: int) -> Iterator[pa.RecordBatch]:
    """The second pass over rows sorted by group, kind and number: sums of the units' pairs, then of the documents' units."""
    at = None
    for batch in batches:
        marks = np.stack([batch.column(c).to_numpy() for c in ("g", "kind")])
        edges = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for low, high in pairwise(edges):
            part, (g, kind) = batch.slice(low, high - low), marks[:, low].tolist()
            if g != at:
                at, table, codes, units = g, [], None, [np.zeros((2, 0), np.int64)]
            if kind == 0:
                table.append(part.select(["a", "b", "count", "best"]))
                continue
            if codes is None:
                a, b, best, count = (np.concatenate([np.zeros(0, np.int64), *(x.column(c).to_numpy(zero_copy_only=False) for x in table)]) for c in ("a", "b", "best", "count"))
                codes = a << shift | b
                order = np.argsort(codes)
                codes, values = codes[order], np.stack([best, count])[:, order]
            if kind == 1:
                for sizes, own in zip(part.column("body").to_pylist(), part.column("codes").to_pylist(), strict=True):
                    edge = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, "<i4"))])
                    found = values[:, np.searchsorted(codes, np.frombuffer(own, "<i8"))]
                    units.append(np.stack([sums(x, edge) for x in found]))
                continue
            units = [np.concatenate(units, axis=1)]
            bodies = part.column("body").to_pylist()
            edge = np.cumsum([0, *(len(x) // 4 for x in bodies)])
            best, total = (sums(x, edge) for x in units[0][:, np.frombuffer(b"".join(bodies), "<i4")])
            given = {c: part.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            yield rows_of(ALIGNED, part.num_rows, n_best=best, count_sum=total, **given)


def align_tokens(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per document with the numbers of tokens, groups and links, best links, counts and the groups' digest.

    The paths must be readable on every executor; by default the installed vocabularies are looked up there.
    """
    groups = partitions_for(docs.sparkSession)
    shift = Tokens(a_path, b_path).shift
    read = pin(read_groups(docs, groups, a_path, b_path), "aligned")
    # One row per group and pair; an id of A has no more of them than there are groups and ids of B, however many documents.
    held = read.where("kind = 0").select("g", "kind", "first", "a", "b", "n").repartition("a")
    counted_pairs = held.withColumn("count", F.sum("n").over(Window.partitionBy("a", "b"))).drop("n")
    asked = counted_pairs.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))
    rest = read.where("kind > 0").drop("a", "b", "n")
    both = asked.unionByName(rest, allowMissingColumns=True).repartitionById(groups, F.col("g")).sortWithinPartitions("g", "kind", "first")
    return both.mapInArrow(lambda batches: counted(batches, shift), ALIGNED)
