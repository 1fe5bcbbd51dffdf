"""Sequences of tokens that never cross documents: every document is cut into pieces whose lengths are powers of two.

A document's ids, with an end id, are cut into as many pieces of ``longest`` ids as fit, and the rest into the powers of
two of its binary form, the largest first. Every piece is a sequence of its own; sequences of one length form a bucket,
from which batches can be drawn without any padding.

The tokenizer lower-cases a text, cuts it into words, digits and runs of signs, drops white space and never looks across
these cuts. So each distinct word is tokenised once for as long as a worker remembers it, and the ids are those of the
whole text. Where a text has characters whose class or lower case could differ between libraries (all beyond Latin),
what stands between two spaces there goes to the tokenizer as it is. Ids are made where the rows lie: there is no
shuffle, and memory holds some texts at a time.

Null and empty texts are a single end id. Rows that repeat a doc_id are documents of their own. An empty table gives no
pieces. Further columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import texts_of

LONGEST = 4096
END = 2
TOKENIZER = "word_bpe_49k.json"
#: Characters of the words that a worker remembers, and of the texts that it works on at a time.
REMEMBERED, AT_ONCE = 4_000_000, 2_000_000
#: Up to here a character is its own composed form, and its lower case is one such character.
SIMPLE = 0x130
#: str.split() takes the first of these as white space, the tokenizer doesn't; the second begins its special tokens.
ODD = re.compile("[\x1c-\x1f]")
SPECIAL = "<|"
BEYOND = re.compile(f"[^\\x00-{chr(SIMPLE - 1)}]")


def _class(initial: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(SIMPLE) if unicodedata.category(chr(c))[0] == initial)


#: The tokenizer's own cuts, for characters below SIMPLE.
CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^\\s{_class('L')}{_class('N')}]+")

PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def words_of(text: str) -> list[str]:
    """What the tokenizer treats on its own, in order; a leading space marks what it must cut itself."""
    if SPECIAL not in text and not ODD.search(text):
        if not BEYOND.search(text):
            return CUT.findall(text.lower())
        out: list[str] = []
        for run in text.split():
            if BEYOND.search(run):
                out.append(" " + run)
            else:
                out += CUT.findall(run.lower())
        return out
    return [" " + text]


class Words(dict):
    """Numbers words; looking a new one up notes it as pending."""

    def __init__(self) -> None:
        self.pending: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.pending.append(word)
        return number


class Encoder:
    """Token ids of texts, with a bounded memory of words."""

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.words, self.size = Words(), 0
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def learn(self) -> None:
        new, self.words.pending = self.words.pending, []
        raw = [k for k, w in enumerate(new) if w[0] == " "]
        plain = [w for w in new if w[0] != " "] if raw else new
        lines = [" ".join(plain[k : k + 500]) for k in range(0, len(plain), 500)]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)), np.uint32)
        lengths = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)  # each word ends with one id of its own kind
        assert len(lengths) == len(plain)
        if raw:
            kept = np.ones(len(new), bool)
            kept[raw] = False
            found = [e.ids for e in self.tokenizer.encode_batch_fast([new[k][1:] for k in raw], add_special_tokens=False)]
            every = np.zeros(len(new), np.int64)
            every[kept], every[raw] = lengths, [len(x) for x in found]
            owner = np.repeat(kept, every)
            both = np.empty(len(owner), np.uint32)
            both[owner], both[~owner] = ids, np.fromiter(chain.from_iterable(found), np.uint32)
            ids, lengths = both, every
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.size += sum(map(len, new))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and where each text begins (one more entry than texts)."""
        if self.size > REMEMBERED:
            self.forget()
        split = list(map(words_of, texts))
        n_words = np.array([len(x) for x in split], dtype=np.int64)
        numbers = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, int(n_words.sum()))
        if self.words.pending:
            self.learn()
        begin, lengths = self.starts[numbers], self.starts[numbers + 1] - self.starts[numbers]
        at = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.repeat(begin - at[:-1], lengths) + np.arange(at[-1])]
        return ids, at[np.concatenate([[0], np.cumsum(n_words)])]


@lru_cache(maxsize=1)
def encoder_of(path: str | None) -> Encoder:
    """One per worker, so that the words of one task serve the next."""
    return Encoder(path)


@lru_cache(maxsize=1 << 14)
def binary_pieces(n: int, longest: int = LONGEST) -> tuple[tuple[int, int], ...]:
    """(start, length) of the pieces of n ids."""
    lengths = [longest] * (n // longest) + [1 << k for k in reversed(range((longest - 1).bit_length())) if (n % longest) >> k & 1]
    return tuple(zip(np.cumsum([0, *lengths[:-1]]).tolist(), lengths, strict=True)) if lengths else ()


def slices(texts: list[str], most: int = AT_ONCE) -> Iterator[slice]:
    """Runs of texts with about ``most`` characters."""
    low = size = 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield slice(low, k + 1)
            low, size = k + 1, 0
    if low < len(texts):
        yield slice(low, len(texts))


def pack(docs: DataFrame, longest: int = LONGEST, end: int = END, tokenizer_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket (and ids).

    ``tokenizer_path`` must be readable on every executor; by default the installed vocabulary is looked up there.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), texts_of(batch)
            for part in slices(texts):
                ids, at = encoder.encode(texts[part])
                rows, kept = [], []
                for k, doc in enumerate(doc_ids[part]):
                    own = np.append(ids[at[k] : at[k + 1]], np.uint32(end)).astype("<u4")
                    for start, length in binary_pieces(len(own), longest):
                        piece = own[start : start + length]
                        rows.append((doc, start, length, zlib.crc32(piece.tobytes()), len(own)))
                        if with_ids:
                            kept.append(piece)
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                if with_ids:
                    flat = np.concatenate(kept).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(np.cumsum([0, *map(len, kept)]).astype(np.int32), flat))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids])

    pieces = docs.select("doc_id", "text").mapInArrow(run, PIECE + ", ids array<int>" * with_ids)
    numbered = pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint"))
    return numbered.withColumn("bucket", F.col("length"))


def write_buckets(docs: DataFrame, path: str, **options) -> None:
    """Write the sequences with their ids, one folder per length, from which batches need no padding."""
    pack(docs, with_ids=True, **options).write.partitionBy("bucket").parquet(path)
