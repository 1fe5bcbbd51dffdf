"""Language of texts by a linear-chain conditional random field over their words.

A word's score per language is a sum of learned weights: its beginnings and endings, its letter pairs and triples, and
the word itself where the training texts have it often (the lexicon). Learned transitions tie neighbouring words, so
that code-switched text is labelled word by word; forward-backward gives each word's share per language. A text's
language has the largest mean share over all its words, which is also its score.

The training labels are those of documents. After half of the steps, the sentences of the training texts are labelled
anew where their words clearly speak another language than their document, so that transitions see real switches.
Chains are at most ``CHAIN`` words long; longer texts are several chains, none is cut off.

The fit sees a bounded sample (``Limits``), drawn per language, of the rows that aren't held out; prediction reads every whole text and
nothing but the text. Null texts and texts without a letter are ``und`` with score 0, as is everything when no row has a
language. Languages with equal shares go by their order in the alphabet. Repeated rows are judged alike; an empty table gives
an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import held_out, texts_of
from ledgerline.llm.packing import Words, slices

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"(?<=[.!?\n])\s+")
CHAIN = 64
#: Letters of a word at most (longer runs are cut), size of the table of weights, and words a task remembers.
LETTERS, TABLE, REMEMBERED = 24, 1 << 16, 300_000
UNKNOWN = "und"


@dataclass(frozen=True)
class Limits:
    """Bounds of the training sample: documents, languages (those of most rows), characters of a text, words of the lexicon."""

    documents: int = 1_200
    languages: int = 200
    characters: int = 20_000
    lexicon: int = 20_000


def words_of(text: str) -> list[str]:
    """Words of a text; a run of more than ``LETTERS`` letters is several that overlap by two, so that every triple counts."""
    found = WORD.findall(text)
    if max(map(len, found), default=0) <= LETTERS:
        return found
    return [w[k : k + LETTERS] for w in found for k in range(0, max(len(w) - 2, 1), LETTERS - 2)]


def word_features(words: list[str], lexicon: dict[str, int]) -> np.ndarray:
    """Indices of weights, one row per word; unused places point to the last weight, which stays 0."""
    n = len(words)
    c = np.array(words, dtype=f"U{LETTERS}").view(np.uint32).reshape(n, LETTERS).astype(np.uint64)
    length = np.minimum([len(w) for w in words], LETTERS)
    tail = np.array([w[-3:].rjust(3) for w in words], dtype="U3").view(np.uint32).reshape(n, 3).astype(np.uint64)
    none = TABLE + len(lexicon)
    place = lambda kind, value: ((value * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind * 0xC2B2AE3D27D4EB4F % 2**64)) >> np.uint64(48)).astype(np.int64)
    spots = np.arange(LETTERS)
    pairs = (c[:, :-1] << np.uint64(21)) + c[:, 1:]
    triples = (pairs[:, :-1] << np.uint64(21)) + c[:, 2:]
    tails = [tail[:, 2], (tail[:, 1] << np.uint64(21)) + tail[:, 2], (tail[:, 0] << np.uint64(42)) + (tail[:, 1] << np.uint64(21)) + tail[:, 2]]
    out = [
        np.where(spots[:-1] < length[:, None] - 1, place(1, pairs), none),
        np.where(spots[:-2] < length[:, None] - 2, place(2, triples), none),
        np.stack([place(3, c[:, 0]), place(4, pairs[:, 0]), place(5, triples[:, 0]), *(place(6 + k, t) for k, t in enumerate(tails))], axis=1),
        np.array([lexicon.get(w, none - TABLE) for w in words], dtype=np.int64)[:, None] + TABLE,
    ]
    return np.concatenate(out, axis=1).astype(np.int32)


def forward_backward(emission: np.ndarray, used: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares (chains, words, languages) and summed pair shares (languages, languages); ``used`` marks real words."""
    e = np.exp(emission - emission.max(axis=2, keepdims=True))
    e[~used] = 1
    m, (n, steps, k) = np.exp(move), emission.shape
    ahead, back = np.empty((steps, n, k)), np.empty((steps, n, k))
    now = np.exp(start - start.max()) * e[:, 0]
    ahead[0] = now / now.sum(1, keepdims=True)
    for t in range(1, steps):
        now = (ahead[t - 1] @ m) * e[:, t]
        now /= now.sum(1, keepdims=True)
        ahead[t] = np.where(used[:, t, None], now, ahead[t - 1])
    back[-1] = 1
    for t in range(steps - 2, -1, -1):
        now = (back[t + 1] * e[:, t + 1]) @ m.T
        now /= now.sum(1, keepdims=True)
        back[t] = np.where(used[:, t + 1, None], now, 1)
    share = ahead * back
    share /= share.sum(2, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(steps - 1):
        real = used[:, t + 1]
        left, right = ahead[t][real], (back[t + 1] * e[:, t + 1])[real]
        joint = left[:, :, None] * m * right[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    return share.transpose(1, 0, 2), pairs


def chains_of(numbers: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words laid out as chains: word numbers (chains, CHAIN), which of them are real, and the text of each chain."""
    n_chains = -(-per_text // CHAIN)
    text = np.repeat(np.arange(len(per_text)), n_chains)
    first = np.concatenate([[0], np.cumsum(per_text)])[:-1]
    turn = np.arange(len(text)) - np.repeat(np.cumsum(n_chains) - n_chains, n_chains)
    begin = first[text] + turn * CHAIN
    left = np.minimum(per_text[text] - turn * CHAIN, CHAIN)
    used = np.arange(CHAIN) < left[:, None]
    at = np.where(used, begin[:, None] + np.arange(CHAIN), 0)
    return (numbers[at] if len(numbers) else np.zeros(at.shape, np.int64)), used, text


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray
    lexicon: dict[str, int]
    start: np.ndarray
    move: np.ndarray

    def predictor(self):
        """A function from texts to (languages, scores) that remembers the scores of words."""
        known, table = Words(), np.zeros((0, len(self.languages)))

        def run(texts: list[str]) -> tuple[list[str], np.ndarray]:
            nonlocal known, table
            if not self.languages:
                return [UNKNOWN] * len(texts), np.zeros(len(texts))
            if len(known) > REMEMBERED:
                known, table = Words(), table[:0]
            split = [words_of(t.lower()) for t in texts]
            per_text = np.array([len(x) for x in split], dtype=np.int64)
            numbers = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64, int(per_text.sum()))
            new, known.pending = known.pending, []
            for low in range(0, len(new), 20_000):
                part = word_features(new[low : low + 20_000], self.lexicon)
                table = np.concatenate([table, self.weights[part].sum(1)])
            words, used, text = chains_of(numbers, per_text)
            mean = np.zeros((len(texts), len(self.languages)))
            for low in range(0, len(text), 4_000):
                cut = slice(low, low + 4_000)
                share, _ = forward_backward(table[words[cut]], used[cut], self.start, self.move)
                np.add.at(mean, text[cut], (share * used[cut, :, None]).sum(1))
            mean /= np.maximum(per_text, 1)[:, None]
            best = mean.argmax(1)
            names = [self.languages[b] if n else UNKNOWN for b, n in zip(best, per_text, strict=True)]
            return names, np.clip(mean.max(1), 0, 1)

        return run


def train(texts: list[str], langs: list[str], limits: Limits = Limits(), steps: int = 40, rate: float = 0.15, decay: float = 1e-6) -> Model:
    """Weights by Adam on the conditional likelihood of the labelled chains."""
    names = tuple(sorted(set(langs)))
    known: Words = Words()
    per_doc, numbers, sentence, doc_lang = [], [], [], []
    for text, lang in zip(texts, langs, strict=True):
        before = len(numbers)
        for part in SENTENCE.split(text.lower()):
            found = [known[w] for w in words_of(part)]
            sentence += [len(doc_lang)] * len(found)
            doc_lang.append(names.index(lang))
            numbers += found
        per_doc.append(len(numbers) - before)
    words = list(known)
    if not words:
        return Model((), np.zeros((0, 0)), {}, np.zeros(0), np.zeros((0, 0)))
    counts = Counter(numbers)
    lexicon = {words[k]: i for i, (k, _) in enumerate(x for x in counts.most_common(limits.lexicon) if x[1] >= 5)}
    features = np.concatenate([word_features(words[k : k + 20_000], lexicon) for k in range(0, len(words), 20_000)])
    numbers, sentence, doc_lang = np.array(numbers), np.array(sentence), np.array(doc_lang)
    at, used, _ = chains_of(np.arange(len(numbers)), np.array(per_doc))
    k, size, label = len(names), TABLE + len(lexicon) + 1, doc_lang[sentence]
    w, start, move = np.zeros((size, k)), np.zeros(k), np.zeros((k, k))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, start, move)]
    first = used[:, 0]
    for step in range(1, steps + 1):
        scores = w[features].sum(1)
        if step == steps // 2:  # sentences that speak another language than their document
            lean = np.stack([np.bincount(sentence, scores[numbers, j], len(doc_lang)) for j in range(k)], axis=1)
            own = lean[np.arange(len(lean)), doc_lang]
            label = np.where(lean.max(1) > own + 8, lean.argmax(1), doc_lang)[sentence]
        share, pairs = forward_backward(scores[numbers[at]], used, start, move)
        truth = np.eye(k)[label[at]]
        gap = np.where(used[..., None], share - truth, 0)
        per_word = np.stack([np.bincount(numbers[at].ravel(), gap[..., j].ravel(), len(words)) for j in range(k)], axis=1)
        g_w = np.stack([np.bincount(features.ravel(), np.repeat(per_word[:, j], features.shape[1]), size) for j in range(k)], axis=1)
        g_w[-1] = 0
        met = np.zeros((k, k))
        both = used[:, 1:]
        np.add.at(met, (label[at[:, :-1]][both], label[at[:, 1:]][both]), 1)
        n = len(numbers)
        for p, g, s in zip((w, start, move), (g_w / n + decay * w, gap[first, 0].sum(0) / n, (pairs - met) / n + 1e-5 * move), state, strict=True):
            s[0], s[1] = 0.9 * s[0] + 0.1 * g, 0.999 * s[1] + 0.001 * g * g
            p -= rate * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.999**step)) + 1e-8)
    return Model(names, w.astype(np.float32), lexicon, start, move)


def quotas(have: dict[str, int], rows: int) -> dict[str, int]:
    """Rows to draw of each language: equal parts, where those with fewer rows leave theirs to the others; one at least."""
    out: dict[str, int] = {}
    for lang in sorted(have, key=lambda x: (have[x], x)):
        out[lang] = min(have[lang], max((rows - sum(out.values())) // (len(have) - len(out)), 1))
    return out


def fit(docs: DataFrame, limits: Limits = Limits()) -> Model:
    """Learn from documents with a language that aren't held out."""
    usable = docs.where(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= limits.characters))
    most = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(limits.languages)
    have = {r["lang"]: r["count"] for r in most.collect()}
    if not have:
        return train([], [], limits)
    wanted, steps = quotas(have, limits.documents), 1 << 30
    each = lambda of: F.element_at(F.create_map(*(F.lit(x) for lang in have for x in (lang, of(lang)))), F.col("lang"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(steps))
    near = usable.select("doc_id", "text", "lang", place.alias("place")).where(F.col("place") < each(lambda lang: min(steps, (2 * wanted[lang] + 64) * steps // have[lang] + 1)))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", "text"))  # over some hundred rows, cut by their hash
    rows = near.withColumn("turn", turn).where(F.col("turn") <= each(wanted.get)).orderBy("place", "doc_id", "text").collect()
    return train([r["text"] for r in rows], [r["lang"] for r in rows], limits)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = model.predictor()
        for batch in batches:
            texts, ids = texts_of(batch), batch.column("doc_id")
            for part in slices(texts):
                names, scores = predictor(texts[part])
                yield pa.RecordBatch.from_arrays(
                    [ids[part], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
