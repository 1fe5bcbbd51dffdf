"""Hard negatives, quality and token alignment against brute force, and their edge cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import alignment, negatives, quality

VECTORS = "vec_id bigint, embedding array<float>, label int, key string, block int, kind int, near string, place int"
DOCS = "doc_id bigint, text string, lang string, g int, a int, b int, kind string, best string, count string, score string, kept string, bucket int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "k", 7, 1, "n", 2) for i, v, y in rows], VECTORS).repartition(3)


def doc_frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, 2, 3, "k", "b", "c", "s", "k", 9) for i, t in rows], DOCS).repartition(3)


# ---------------------------------------------------------------- hard negatives


@pytest.mark.parametrize(("bound", "size"), [(3, 1), (4_000_000, 64), (10**15, 5), (10**16, 3_000)])
def test_products_are_exact(bound, size):
    rng = np.random.default_rng(size)
    top = math.isqrt(bound // size) or 1
    a, b = (rng.integers(-top, top + 1, (n, size)) for n in (7, 9))
    a[0], b[0], b[1] = top, top, -top
    primes = negatives.primes_for(size * top**2)
    got = negatives.products(negatives.residues(a, primes), negatives.residues(b, primes), primes)
    assert got.tolist() == (a.astype(object) @ b.astype(object).T).tolist()


def test_primes_follow_the_bound():
    assert negatives.primes_for(0) == [251] and len(negatives.primes_for(1 << 22)) == 3
    with pytest.raises(ValueError):
        negatives.primes_for(10**200)


def plain_negatives(rows, is_anchor, positives, most, scale=256):
    """By a loop over distinct usable rows."""
    usable = sorted({(i, y, tuple(v)) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, y, v in usable:
        if not is_anchor(i):
            continue
        q = [math.floor(scale * x) for x in v]
        scored = [(-sum(a * math.floor(scale * x) for a, x in zip(q, w, strict=True)), j, z) for j, z, w in usable if j != i and len(w) == len(v)]
        for s, j, _ in sorted(t for t in scored if t[2] == y)[:positives]:
            inside = sorted((t, k) for t, k, z in scored if z != y and 30 * -s <= 100 * -t <= 90 * -s)
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(inside[:most], 1)]
    return sorted(out)


def test_hard_negatives_match_a_loop(spark):
    rng = random.Random(3)
    grid = lambda n: [rng.choice([-0.25, 0.0, 0.25, 0.5, 0.75]) for _ in range(n)]  # noqa: E731  few values: many ties
    rows = [(i, grid(8), rng.randrange(3)) for i in range(240)]
    rows += [(300 + i, grid(3), i % 2) for i in range(20)]  # vectors of another length
    rows += [(400, None, 1), (401, [None] * 8, 1), (402, [math.nan] * 8, 0), (403, [math.inf] * 8, 0), (404, grid(8), None), (None, grid(8), 1)]
    rows += [(500, [], 0), (501, [], 1), (510, [], 0), rows[5], rows[5], rows[40], (5, grid(8), 2), (60, grid(8), 1)]
    rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]
    got = negatives.mine(vector_frame(spark, rows), F.col("vec_id") % 20 == 0, positives=3, negatives=4, block_cells=300)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, lambda i: i % 20 == 0, 3, 4)


def test_hard_negatives_of_large_components_and_of_nothing(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-9e4, 9e4) for _ in range(4)], i % 2) for i in range(60)]
    rows = [(i, [float(np.float32(x)) for x in v], y) for i, v, y in rows]
    got = negatives.mine(vector_frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, lambda i: i % 10 == 0, 5, 10)
    empty = negatives.mine(vector_frame(spark, rows).limit(0), F.col("vec_id") % 10 == 0)
    assert empty.collect() == [] and empty.columns[:3] == ["anchor_id", "positive_id", "rank"]
    with pytest.raises(ValueError):
        negatives.mine(vector_frame(spark, [(0, [1e30], 1)]), F.lit(True))


# ---------------------------------------------------------------- quality


def plain_quality(rows, trusted):
    grams = lambda ws: Counter(
        (((ord(x) * 31337 + ord(y)) * 31337 + ord(z)) % (2**31 - 1)) % 65536 for s in [" " + " ".join(ws) + " "] if ws for x, y, z in zip(s, s[1:], s[2:], strict=False)
    )
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    counts = [grams(ws) for ws in words]
    raw, good = Counter(), Counter()
    for (i, _), c in zip(rows, counts, strict=True):
        raw.update(c)
        if i in trusted:
            good.update(c)
    ratio = lambda b: math.log((good[b] + 0.5) / (good.total() + 32768)) - math.log((raw[b] + 0.5) / (raw.total() + 32768)) if good else 0.0
    out = []
    for (i, t), ws, c in zip(rows, words, counts, strict=True):
        t = t or ""
        triples = list(zip(ws, ws[1:], ws[2:], strict=False))
        twice = {x for x, n in Counter(triples).items() if n > 1}
        covered = {k + d for k, x in enumerate(triples) if x in twice for d in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        score = sum(n * ratio(b) for b, n in c.items()) / c.total() if c else 0.0
        failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
        out.append((i, len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed, round(score, 6), not failed and score >= -0.693147))
    return out


def close(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:7])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:7] + r[8:] for r in got] == [r[:7] + r[8:] for r in want]
    assert all(abs(x[7] - y[7]) <= 2e-6 for x, y in zip(got, want, strict=True))


@pytest.fixture(scope="module")
def written():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeinorst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    clean = [prose(rng.randint(60, 120)) for _ in range(60)]
    signs = [" ".join(w + "###" for w in prose(80).split()) for _ in range(15)]
    odd = [None, "", " \n\t", "x", "a b a b a b", prose(60) + "\n\n" + "same line\nsame line\n \n \nsame line", "Ünï çö\x1cdé 日本 " * 30, "one two three " * 40]
    return clean, signs, odd + [prose(70)] * 3


def test_quality_matches_a_loop(spark, written):
    clean, signs, odd = written
    rows = list(enumerate([*clean, *signs, *odd])) + [(None, clean[0]), (3, clean[3]), (3, signs[0])]
    trusted = {*range(0, 50), 3}
    named = spark.createDataFrame([(i, "x") for i in [*trusted, 3, None, 10**6]], "doc_id bigint, text string")
    got = [tuple(r) for r in quality.filter_quality(doc_frame(spark, rows), named).collect()]
    close(got, plain_quality(rows, trusted))
    kept = {r[0] for r in got if r[8]}
    assert set(range(4, 60)) <= kept and not kept & set(range(60, 75))


def test_quality_of_long_texts_in_stretches(spark, written, monkeypatch):
    clean, signs, _ = written
    monkeypatch.setattr(quality, "STRETCH", 11)
    runs = list(quality.bucket_runs(clean[0].encode().split()))
    monkeypatch.setattr(quality, "STRETCH", 1 << 40)
    assert np.concatenate(runs).tolist() == next(quality.bucket_runs(clean[0].encode().split())).tolist()
    rows = [(0, " ".join(clean) * 40), (1, clean[1])]
    named = spark.createDataFrame([(0,)], "doc_id bigint")
    close([tuple(r) for r in quality.filter_quality(doc_frame(spark, rows), named).collect()], plain_quality(rows, {0}))


def test_quality_without_trusted_or_without_rows(spark, written):
    clean, signs, odd = written
    rows = list(enumerate([*clean[:5], *signs[:3], *odd]))
    nobody = spark.createDataFrame([], "doc_id bigint")
    close([tuple(r) for r in quality.filter_quality(doc_frame(spark, rows), nobody).collect()], plain_quality(rows, set()))
    assert quality.filter_quality(doc_frame(spark, rows).limit(0), nobody).collect() == []


# ---------------------------------------------------------------- alignment


@pytest.fixture(scope="module")
def tokens():
    return alignment.Tokens()


def plain_alignment(rows, tokens):
    """Whole texts by both tokenizers, ends by decoded bytes, links by comparing ranges."""
    seen, docs_of = [], defaultdict(set)
    for k, (i, t) in enumerate(rows):
        line = (" " + t).encode() if t else b""
        a = tokens.a.encode(" " + t, add_special_tokens=False).ids if t else []
        b = tokens.b.encode(t) if t else []
        ea, eb = (np.cumsum([len(table[x]) for x in ids]).tolist() for table, ids in ((tokens.a_bytes, a), (tokens.b_bytes, b)))
        if b"".join(tokens.a_bytes[x] for x in a) != line or b"".join(tokens.b_bytes[x] for x in b) != line:
            a, b, ea, eb = [], [], [], []
        links = [(x, y) for x, lo, hi in zip(a, [0, *ea], ea, strict=False) for y, low, high in zip(b, [0, *eb], eb, strict=False) if max(lo, low) < min(hi, high)]
        cuts = sorted({*ea} & {*eb})
        inside = lambda ids, ends, lo, hi: ",".join(str(x) for x, e in zip(ids, ends, strict=True) if lo < e <= hi)
        groups = [inside(a, ea, lo, hi) + "|" + inside(b, eb, lo, hi) for lo, hi in zip([0, *cuts], cuts, strict=False)]
        for pair in links:
            docs_of[pair].add(k)
        seen.append((i, len(a), len(b), len(groups), links, ";".join(groups)))
    count = {pair: len(d) for pair, d in docs_of.items()}
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    return [
        (i, na, nb, ng, len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if links else "")
        for i, na, nb, ng, links, g in seen
    ]


STRANGE = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\n\n b", "a\n  b", "tabs\tand\t\tmore", "x;\r\ny();\r\n", "\r", "it's we'll 'tis don''t",
    "日本語のテキスト と 漢字", "emoji 😀😀 👩‍👩‍👧 ok", "é́ composed é", "▁ sign", "a▁b", "<s>x</s><unk><|endoftext|> [INST]", "\x00 nul \x1c\x1d sep", "nb\xa0sp em　full",
    "ﬁ ½ ② ｆｕｌｌ", "12345 1,234.5 x=y+z;", "word" * 400, "…—“quotes”", "﻿bom", "𝔘𝔫𝔦 \U0010ffff", "a" * 5000 + " b", "tail \n", "tail\n\n\n", "\u0085next line", "ab\x0b\x0ccd",
]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_alignment_matches_whole_texts(spark, tokens):
    rng = random.Random(21)
    parts = [s for s in STRANGE if s] + ["the", " quick", "brown\n", "Übergröße", "ção", "東京"]
    mixed = ["".join(rng.choice([x, x, " " + x]) for x in rng.choices(parts[:15] + parts[19:], k=rng.randint(1, 12))) for _ in range(150)]
    rows = list(enumerate(STRANGE + mixed)) + [(2, "repeated id"), (2, "repeated id"), (None, "no id"), (9, "a b")]
    got = [tuple(r) for r in alignment.align_tokens(doc_frame(spark, rows)).collect()]
    want = plain_alignment(rows, tokens)
    assert order(got) == order(want)
    assert sum(r[1] > 0 for r in want) > 120


def test_alignment_of_given_documents(spark, tokens):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert order(tuple(r) for r in alignment.align_tokens(doc_frame(spark, rows)).collect()) == order(plain_alignment(rows, tokens))


def test_spans_and_decoded_bytes_agree(tokens):
    """Where no character is split, the spans alone give the cuts."""
    spans, widths = np.array([2, 5, 5, 8]), np.array([2, 1, 2, 3])
    assert alignment.refined(spans, widths, np.array([0, 2, 3, 5])).tolist() == [2, 3, 5, 8]
    encoding = tokens.a.encode(" plain words here", add_special_tokens=False)
    assert [e for _, e in encoding.offsets] == np.cumsum(tokens.a_width[encoding.ids]).tolist()


def test_remembered_units_are_forgotten(spark, tokens, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    own = alignment.Tokens()
    for text in ("some words to remember " * 5, "others that follow them", "some words again"):
        numbers, at = own.read([text, "", text])
        assert at[1] == at[2] and (numbers[: at[1]] == numbers[at[2] :]).all()
        assert own.numbers[0, numbers[: at[1]]].sum() == len(tokens.a.encode(" " + text, add_special_tokens=False).ids)


def test_alignment_of_texts_without_tokens(spark):
    rows = [(1, None), (2, ""), (3, "a▁b"), (4, None)]
    assert order(tuple(r) for r in alignment.align_tokens(doc_frame(spark, rows)).collect()) == [(i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows]


def test_alignment_of_an_empty_table(spark):
    assert alignment.align_tokens(doc_frame(spark, [(1, "x")]).limit(0)).collect() == []


def test_pairs_are_counted_without_a_join(spark):
    rows = [(i, t) for i, t in enumerate(["one two", "one two three", "two", "three three", "one"] * 4)]
    df = alignment.align_tokens(doc_frame(spark, rows))
    assert "Join" not in df._jdf.queryExecution().toString()
    assert order(tuple(r) for r in df.collect()) == order(plain_alignment(rows, alignment.tokens_of(None, None)))
