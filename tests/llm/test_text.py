"""Exact copies, packing, toxicity, language, repeats and the Jaccard join against plain loops, and their edge cases."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import exact, jaccard, language, packing, repeats, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, h bigint, k string, rep int, cell string, _sha string"


def frame(spark, texts, ids=None):
    """Documents with further columns whose names the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en" if i is None or i % 2 else None, None, 0, i, "k", 1, "c", "s") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


LONG = " ".join(f"word{i % 977} and {i}" for i in range(30_000))
ODD = [None, "", "", "a", "a", "b", LONG, LONG, LONG + " x", "Ünïcödé “quotes” it's 12½ <|endoftext|> \x1c z", "\x00 nul", "a"]


@pytest.fixture(scope="module")
def shuffled():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 90))) for _ in range(40)]
    out = list(base)
    for text in base:
        parts = text.split()
        for _ in range(rng.randint(0, 4)):
            copy = list(parts)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy).upper() if rng.random() < 0.1 else " ".join(copy))
    rng.shuffle(out)
    return out + out[:10]


def test_exact_groups(spark, shuffled):
    texts = ODD + shuffled
    got = {r.doc_id: r for r in exact.exact_groups(frame(spark, texts)).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i, t in enumerate(texts):
        same = [j for j, u in enumerate(texts) if (u or "") == (t or "")]
        r = got[i]
        assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), i == max(same))
        assert r.text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    kept = exact.drop_exact(frame(spark, texts))
    assert kept.columns == frame(spark, texts).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.kept)


def test_exact_rows_that_share_an_id(spark):
    df = frame(spark, ["x", "x", "x", "y", None], [7, 7, 3, 3, None])
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in exact.exact_groups(df).collect())
    assert got == [(-1, -1, 1, True), (3, 3, 1, True), (3, 7, 3, False), (7, 7, 3, True), (7, 7, 3, True)]


def test_directory_splits_overfull_buckets():
    counts = {0: 50, 1: 50, 200: 10}
    buckets = exact.grow_directory(counts, capacity=60, depth=8)
    assert [b for b in buckets if b[0] < 2] == [(0, 8), (1, 8)]
    lows = [low for low, _ in buckets]
    assert lows == sorted(set(lows)) and lows[0] == 0
    assert sum(1 << (8 - bits) for _, bits in buckets) == 1 << 8  # the ranges cover all keys once
    for low, bits in buckets:
        assert bits == 8 or sum(counts.get(p, 0) for p in range(low, low + (1 << (8 - bits)))) <= 60


def test_chain_compares_bytes():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict(
        {"bucket": pa.array([0] * 4, pa.int32()), "h": pa.array([5, 5, 5, 6]), "text": pa.array([b"a", b"b", b"a", b"a"]), "doc_ids": pa.array([[1], [2], [3], [4]], pa.list_(pa.int64())), "n": pa.array([1] * 4), "top": pa.array([1, 2, 3, 4])}
    )
    (out,) = exact._chain(iter([batch]))
    assert out.column("link").to_pylist() == [0, 1, 0, 0]  # equal keys, different bytes: another link


@pytest.mark.parametrize("longest", [8, 4096])
def test_packing_round_trip(spark, longest, shuffled):
    texts = ODD + shuffled[:30]
    encoder = packing.Encoder(None)
    whole = [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    rows = packing.pack(frame(spark, texts), longest=longest, with_ids=True).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    for i, ids in enumerate(whole):
        pieces = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [x for r in pieces for x in r.ids] == [*ids, packing.END]
        assert all(r.length & (r.length - 1) == 0 and r.length <= longest and r.bucket == r.length for r in pieces)
        assert [r.start for r in pieces] == np.cumsum([0, *[r.length for r in pieces]])[:-1].tolist()
        for r in pieces:
            assert r.doc_tokens == len(ids) + 1 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())


def test_packing_refuses_other_lengths_and_writes_buckets(spark, tmp_path):
    with pytest.raises(ValueError):
        packing.pack(frame(spark, ["a"]), longest=100)
    packing.write_buckets(frame(spark, ["a b c", "d"]), str(tmp_path / "b"), longest=4)
    assert sorted((r.bucket, len(r.ids)) for r in spark.read.parquet(str(tmp_path / "b")).collect()) == [(2, 2), (4, 4)]


def brute_repeats(rows, length):
    seen, out = {}, {}
    for i, t in sorted(rows):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        hits = [p for p in range(len(data) - length + 1) if seen.setdefault(data[p : p + length], (i, p)) != (i, p)]
        for p in hits:
            gone[p : p + length] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("length,gram,seed", [(100, 32, 1), (12, 5, 2), (7, 3, 3)])
def test_repeats_match_brute_force(spark, length, gram, seed):
    rng = random.Random(seed)
    passage = "".join(rng.choice("abcd é") for _ in range(300))
    texts = [None, "", "ab" * 200, "x" * 350]
    for _ in range(60):
        a = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 200)))
        low = rng.randint(0, 200)
        texts += [a + passage[low : low + rng.randint(5, 250)] + a[::-1]]
    texts += texts[:8]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.drop_repeats(frame(spark, texts), length, gram).collect()}
    assert got == brute_repeats(list(enumerate(texts)), length)


def test_heavy_anchors_are_dealt_by_their_strings(spark):
    rng = random.Random(6)
    line = "".join(rng.choice("abcdefgh ") for _ in range(130))
    noise = lambda: "".join(rng.choice("ijklmnop ") for _ in range(rng.randint(20, 90)))
    texts = [noise() + line[rng.randint(0, 40) : rng.randint(80, 130)] + noise() for _ in range(200)]
    texts += [noise() + texts[3] + noise(), texts[5], None]
    ids = [*range(len(texts)), 7, 150]
    rows = frame(spark, [*texts, texts[7], texts[150]], ids)
    wanted = brute_repeats(list(enumerate(texts)), 40)
    got = repeats.drop_repeats(rows, 40, 16, heavy=5).collect()
    assert len(got) == len(ids)
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == wanted[r.doc_id] for r in got)
    _, groups = repeats.repeat_groups(rows, 40, 16, heavy=5)
    rows = groups.collect()
    whole = {(r.k, r.group) for r in rows if r.first}
    assert max(Counter((r.k, r.group) for r in rows if (r.k, r.group) in whole).values(), default=0) <= 5
    k = repeats.clipped_runs([t.encode() for t in texts[:200]], 40, 16)[0]
    assert np.unique(k, return_counts=True)[1].max() > 50  # an anchor of very many runs


def test_repeat_groups_have_all_occurrences_and_differ_on_the_left(spark):
    passage = "the quick brown fox jumps over the lazy dog"
    texts = ["1" + passage + "2", "3" + passage + "4", "5" + passage[:30] + "6", "nothing here at all"]
    _, groups = repeats.repeat_groups(frame(spark, texts).select("doc_id", "text"), 20, 8)
    found = {}
    for r in groups.collect():
        found.setdefault((r.k, r.group), []).append((texts[r.doc_id][r.start : r.start + r.size], r.doc_id, r.start, r.first))
    assert found
    for rows in found.values():
        assert len({t for t, *_ in rows}) == 1 and sum(f for *_, f in rows) == 1
        assert min((d, s) for _, d, s, _ in rows) == next((d, s) for _, d, s, f in rows if f)
        text = rows[0][0]
        inside = {(d, s) for _, d, s, _ in rows}
        assert inside <= {(d, s) for d, t in enumerate(texts) for s in range(len(t)) if t.startswith(text, s)}


def test_repeats_of_rows_that_share_an_id_stay(spark):
    text = "0123456789" * 3 + "abc"
    got = {(r.doc_id, r.n_removed) for r in repeats.drop_repeats(frame(spark, ["z" + text, "z" + text, text, None], [4, 4, None, None]), 20, 8).collect()}
    assert {d for d, _ in got} == {4, None} and len({n for d, n in got if d == 4}) == 1
    assert all(n == 0 for d, n in got if d is None)


def test_originals_of_rows_that_share_an_id_stay(spark):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(60))
    texts = {4: "only here 1" + passage + "only here 2", 7: "seven " + passage[10:50] + " eleven", 9: passage[:30] + "nine"}
    ids = [4, 4, 4, 7, 9, 9]
    got = repeats.drop_repeats(frame(spark, [texts[i] for i in ids], ids), 20, 8).collect()
    wanted = brute_repeats(list(texts.items()), 20)
    assert wanted[4][1] == 0 < wanted[7][1]
    assert sorted(r.doc_id for r in got) == ids
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == wanted[r.doc_id] for r in got)


def brute_jaccard(texts):
    sets = []
    for t in texts:
        w = (t or "").lower().encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    link = [[j for j, b in enumerate(sets) if i != j and a and b and 5 * len(a & b) >= 4 * len(a | b)] for i, a in enumerate(sets)]
    comp = list(range(len(texts)))
    for i in range(len(texts)):
        stack, seen = [i], {i}
        while stack:
            for j in link[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        comp[i] = min(seen)
    return [len(x) for x in link], comp


def test_jaccard_groups_match_brute_force(spark, shuffled):
    texts = ODD + shuffled
    degree, comp = brute_jaccard(texts)
    got = {r.doc_id: r for r in jaccard.jaccard_groups(frame(spark, texts)).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i in range(len(texts)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (degree[i], comp[i], comp[i] == i)
        assert got[i].class_id == min(j for j, t in enumerate(texts) if (t or "") == (texts[i] or ""))
    left = jaccard.drop_near(frame(spark, texts))
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i in range(len(texts)) if comp[i] == i)


def test_large_group_is_compared_in_blocks(spark):
    rng = random.Random(1)
    base = [f"v{i}" for i in range(60)]
    texts = []
    for _ in range(700):
        copy = list(base)
        copy[rng.randrange(60)] = f"n{rng.randrange(4)}"
        texts.append(" ".join(copy))
    degree, comp = brute_jaccard(texts)
    got = {r.doc_id: (r.n_links, r.component_id) for r in jaccard.jaccard_groups(frame(spark, texts)).collect()}
    assert [got[i] for i in range(700)] == list(zip(degree, comp, strict=True))


def test_prefix_is_shortened_until_the_recall():
    assert jaccard.prefix_length(0.8, 0.9998) == 6
    assert jaccard.prefix_length(0.8, 0.5) == 8 and jaccard.prefix_length(0.2, 0.9999, trees=2) == 1


LANGS = {"en": "the house and dog with running thing which that".split(), "de": "der und hund schloss nicht wurde ich über straße".split()}


def language_frame(spark, n=120):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        lang = "en" if i % 2 else "de"
        text = ". ".join(" ".join(rng.choice(LANGS[lang]) for _ in range(8)) for _ in range(4))
        rows.append((i, text, lang))
    rows += [(n, None, "en"), (n + 1, "", None), (n + 2, "123 ?!", "de"), (n + 3, "der hund", None), (None, "the dog", "en")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_language_of_held_out_rows(spark):
    df = language_frame(spark)
    model = language.fit(df, language.Limits(documents=80))
    got = {r.doc_id: r for r in language.predict(df, model).collect()}
    assert len(got) == 125
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") and 0.5 < got[i].score <= 1 for i in range(120))
    assert [(got[i].lang_pred, got[i].score) for i in (120, 121, 122)] == [("und", 0.0)] * 3
    assert got[123].lang_pred == "de" and got[None].lang_pred == "en"


def test_code_switched_words_are_labelled_one_by_one(spark):
    model = language.fit(language_frame(spark), language.Limits(documents=80))
    words = LANGS["en"] + LANGS["de"]
    table = model.weights[language.word_features(words, model.lexicon)].sum(1)
    at, used, _ = language.chains_of(np.arange(len(words)), np.array([len(words)]))
    share, _ = language.forward_backward(table[at], used, model.start, model.move)
    labels = [model.languages[k] for k in share[0, : len(words)].argmax(1)]
    assert labels == ["en"] * 9 + ["de"] * 9
    assert np.allclose(share.sum(2), 1)


def test_long_runs_count_to_their_last_letter(spark):
    run = "".join(chr(97 + i % 26) for i in range(1_000))
    parts = language.words_of(f"a {run} bc")
    assert (parts[0], parts[-1]) == ("a", "bc") and max(map(len, parts)) == language.LETTERS
    assert parts[1] + "".join(p[2:] for p in parts[2:-1]) == run
    assert language.words_of("x" * 24) == ["x" * 24] and language.words_of("x" * 25) == ["x" * 24, "x" * 3]
    model = language.fit(language_frame(spark), language.Limits(documents=80))
    texts = ["".join(LANGS["de"][:4]) + "".join(LANGS["en"] * 30)]  # begins in German, goes on in English
    names, _ = model.predictor()(texts)
    assert names == ["en"]


def test_rare_languages_are_learned(spark):
    assert language.quotas({"a": 5, "b": 10_000, "c": 400}, 1_200) == {"a": 5, "c": 400, "b": 795}
    rows = [(i, " ".join(LANGS["en"]), "en") for i in range(3_000)] + [(i, " ".join(LANGS["de"]), "de") for i in range(3_000, 3_003)]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), language.Limits(documents=40))
    assert model.languages == ("de", "en")


def test_forward_backward_matches_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    e, start, move = rng.normal(size=(1, 4, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    total, marginal, pair = 0.0, np.zeros((4, 3)), np.zeros((3, 3))
    for path in itertools.product(range(3), repeat=4):
        w = np.exp(start[path[0]] + sum(e[0, t, k] for t, k in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += w
        for t, k in enumerate(path):
            marginal[t, k] += w
        for a, b in zip(path, path[1:], strict=False):
            pair[a, b] += w
    share, pairs = language.forward_backward(e, np.ones((1, 4), bool), start, move)
    assert np.allclose(share[0], marginal / total) and np.allclose(pairs, pair / total)


def toxic_frame(spark, n=300):
    rng = random.Random(3)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            text[rng.randrange(30)] = rng.choice(["grumblefuzz", "snarkle"])
            text[rng.randrange(30)] = rng.choice(["grumblefuzz", "snarkle"])
        docs.append((i, " ".join(text), "x"))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    docs += [(n, None, "x"), (n + 1, "", None), (n, None, "x")]
    return spark.createDataFrame(docs, "doc_id bigint, text string, _toxic string"), spark.createDataFrame(labels + [(None, 1, 1), (5, 1, None)], "doc_id bigint, quality int, toxic int")


def test_toxicity_finds_held_out_rows(spark):
    docs, labels = toxic_frame(spark)
    rows = toxicity.score(docs, toxicity.fit(docs, labels), "score").collect()
    assert len(rows) == 303 and all(0 <= r.score <= 1 for r in rows)
    assert all((r.score >= 0.5) == (r.doc_id % 5 == 0) for r in rows if r.doc_id < 300)
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and left.count() == 243


def test_non_negative_risk_beats_naive_labels():
    """Half of the toxic rows hide among the unlabelled; the model still calls them toxic."""
    rng = np.random.default_rng(0)
    positive = np.arange(2_000) < 200
    toxic = positive | (rng.random(2_000) < 0.15)
    rows, columns = np.nonzero(np.stack([toxic, rng.random(2_000) < 0.3], axis=1))
    w = toxicity.fit_nnpu(rows, columns, np.ones(len(rows)), positive, 2, prior=0.15)
    hidden = w[0] + w[2]
    assert hidden > 0 > w[2] and abs(w[1]) < w[0]


@pytest.mark.parametrize("name", ["exact", "jaccard", "repeats", "packing", "language", "toxicity"])
def test_empty_table(spark, name):
    df = frame(spark, ["a"]).where("doc_id < 0")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    made = {
        "exact": lambda: exact.exact_groups(df),
        "jaccard": lambda: jaccard.jaccard_groups(df),
        "repeats": lambda: repeats.drop_repeats(df),
        "packing": lambda: packing.pack(df),
        "language": lambda: language.predict(df, language.fit(df)),
        "toxicity": lambda: toxicity.score(df, toxicity.fit(df, labels), "score"),
    }[name]()
    assert made.count() == 0
    assert F.col("doc_id") is not None and "doc_id" in made.columns


def test_bounded_sample_is_repeatable_and_cut_first(spark):
    from ledgerline.llm.common import bounded_sample

    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    got = bounded_sample(df, "doc_id", 100)
    ids = {r.doc_id for r in got.collect()}
    assert len(ids) == 100 and ids == {r.doc_id for r in bounded_sample(df.repartition(7), "doc_id", 100).collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    assert df.where(place < (2 * 100 + 64) * (1 << 30) // 20_000 + 1).count() < 400
    assert bounded_sample(df.limit(3), "doc_id", 100).count() == 3


def test_toxic_features_match_a_loop(spark):
    from collections import Counter as Counts

    rng = random.Random(8)
    words = [f"{a}{b}word" for a in "abcdefgh" for b in "xyz"]
    positive = [" ".join(rng.choices(words, k=30)) + " vile viler vilest" * (k % 3) for k in range(60)]
    plain = [" ".join(rng.choices(words, k=30)) + " vilest" * (k % 40 == 0) for k in range(300)]
    sample = spark.createDataFrame([(t, True) for t in positive] + [(t, False) for t in plain], "text string, positive boolean").repartition(5)
    p, u = (Counts(f for t in texts for f in toxicity.features_of(t)) for texts in (positive, plain))
    share = p.total() / (p.total() + u.total())
    want = {f: (n - share * (n + u[f])) / (share * (n + u[f])) ** 0.5 for f, n in p.items() if n >= 3 and n >= 2 * share * (n + u[f])}
    assert toxicity.choose_features(sample, 100) == sorted((f for f, z in want.items() if z >= 4), key=lambda f: (-want[f], f))
    features = toxicity.choose_features(sample, 2)
    rows, columns, values, known = toxicity.sparse_rows(sample, features)
    assert len(known) == 360 and known.sum() == 60
    assert len(rows) == len(columns) == len(values) == 2 * sum(f in toxicity.features_of(t) for t in positive + plain for f in features)


def test_toxicity_sample_is_bounded_and_column_is_replaced(spark):
    docs = frame(spark, ["vile words here"] * 30 + ["plain words here"] * 60 + [LONG]).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(90)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, toxicity.Limits(in_all=200))
    scored = toxicity.score(docs, model, "score")
    assert scored.columns.count("score") == 1 and scored.where("score BETWEEN 0 AND 1").count() == 91
    assert toxicity.score(docs.limit(0), model, "score").count() == 0
    nothing = toxicity.fit(docs.limit(0), labels.limit(0))
    assert nothing.features == () and toxicity.score(docs, nothing, "score").count() == 91


def test_languages_learned_are_bounded(spark):
    df = language_frame(spark)
    rare = [(10_000 + i, "only text of its kind", f"code{i}") for i in range(40)]
    both = df.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(rare, "doc_id bigint, text string, lang string"))
    names = [r["lang"] for r in df.where("lang IS NOT NULL AND text IS NOT NULL").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(2).collect()]
    model = language.fit(both, language.Limits(documents=60, languages=2))
    assert sorted(model.languages) == sorted(names)
