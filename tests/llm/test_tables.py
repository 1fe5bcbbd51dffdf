"""Pages, urls, embeddings, mixing, components and the pipeline against plain loops, and their edge cases."""

import hashlib
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import embeddings, graph, html_text, mixing, packing, urls

RULES = [urls.Rule("allow", "org", "/"), urls.Rule("block", "a.org", "/x/"), urls.Rule("block", "com", "/de/")]


def body(inner, head=""):
    return f"<!doctype html><html><head><title>T</title>{head}</head><body>{inner}</body></html>"


ARTICLE = "<h1>Head &amp; line</h1><p>One <b>bo</b>ld\n\t text<p>Two&nbsp;words<br>three</p><ul><li>a<li>b</ul>"
WANTED = "Head & line One bold text Two words three a b"
PAGES = {
    "article": body(f"<nav><a href=/>Home</a></nav><article>{ARTICLE}</article><footer>&copy; foot</footer>"),
    "div": body(f"<div id=top class='menu'><a>x</a></div><div class='post-17 post'>{ARTICLE}</div><div class=sidebar>more</div>"),
    "main": body(f"<header>Site</header><main>{ARTICLE}<aside>ad</aside></main><section id=comments><p>{'reader says ' * 60}</p></section>"),
    "parts": body(f"<div><div class='cookie-notice'>ok?</div><article>{ARTICLE}<form><input name=q><p>Search</p></form><script>if(a<b)'</p>'</script><style>p{{}}</style><!-- <p>no</p> --></article></div>"),
    "advert": body(f"<div class=ad>Buy</div><div class='advert-box'>Now</div><article>{ARTICLE}<div class='share-buttons'>Share</div><div class='comment-list'>me too</div></article>"),
    "unclosed": f"<html><body><nav>n</nav><article>{ARTICLE}",
    "bare": ARTICLE,
}


@pytest.mark.parametrize("kind", PAGES)
def test_main_text(kind):
    assert html_text.main_text(PAGES[kind], []) == WANTED


@pytest.mark.parametrize("text,wanted", [("", ""), ("<", "<"), ("<p>a</p", "a</p"), ("<script>x", ""), ("<div title='>'>q</div>", "q"), ("a<!-- b", "a"), ("</p></div>x", "x"), ("&lt;b&gt; &#233;", "<b> é")])
def test_odd_pages(text, wanted):
    assert html_text.main_text(text, []) == wanted


def test_hosts_agree_on_a_path(spark):
    good = body(f"<div class=wrap><div class=text>{ARTICLE}</div><div class=other><p>{'short ' * 3}</p></div></div>")
    odd = body(f"<div class=wrap><div class=text><p>Brief.</p></div><div class=other><p>{'long teaser words ' * 40}</p></div></div>")
    rows = [(i, "http://h.org/1", good, "v", "p") for i in range(15)] + [(99, "http://H.org/2", odd, "v", "p"), (100, None, None, "v", "p"), (101, "x", "", "v", "p"), (99, "http://H.org/2", odd, "v", "p")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, paths string")
    got = html_text.extract(pages).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == 19 and texts[0] == WANTED and texts[100] == texts[101] == ""
    assert texts[99] == "Brief."  # alone, the page would give its teaser
    assert html_text.main_text(odd, []).startswith("Brief. long teaser")  # nothing is left out without the host
    assert html_text.extract(pages.where("page_id < 0")).count() == 0


def test_articles_of_several_parts_stay_whole(spark):
    lead, rest = "lead sentence of the text. " * 20, "and the rest of it follows. " * 30
    both = f"{lead} {rest}".split()
    parts = body(f"<div class=post><div class=lead><p>{lead}</div><div class=body><p>{rest}</div></div><div class=menu>m</div>")
    around = body(f"<div class=post><p>{lead}<div class=inner><p>{rest}</div><p>{lead}</div>")
    assert html_text.main_text(parts, []).split() == both
    assert html_text.main_text(around, []).split() == both + lead.split()
    # three in ten pages of the host have another template, with a small block where the others have their text
    first, second = body(f"<div class=text><p>{lead}</div>"), body(f"<div class=text><p>Few words.</div><div class=long><p>{rest}</div>")
    rows = [(i, "http://h.org/1", first if i < 7 else second) for i in range(10)] + [(i, "http://g.org/1", parts) for i in range(10, 13)]
    got = {r.page_id: r.text.split() for r in html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(got[i] == (lead if i < 7 else f"Few words. {rest}").split() for i in range(10))
    assert all(got[i] == both for i in range(10, 13))


def test_nothing_of_the_article_is_lost():
    text = "words of the text go on here. " * 20
    short = body(f"<div class=post><p>A first paragraph of forty-eight characters, so.<div class=inner><p>{text}</div></div>")
    linked = body(f"<div class=post><p>See <a href=/x>{'a long link of many words ' * 9}</a></p><div class=inner><p>{text}</div></div>")
    classes = body(f"<article><h1>T</h1><section class=popular-science><p>{text}</section><div class=tags-explained>tags</div><div class='share-buttons'>s</div></article>")
    menu = body(f"<div><a href=/>Home</a>&nbsp;| <a href=/a>About</a></div><div class=inner><p>{text}</div>")
    assert html_text.main_text(short, []).split() == f"A first paragraph of forty-eight characters, so. {text}".split()
    assert html_text.main_text(linked, []).split() == f"See {'a long link of many words ' * 9} {text}".split()
    assert html_text.main_text(classes, []).split() == f"T {text} tags".split()
    assert html_text.main_text(menu, []).split() == text.split()


def test_teasers_of_one_page_fall_to_its_host(spark):
    text, teasers = "words of the text go on here. " * 20, "<div class=more><p>another story of the day</div>"
    rows = [(i, "http://h.org/1", body(f"<div class=main><p>{text}</div>{teasers * 9 if i == 20 else ''}")) for i in range(21)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert len(got) == 21 and all(r.text.split() == text.split() for r in got)
    assert "another story" in html_text.main_text(rows[20][2], [])


@pytest.mark.parametrize("tag", ["div", "b", "a", "li"])
def test_deep_pages_take_linear_time(tag):
    began = time.process_time()
    assert html_text.main_text(body(f"<{tag}>" * 40_000 + "deep" + f"</{tag}>" * 40_000), []) == "deep"
    assert html_text.main_text(body(f"<p>t<{tag}>" * 10_000), []).split() == ["t"] * 10_000
    assert time.process_time() - began < 20


def test_random_pages_against_their_plan():
    """Pages are built from a tree whose article blocks are known while it is written."""
    for seed in range(200):
        draw, wanted = random.Random(seed), []

        def block(draw=draw, wanted=wanted):
            words = " ".join(f"w{draw.randrange(999)}" for _ in range(draw.randint(1, 30)))
            wanted.append(words)
            return draw.choice(["<p>{}</p>", "<p>\n {} ", "<p class=notice-of-death>{}</p>", "<ul><li>{}</ul>", "<h2>{}</h2>", "<blockquote><p>{}</blockquote>"]).format(words.replace(" ", draw.choice([" ", "\t", "&#32;", "<b> </b>"])))

        def clutter(draw=draw):
            return draw.choice(["<nav><p>n</nav>", "<div class='ad-box'><p>a</div>", "<aside>s", "<form><p>f</form>", "<div id=comments><p>c</div>", "<script>'<p>x</p>'</script>", "<!-- <p>x -->", "<div class='share links'>l</div>"]).replace("<aside>s", "<aside>s</aside>")

        def box(depth, draw=draw):
            parts = [block() if draw.random() < 0.6 else box(depth - 1) if depth else block() for _ in range(draw.randint(1, 4))]
            parts.insert(draw.randrange(len(parts) + 1), clutter())
            tag = draw.choice(["div", "section", "div class=x1"])
            return f"<{tag}>{''.join(parts)}</{tag.split()[0]}>"

        page = body(f"<header><p>site</header>{clutter()}{box(3)}<footer>f</footer>")
        assert html_text.main_text(page, []) == " ".join(wanted), seed


def test_split_url_and_rules(spark):
    cases = {
        "http://A.Org/x/1?q#f": ("a.org", "/x/1", "a.org/x/"), "https://sub.a.org/x/": ("sub.a.org", "/x/", "a.org/x/"),
        "http://ba.org/x/1": ("ba.org", "/x/1", "org/"), "http://a.org": ("a.org", "", None), "http://a.com?x/de/": ("a.com", "", None),
        "ftp://u.com/de/ü": ("u.com", "/de/ü", "com/de/"), "no scheme": ("", "", None), "": ("", "", None), None: ("", "", None),
        "a://b://c/d": ("b:", "//c/d", None), "http://ÄA.net/p": ("Äa.net", "/p", None), "http://x.org/\ny": ("x.org", "/\ny", "org/"),
    }
    pages = spark.createDataFrame([(i, u, "h", "t") for i, u in enumerate(cases)], "page_id bigint, url string, host string, template string")
    got = {r.page_id: r for r in urls.judge_urls(pages, RULES).collect()}
    for i, (host, path, rule) in enumerate(cases.values()):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict in ("allow", "block")
        if rule:
            assert got[i].verdict == {"org/": "allow"}.get(rule, "block")
    assert urls.judge_urls(pages.where("page_id < 0"), RULES).count() == 0


def test_templates_learn_from_ruled_hosts(spark):
    rows = [(i, f"http://h{i % 3}.com/de/{i}") for i in range(60)] + [(100 + i, f"http://h{i % 3}.org/fr/{i}") for i in range(60)]
    rows += [(200 + i, f"http://n.net/{'de' if i % 2 else 'fr'}/{i}") for i in range(40)] * 2
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string"), RULES).collect()
    assert len(got) == 200
    net = [r for r in got if r.host == "n.net"]
    assert {(r.path[1:3], r.verdict, r.rule) for r in net} == {("de", "block", None), ("fr", "allow", None)}
    assert {r.template for r in net} == {"de/{n}", "fr/{n}"}


def brute_links(rows):
    unit = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            unit[i] = x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    link = {i: [j for j in unit if j != i and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= 0.9] for i in unit}
    comp = {}
    for i in link:
        seen, stack = {i}, [i]
        while stack:
            for j in link[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        comp[i] = min(seen)
    return {i: len(x) for i, x in link.items()}, comp


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 32))
    rows = [(i, [float(x) for x in centres[i % 30] + rng.normal(size=32) * rng.choice([0.05, 0.2, 0.35, 0.5])]) for i in range(700)]
    rows += [(700 + i, [float(x) for x in centres[0] * 1e200 * (1 + i)]) for i in range(20)]
    rows += [(800, None), (801, []), (802, [0.0] * 32), (803, [1.0, None]), (804, [float("nan")] * 32), (805, [float("inf")] + [1.0] * 31), (806, [2.0, 2.0]), (807, [1.0, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id bigint, embedding array<double>, size int, key int, cell string")
    got = {r.vec_id: r for r in embeddings.near_groups(df).collect()}
    degree, comp = brute_links(rows)
    assert set(got) == {i for i, _ in rows}
    true = sum(degree.values())
    found = sum(r.n_links for r in got.values())
    assert 0.99 * true <= found <= true
    exact = [i for i in got if got[i].n_links == degree.get(i, 0)]
    assert len(exact) >= 0.98 * len(got)
    assert all(got[i].n_links == 0 and got[i].kept for i in (800, 801, 802, 803, 804, 805, None))
    assert (got[806].n_links, got[806].component_id, got[807].kept) == (1, 806, False)
    assert all(r.component_id == comp.get(i, i) for i, r in got.items() if i in exact and got[i].n_links == 0 and i is not None)


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = embeddings.rotation(64, 9)
    code, factor = embeddings.codes(x, turn)
    close, spread = embeddings.estimate(np.unpackbits(code, axis=1, count=64), factor, x @ turn.T)
    off = close - x @ x.T
    np.fill_diagonal(off, 0)
    assert abs(off.mean()) < 0.005
    assert (np.abs(off) <= embeddings.SPREAD * spread[:, None]).mean() > 0.999


@pytest.mark.parametrize("bits", [20, 24])
def test_long_keys_keep_the_recall(spark, bits):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(300):  # pairs at a cosine of 0.9 to 0.91
        a, b = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        c = 0.9001 + 0.01 * rng.random()
        rows += [(2 * i, a.tolist()), (2 * i + 1, (c * a + math.sqrt(1 - c * c) * b).tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {r.vec_id: r.n_links for r in embeddings.near_groups(df, bits=bits).collect()}
    assert sum(found[2 * i] == 1 for i in range(300)) >= 294
    missed = 1 - (1 - math.acos(0.9) / math.pi) ** bits
    assert missed ** embeddings.tables_for(bits) <= embeddings.MISSED and embeddings.tables_for(13) == 40


def test_empty_embeddings(spark):
    assert embeddings.near_groups(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


@pytest.mark.parametrize("edges,wanted", [([], {}), ([(5, 5)], {}), ([(i, i + 1) for i in range(40)], dict.fromkeys(range(41), 0)), ([(9, 3), (3, 9), (4, 8), (8, 2)], {9: 3, 3: 3, 4: 2, 8: 2, 2: 2})])
def test_components(spark, edges, wanted):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r.id: r.component for r in graph.components(df).collect()} == wanted


def mixing_frame(spark, n=400):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        text = rng.choice(["some plain prose", "A | B | C |", "SHOUTING LOUD", "{x} = <y>;", "12 34 56"]) + " word" * rng.randint(0, 30)
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s0", "s1", None]), "z", "t"))
    rows += [(n, None, "en", "s9", "z", "t"), (n + 1, "", None, None, "z", "t"), (n + 2, "x " * 50_000, "de", "s1", "z", "t"), (None, "a b", "en", "s1", "z", "t")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, _cell string, topic string")


def test_raking_meets_the_targets(spark):
    df = mixing_frame(spark)
    targets = {"source": spark.createDataFrame([("s0", 0.2), ("s1", 0.7), ("unknown", 0.1), ("absent", 5.0)], "value string, share double")}
    rows = mixing.mix(df, targets, share=0.5).collect()
    assert len(rows) == 404
    tokens = sum(r.tokens for r in rows)
    for margin, asked in (("source", {"s0": 0.2, "s1": 0.7, "unknown": 0.1}), ("lang", None)):
        sums, real = {}, {}
        for r in rows:
            sums[r[margin]] = sums.get(r[margin], 0) + r.tokens * r.weight
            real[r[margin]] = real.get(r[margin], 0) + r.tokens
        shares = asked or {k: v**0.7 for k, v in real.items()}
        for k, v in shares.items():
            assert sums[k] / tokens == pytest.approx(v / sum(shares.values()), rel=0.02)
    assert sum(r.tokens * r.probability for r in rows) == pytest.approx(0.5 * tokens, rel=0.05)
    draw = lambda i: int(hashlib.md5(f"{'' if i is None else i}mix".encode()).hexdigest()[:8], 16) / 2**32
    assert all(r.sampled == (draw(r.doc_id) < r.probability) for r in rows if abs(draw(r.doc_id) - r.probability) > 1e-5)
    kept = mixing.sample(df, targets, share=0.5)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if r.sampled)
    assert mixing.mix(df.where("doc_id < 0")).count() == 0


def test_topics_and_tokens(spark):
    texts = ["a | b | c", "x = {y}; <z>", "LOUD WORDS", "1 22 333", "plain  words\there", "", None]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.topic_of(F.col("text")).alias("t"), mixing.tokens_of(F.col("text")).alias("n")).collect()
    assert [(r.t, r.n) for r in got] == [("table", 5), ("signs", 4), ("capitals", 2), ("numbers", 3), ("prose", 3), ("prose", 0), ("prose", 0)]


def test_pipeline_stages(spark, tmp_path):
    from test_text import brute_jaccard, toxic_frame

    docs, labels = toxic_frame(spark)
    docs = docs.drop("_toxic").withColumns({"lang": F.lit("en"), "source": F.concat(F.lit("s"), F.col("doc_id") % 3), "n_chars": F.length("text").cast("bigint")})
    near = docs.where("doc_id % 5 = 1").withColumns({"doc_id": F.col("doc_id") + 1000, "text": F.concat("text", F.lit(" end"))})
    same = docs.where("doc_id % 5 = 2").withColumn("doc_id", F.col("doc_id") + 2000)
    docs.unionByName(near).unionByName(same).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = now.columns
    states = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        states.append(sorted((r for r in now.collect()), key=lambda r: r.doc_id))
        if k < 4:
            assert now.columns == columns
    clean, single, far, drawn, packed = states
    assert {r.doc_id for r in clean} == {i + 1000 * (i % 5 == 1) * m for i in range(302) for m in (0, 1) if i % 5} | {i for i in range(300) if i % 5} | {i + 2000 for i in range(300) if i % 5 == 2} | {300, 301} | {1301}
    largest = {}
    for r in clean:
        largest[r.text or ""] = max(largest.get(r.text or "", -1), r.doc_id)
    assert {r.doc_id for r in single} == set(largest.values())
    _, comp = brute_jaccard([r.text for r in single])
    assert {r.doc_id for r in far} == {single[c].doc_id for c in comp}
    chances = {r.doc_id: r.sampled for r in mixing.mix(spark.createDataFrame(far, docs.schema)).collect()}
    assert {r.doc_id for r in drawn} == {i for i, s in chances.items() if s} and 0.5 < len(drawn) / len(far) < 1
    ids = {r.doc_id: len(e.ids) + 1 for r, e in zip(drawn, packing.Encoder(None).tokenizer.encode_batch([r.text or "" for r in drawn], add_special_tokens=False), strict=True)}
    for i, n in ids.items():
        assert sum(r.length for r in packed if r.doc_id == i) == n
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
