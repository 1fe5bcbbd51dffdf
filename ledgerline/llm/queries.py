"""One query per operator, each over its whole table, and the SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import alignment, embeddings, exact, html_text, jaccard, language, mixing, negatives, packing, quality, repeats, toxicity, urls
from ledgerline.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def _mixing_sql(rounds: int = 20, rate_steps: int = 20, share: float = 0.8) -> str:
    """Raking and the rate, one common table expression per step."""
    steps = []
    for margin, power in (("source", 0.5), ("lang", 0.7), ("topic", 0.7)):
        steps.append(
            f"""want_{margin} AS (
  SELECT {margin}, sum(t) OVER () * s / nullif(sum(s) OVER (), 0) AS want_{margin}
  FROM (SELECT {margin}, sum(tokens)::DOUBLE AS t, CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens)::DOUBLE, {power}) ELSE 0 END AS s FROM cells GROUP BY {margin}))"""
        )
    steps.append("r0 AS MATERIALIZED (SELECT *, tokens::DOUBLE AS fitted FROM cells JOIN want_source USING (source) JOIN want_lang USING (lang) JOIN want_topic USING (topic))")
    for k in range(3 * rounds):
        margin = ("source", "lang", "topic")[k % 3]
        steps.append(
            f"r{k + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(fitted) OVER (PARTITION BY {margin}) > 0 "
            f"THEN fitted * want_{margin} / sum(fitted) OVER (PARTITION BY {margin}) ELSE 0 END AS fitted) FROM r{k})"
        )
    steps.append(f"weighed AS MATERIALIZED (SELECT *, CASE WHEN tokens > 0 THEN fitted / tokens ELSE 0 END AS weight FROM r{3 * rounds})")
    steps.append(f"p0 AS (SELECT {share}::DOUBLE AS rate)")
    for k in range(rate_steps):
        steps.append(f"p{k + 1} AS MATERIALIZED (SELECT any_value(rate) * ({share} * sum(tokens)) / sum(tokens * least(1.0, weight * rate)) AS rate FROM weighed, p{k})")
    return f"""
WITH body AS (
  SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang, coalesce(text, '') AS x FROM documents
), marks AS (
  SELECT *, length(x) AS n, length(x) - length(replace(x, '|', '')) AS bars, length(regexp_replace(x, '[^%#*&$={{}}<>;]', '', 'g')) AS signs,
         length(regexp_replace(x, '[^A-Z]', '', 'g')) AS capitals, length(regexp_replace(x, '[^a-z]', '', 'g')) AS small,
         length(regexp_replace(x, '[^0-9]', '', 'g')) AS digits, len(regexp_extract_all(x, '[^ \t\n\r\f]+')) AS tokens FROM body
), told AS (
  SELECT doc_id, source, lang, tokens, CASE WHEN bars * 40 > n THEN 'table' WHEN signs * 12 > n THEN 'signs' WHEN capitals > small THEN 'capitals'
    WHEN digits * 10 > n THEN 'numbers' ELSE 'prose' END AS topic FROM marks
), cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM told GROUP BY ALL
), {", ".join(steps)}
SELECT doc_id, source, lang, topic, told.tokens, round(weight, 6) AS weight, round(round(least(1.0, weight * rate), 9), 6) AS probability,
       ('0x' || substr(md5(doc_id::VARCHAR || 'mix'), 1, 8))::BIGINT / 4294967296.0 < round(least(1.0, weight * rate), 9) AS sampled
FROM told JOIN weighed USING (source, lang, topic), p{rate_steps}
"""


SQL["op1_mixing"] = _mixing_sql()


@query
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


SQL["op4_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""


URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


SQL["op5_url_filter"] = """
WITH u AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u
), p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), ruled AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS ruled
  FROM (SELECT DISTINCT page_id, host, path FROM p) JOIN rules ON (host = rhost OR suffix(host, '.' || rhost)) AND prefix(path, rpath)
  GROUP BY page_id
), seg AS (
  SELECT p.*, CASE WHEN path = '' THEN [] ELSE string_split(substr(path, 2), '/') END AS parts FROM p
), form AS (
  SELECT page_id, host, path, len(parts) AS k, list_transform(parts, lambda s: CASE WHEN s = '' THEN '.' WHEN regexp_matches(s, '^[0-9A-Fa-f]{12,}$') THEN '{hex}'
    ELSE regexp_replace(s, '[0-9]+', '{n}', 'g') END) AS f FROM seg
), judged AS (
  SELECT form.page_id, host, path, coalesce(f[1], '') AS s1, coalesce(f[2], '') AS s2, coalesce(f[3], '') AS s3,
         CASE WHEN k > 3 THEN '**' ELSE '' END AS s4, rule, ruled FROM form LEFT JOIN ruled USING (page_id)
), l1 AS (SELECT host, CASE WHEN count(DISTINCT s1) >= 8 AND count(*) < 2 * count(DISTINCT s1) THEN true ELSE false END AS v FROM judged GROUP BY host
), j1 AS (SELECT judged.*, CASE WHEN v THEN '*' ELSE s1 END AS w1 FROM judged JOIN l1 USING (host)
), l2 AS (SELECT host, w1, count(DISTINCT s2) >= 8 AND count(*) < 2 * count(DISTINCT s2) AS v FROM j1 GROUP BY host, w1
), j2 AS (SELECT j1.*, CASE WHEN v THEN '*' ELSE s2 END AS w2 FROM j1 JOIN l2 USING (host, w1)
), l3 AS (SELECT host, w1, w2, count(DISTINCT s3) >= 8 AND count(*) < 2 * count(DISTINCT s3) AS v FROM j2 GROUP BY host, w1, w2
), j3 AS (SELECT j2.*, CASE WHEN v THEN '*' ELSE s3 END AS w3 FROM j2 JOIN l3 USING (host, w1, w2)
), own AS (
  SELECT host, w1, w2, w3, s4, count(ruled) AS m, count(*) FILTER (ruled = 'block') AS b FROM j3 GROUP BY ALL
), rate AS (SELECT coalesce(sum(b) / nullif(sum(m), 0), 0.5) AS rate FROM own
), across AS (
  SELECT w1, w2, w3, s4, (sum(b) + 10 * any_value(rate)) / (sum(m) + 10) AS prior FROM own, rate GROUP BY w1, w2, w3, s4
), node AS (SELECT host, w1, w2, w3, s4, b + 10 * prior AS eb, m + 10 AS em FROM own JOIN across USING (w1, w2, w3, s4)
), pool AS (SELECT host, w2, w3, s4, sum(eb) / sum(em) AS r FROM node GROUP BY ALL
), tested AS (
  SELECT node.*, round((eb - em * r) * (eb - em * r) - 4 * em * r * (1 - r), 9) <= 0 AS alike FROM node JOIN pool USING (host, w2, w3, s4)
), merged AS (SELECT host, w2, w3, s4, sum(eb) / sum(em) AS mr, count(*) AS width FROM tested WHERE alike GROUP BY ALL
), ended AS (
  SELECT host, w1, w2, w3, s4, round(CASE WHEN alike THEN mr ELSE eb / em END, 9) >= 0.5 AS rejected,
         concat_ws('/', CASE WHEN alike AND width > 1 THEN '|' ELSE w1 END, nullif(w2, ''), nullif(w3, ''), nullif(s4, '')) AS template
  FROM tested LEFT JOIN merged USING (host, w2, w3, s4)
)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict, template
FROM j3 JOIN ended USING (host, w1, w2, w3, s4)
"""


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    predicted = language.predict(docs, language.fit(docs))
    return predicted.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.drop_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


SQL["op8_jaccard_join"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(text, '') AS body, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \t\n\r\f\v]+'), lambda x: x <> '') AS words FROM documents
), first AS (SELECT body, min(doc_id) AS rep, count(*) AS weight, any_value(words) AS words FROM w GROUP BY body
), s AS (
  SELECT rep, weight, unnest(CASE WHEN len(words) >= 5
    THEN list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) ELSE [array_to_string(words, ' ')] END) AS shingle
  FROM first WHERE len(words) > 0
), size AS (SELECT rep, any_value(weight) AS weight, count(*) AS n FROM s GROUP BY rep
), common AS (SELECT l.rep AS a, r.rep AS b, count(*) AS n FROM s l JOIN s r ON l.shingle = r.shingle AND l.rep <> r.rep GROUP BY ALL
), link AS MATERIALIZED (
  SELECT a, b, y.weight AS weight FROM common JOIN size x ON a = x.rep JOIN size y ON b = y.rep WHERE 5 * common.n >= 4 * (x.n + y.n - common.n)
), reach(a, b) AS (SELECT rep, rep FROM size UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), component AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a
), degree AS (SELECT a AS rep, sum(weight) AS n FROM link GROUP BY a)
SELECT doc_id, rep AS class_id, CASE WHEN len(w.words) > 0 THEN weight - 1 + coalesce(n, 0) ELSE 0 END::BIGINT AS n_links,
       CASE WHEN len(w.words) > 0 THEN component_id ELSE doc_id END AS component_id, doc_id = CASE WHEN len(w.words) > 0 THEN component_id ELSE doc_id END AS kept
FROM w JOIN first USING (body) LEFT JOIN component USING (rep) LEFT JOIN degree USING (rep)
"""


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, "score")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_groups(table(spark, sf_dir, "embeddings"))


SQL["op10_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), unit AS (SELECT vec_id, x, sqrt(list_dot_product(x, x)) AS norm FROM v WHERE list_dot_product(x, x) > 0
), link AS MATERIALIZED (
  SELECT l.vec_id AS a, r.vec_id AS b FROM unit l JOIN unit r ON l.vec_id <> r.vec_id AND len(l.x) = len(r.x)
  WHERE list_dot_product(l.x, r.x) / (l.norm * r.norm) >= 0.9
), reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), degree AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component USING (vec_id) LEFT JOIN degree USING (vec_id)
"""


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    label = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, label)


SQL["op11_hard_negatives"] = """
WITH r AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
  FROM r a JOIN r ON a.vec_id <> r.vec_id AND len(a.q) = len(r.q) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER first AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW first AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 10
"""


@query
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality.filter_quality(table(spark, sf_dir, "documents"), trusted)


SQL["op12_quality"] = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS body, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d
), triples AS (
  SELECT doc_id, i, lead(word, 2) OVER (PARTITION BY doc_id ORDER BY i) AS third, concat_ws(' ', word, lead(word) OVER (PARTITION BY doc_id ORDER BY i), lead(word, 2) OVER (PARTITION BY doc_id ORDER BY i)) AS w FROM placed
), twice AS (SELECT doc_id, i FROM triples WHERE third IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) o(k) GROUP BY doc_id
), plain AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
), chars AS (
  SELECT doc_id, unicode(c) AS c, i FROM (
    SELECT doc_id, unnest(cs) AS c, generate_subscripts(cs, 1) AS i FROM (SELECT doc_id, regexp_extract_all(' ' || array_to_string(words, ' ') || ' ', '(?s).') AS cs FROM d WHERE len(words) > 0))
), spun AS (SELECT doc_id, c::BIGINT AS c, lead(c) OVER w AS d, lead(c, 2) OVER w AS e FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), grams AS MATERIALIZED (
  SELECT doc_id, ((c * 31337 + d) * 31337 + e) % 2147483647 % 65536 AS bucket, count(*) AS n FROM spun WHERE e IS NOT NULL GROUP BY ALL
), counts AS (
  SELECT bucket, sum(n)::DOUBLE AS raw, coalesce(sum(n) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)), 0)::DOUBLE AS trusted FROM grams GROUP BY bucket
), total AS (SELECT sum(raw) AS raw, sum(trusted) AS trusted FROM counts
), ratio AS (
  SELECT bucket, CASE WHEN total.trusted = 0 THEN 0
    ELSE ln((counts.trusted + 0.5) / (total.trusted + 32768)) - ln((counts.raw + 0.5) / (total.raw + 32768)) END AS r FROM counts, total
), scored AS (SELECT doc_id, round(sum(n * r) / sum(n), 6) AS score FROM grams JOIN ratio USING (bucket) GROUP BY doc_id
), told AS (
  SELECT plain.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, coalesce(score, 0) AS score FROM plain LEFT JOIN scored USING (doc_id)
)
SELECT *, NOT base_failed AND score >= -0.693147 AS kept FROM told
"""


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
