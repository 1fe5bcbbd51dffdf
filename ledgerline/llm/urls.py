"""URL filter: given rules first, and for all other urls a tree of path templates per host.

Digits and long hexadecimal words of a path segment become wildcards by their form. Going down the tree, the children
of a node become one wildcard when they are many and nearly all different. Labels are the urls that a rule decides.
Every template of a host gets its blocked and labelled urls, plus the rate of the same template on all hosts as
``strength`` pseudo-labels. Sibling branches (templates of a host that differ in the first segment only) whose rates
don't differ from their pool by a binomial test are merged and share the pool's rate. A template whose smoothed
blocked share is one half or more is rejected.

Only DataFrame functions. A null url, or one without ``://``, has an empty host and path and is judged as a template of
the empty host; an empty table gives an empty result; repeated rows are judged alike; further columns are ignored.
The first three segments name a template, deeper ones are one tail, so that the tree's height is fixed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import pin

#: Children of a node, and urls per child below which they count as one variable segment.
MANY, FEW = 8, 2
STRENGTH = 10
#: Square of the number of standard errors (two) within which a branch is like its pool.
Z2 = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with its subdomains and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null or a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, UPPER, LOWER), F.regexp_extract(tail, "^[^?#]*", 0)


def matched(rules: Sequence[Rule], host: Column, path: Column, value: str) -> Column:
    """``value`` (name or verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, value))).otherwise(out)
    return out


def segment(path: Column, n: int) -> Column:
    """Form of the n-th segment (from 0); empty where the path has no such segment, ``.`` for an empty one."""
    parts = F.split(F.substring(path, 2, F.length(path)), "/")
    raw = F.when(F.length(path) > 0, F.get(parts, F.lit(n)))
    form = F.when(raw == "", ".").when(raw.rlike("^[0-9A-Fa-f]{12,}$"), "{hex}").otherwise(F.regexp_replace(raw, "[0-9]+", "{n}"))
    return F.coalesce(form, F.lit(""))


def leaves(judged: DataFrame) -> DataFrame:
    """Urls, labelled urls and blocked urls per host and form of path."""
    return judged.groupBy("host", "s1", "s2", "s3", "s4").agg(
        F.count(F.lit(1)).alias("n"), F.count("ruled").alias("m"), F.count_if(F.col("ruled") == "block").alias("b")
    )


def generalise(tree: DataFrame) -> DataFrame:
    """Add w1, w2, w3: the segments after variable ones became ``*``, from the root downwards."""
    above = ["host"]
    for level in ("1", "2", "3"):
        child, out = f"s{level}", f"w{level}"
        kids = tree.groupBy(*above, child).agg(F.sum("n").alias("n"))
        nodes = kids.groupBy(*above).agg(((F.count(F.lit(1)) >= MANY) & (F.sum("n") < FEW * F.count(F.lit(1)))).alias("_v"))
        tree = tree.join(nodes, above).withColumn(out, F.when(F.col("_v"), "*").otherwise(F.col(child))).drop("_v")
        above.append(out)
    return tree


def decide(tree: DataFrame) -> DataFrame:
    """Smoothed blocked share per template (host, w1, w2, w3, s4), similar siblings merged."""
    shape = ["w1", "w2", "w3", "s4"]
    own = tree.groupBy("host", *shape).agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum("b").alias("b"))
    total = own.agg(F.coalesce(F.sum("b") / F.nullif(F.sum("m"), F.lit(0)), F.lit(0.5)).alias("rate"))
    rate = F.broadcast(total)  # one row
    across = own.groupBy(*shape).agg(F.sum("m").alias("am"), F.sum("b").alias("ab")).join(rate)
    across = across.select(*shape, ((F.col("ab") + STRENGTH * F.col("rate")) / (F.col("am") + STRENGTH)).alias("prior"))
    node = own.join(across, shape).select("host", *shape, (F.col("b") + STRENGTH * F.col("prior")).alias("eb"), (F.col("m") + F.lit(STRENGTH)).alias("em"))
    rest = ["host", "w2", "w3", "s4"]
    pool = node.groupBy(*rest).agg((F.sum("eb") / F.sum("em")).alias("r"))
    off = F.col("eb") - F.col("em") * F.col("r")
    tested = node.join(pool, rest).withColumn("like", F.round(off * off - Z2 * F.col("em") * F.col("r") * (1 - F.col("r")), 9) <= 0)
    merged = tested.where("like").groupBy(*rest).agg((F.sum("eb") / F.sum("em")).alias("mr"), F.count(F.lit(1)).alias("width"))
    both = tested.join(merged, rest, "left")
    share = F.when(F.col("like"), F.col("mr")).otherwise(F.col("eb") / F.col("em"))
    first = F.when(F.col("like") & (F.col("width") > 1), "|").otherwise(F.col("w1"))
    return both.select("host", *shape, (F.round(share, 9) >= 0.5).alias("rejected"), F.concat_ws("/", first, F.nullif("w2", F.lit("")), F.nullif("w3", F.lit("")), F.nullif("s4", F.lit(""))).alias("template"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule (null without one), verdict (allow or block) and template of every row."""
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    forms = [segment(F.col("path"), n).alias(f"s{n + 1}") for n in range(3)]
    tail = F.when(segment(F.col("path"), 3) != "", "**").otherwise("").alias("s4")
    ruled = [matched(rules, F.col("host"), F.col("path"), "name").alias("rule"), matched(rules, F.col("host"), F.col("path"), "verdict").alias("ruled")]
    judged = split.select("*", *forms, tail, *ruled)
    tree = generalise(pin(leaves(judged), "url-leaves"))
    by_template = decide(tree)
    verdicts = tree.join(by_template, ["host", "w1", "w2", "w3", "s4"]).select("host", "s1", "s2", "s3", "s4", "rejected", "template")
    verdict = F.coalesce("ruled", F.when(F.col("rejected"), "block").otherwise("allow"))
    return judged.join(pin(verdicts, "url-verdicts"), ["host", "s1", "s2", "s3", "s4"]).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template")
