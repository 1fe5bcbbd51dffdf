"""Mixing documents to target shares of tokens by iterative proportional fitting.

Documents are summed to cells of source, language and topic. Raking multiplies the tokens of the cells so that, one
margin after the other, the sums per source, language and topic meet their targets; after ``rounds`` rounds the last
margin is exact and the others are close. A cell's weight is its fitted tokens over its real ones. Sampling keeps a
document with probability min(1, rate x weight), where the rate is such that the wanted share of all tokens is kept, and
the draw is a hash of the doc_id, so a run can be repeated.

Targets are shares per value, as a table (value, share) for each margin; without one, shares are the margin's tokens to
the power ``temper``, which raises small sources. Values without a target are rated 0, a value without tokens can't get
any. Only cells go through the rounds: their number is that of the combinations that occur, not of the documents.

A null source or language is the value ``unknown``; null or empty texts have no tokens, form cells of weight 0 together
with their like, and are never drawn unless their cell has tokens. Repeated rows are drawn alike. An empty table gives
an empty result. Further columns are kept by ``sample`` and ignored by ``mix``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import free_name
from ledgerline.session import pin

MARGINS = ("source", "lang", "topic")
#: Powers of the margins' tokens that give the default targets.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.7}
ROUNDS, PER_STAGE, RATE_STEPS = 20, 2, 20
SHARE, SEED = 0.8, "mix"
SPACE = "[^ \\t\\n\\r\\f]+"


def tokens_of(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE)), F.lit(0)).cast("bigint")


def topic_of(text: Column) -> Column:
    """Kind of text: by bars, signs and capitals."""
    body = F.coalesce(text, F.lit(""))
    size = F.length(body)
    without = lambda signs: size - F.length(F.translate(body, signs, ""))
    capitals = without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    small = without("abcdefghijklmnopqrstuvwxyz")
    return (
        F.when(without("|") * 40 > size, "table")
        .when(without("%#*&$={}<>;") * 12 > size, "signs")
        .when(capitals > small, "capitals")
        .when(without("0123456789") * 10 > size, "numbers")
        .otherwise("prose")
    )


def draw_of(doc_id: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 (exclusive) by the doc_id."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(seed))), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def described(docs: DataFrame, topic: Column) -> DataFrame:
    named = [F.coalesce(F.col(c), F.lit("unknown")).alias(c) for c in ("source", "lang")]
    return docs.select("doc_id", *named, F.coalesce(topic, F.lit("unknown")).alias("topic"), tokens_of(F.col("text")).alias("tokens"))


def with_targets(cells: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """Add the wanted tokens of each margin value."""
    for margin in MARGINS:
        sums = cells.groupBy(margin).agg(F.sum("tokens").alias("_t"))
        if margin in targets:
            asked = targets[margin].select(F.col("value").alias(margin), F.col("share").cast("double").alias("_s"))
            sums = sums.join(asked, margin, "left").withColumn("_s", F.when(F.col("_t") > 0, F.coalesce("_s", F.lit(0.0))).otherwise(0.0))
        else:
            sums = sums.withColumn("_s", F.when(F.col("_t") > 0, F.pow(F.col("_t").cast("double"), TEMPER[margin])).otherwise(0.0))
        total = sums.agg(F.sum("_t").cast("double").alias("_all"), F.sum("_s").alias("_sum"))
        wanted = sums.join(F.broadcast(total)).select(margin, F.when(F.col("_sum") > 0, F.col("_all") * F.col("_s") / F.col("_sum")).otherwise(0.0).alias(f"want_{margin}"))
        cells = cells.join(wanted, margin)
    return cells


def rake(cells: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Add ``fitted``: the tokens of the cells after so many rounds over all margins."""
    fitted = pin(cells.withColumn("fitted", F.col("tokens").cast("double")), "cells")
    for done in range(0, rounds, PER_STAGE):
        for _ in range(min(PER_STAGE, rounds - done)):
            for margin in MARGINS:
                have = F.sum("fitted").over(Window.partitionBy(margin))
                fitted = fitted.withColumn("fitted", F.when(have > 0, F.col("fitted") * F.col(f"want_{margin}") / have).otherwise(0.0))
        fitted = pin(fitted, "cells")
    return fitted


def rated(cells: DataFrame, share: float) -> DataFrame:
    """Add weight and probability to raked cells."""
    weighed = pin(cells.withColumn("weight", F.when(F.col("tokens") > 0, F.col("fitted") / F.col("tokens")).otherwise(0.0)), "cells")
    rate = share
    for _ in range(RATE_STEPS):  # raises the rate until what is kept, with none above 1, has the wanted share
        kept, total = weighed.agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * rate)), F.sum("tokens")).first()
        if not kept:
            break
        rate = rate * (share * total) / kept
    return weighed.withColumn("probability", F.round(F.least(F.lit(1.0), F.col("weight") * rate), 9))


def mix(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, topic: Column | None = None, share: float = SHARE, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, tokens, weight, probability, sampled."""
    told = pin(described(docs, topic_of(F.col("text")) if topic is None else topic), "described")
    cells = told.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    final = rated(rake(with_targets(pin(cells, "cells"), targets or {}), rounds), share)
    drawn = told.join(pin(final.select(*MARGINS, "weight", "probability"), "probabilities"), list(MARGINS))
    return drawn.select("doc_id", *MARGINS, "tokens", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), (draw_of(F.col("doc_id"), seed) < F.col("probability")).alias("sampled"))


def sample(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, topic: Column | None = None, share: float = SHARE, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """The drawn documents, with all their columns."""
    kind = topic_of(F.col("text")) if topic is None else topic
    told = pin(described(docs, kind), "described")
    cells = pin(told.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    final = rated(rake(with_targets(cells, targets or {}), rounds), share)
    key, chance = free_name(docs, "_cell"), free_name(docs, "_chance")
    chances = final.select(F.struct(*MARGINS).alias(key), F.col("probability").alias(chance))
    own = F.struct(*(F.coalesce(F.col(c), F.lit("unknown")).alias(c) for c in ("source", "lang")), F.coalesce(kind, F.lit("unknown")).alias("topic"))
    joined = docs.withColumn(key, own).join(pin(chances, "probabilities"), key)
    return joined.where(draw_of(F.col("doc_id"), seed) < F.col(chance)).select(*docs.columns)
