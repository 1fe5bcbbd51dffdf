"""Connected components of an edge table, by the smallest id, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import pin

ROUNDS = 60


def components(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(id, component): the smallest id that each id of ``edges`` (a, b) reaches.

    A round gives every id the smallest label among its own, its neighbours' and its label's (pointer jumping), so
    chains shorten by halves. Minima are combined before they are shuffled, so a hub costs no task of its own. Each
    round is written to the shared folder; ids that no edge names are not listed.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    links = pin(both, "links")
    labels = pin(links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("c")).select("id", F.least("id", "c").alias("c")), "labels")
    for _ in range(rounds):
        heard = links.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("c").alias("near"))
        jumped = labels.join(labels.select(F.col("id").alias("c"), F.col("c").alias("far")), "c", "left")
        step = jumped.join(heard, "id").select("id", F.least("c", "far", "near").alias("c"), F.col("c").alias("was"))
        new = pin(step, "labels")
        if new.where("c < was").isEmpty():
            return new.select("id", F.col("c").alias("component"))
        labels = new.select("id", "c")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
