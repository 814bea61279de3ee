"""Connected components by alternating large-star and small-star steps.

Every step is joins and aggregations over the link table; no component is ever
gathered. Each round's links are written to the shared folder, so lineage stays
short and lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefmill.llm.util import discard, stored


def _large_star(links: DataFrame) -> DataFrame:
    """Tie each node's larger neighbours to its least neighbour or itself."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Tie each node's smaller neighbours and itself to the least of them (a > b in ``links``)."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (the least node reachable) of every node in links (a, b).

    Loops and repeated links are allowed; an empty table gives an empty result.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = stored(now, "links")
    sign = None
    for _ in range(rounds):
        got = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if got["n"] == 0 or (got["n"], got["h"]) == sign:
            break
        sign = (got["n"], got["h"])
        last, now = now, stored(_small_star(_large_star(now)), "links")
        discard(last)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
