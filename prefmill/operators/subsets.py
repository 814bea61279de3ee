"""Balanced and length-aware subsets of preference pairs.

Random choice is by SHA-256 rank of (seed, arm, category, id): deterministic
whatever the partitioning, and computable by any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefmill.functions.hashing import sha_rank
from prefmill.operators.quantiles import nearest_ranks, with_ranks
from prefmill.sources.jsonl import InputError

#: Length-ratio limits of the feasibility table (fixed values).
THRESHOLDS = [1.2, 1.33, 1.5, 2.0, 2.5, 3.0]


def length_features(df: DataFrame, chosen: str = "chosen_tokens", rejected: str = "rejected_tokens") -> DataFrame:
    """length_ratio (longer to shorter) and rejected_longer (strictly)."""
    a, b = F.col(chosen), F.col(rejected)
    return df.withColumns({"length_ratio": F.try_divide(F.greatest(a, b), F.least(a, b)), "rejected_longer": b > a})


def arm_rank(seed: int, arm: str, category: str = "category", id_col: str = "id") -> Column:
    return sha_rank(seed, arm, F.col(category), F.col(id_col).cast("string"))


def top_by_category(df: DataFrame, k: int, order: list[Column], category: str = "category") -> DataFrame:
    """k rows a category; partitions keep k rows each before the shuffle (window group limit)."""
    w = Window.partitionBy(category).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def require_quota(df: DataFrame, k: int, categories: list[str], category: str = "category") -> None:
    """Every category of the domain has at least k rows."""
    have = {r[0]: r[1] for r in df.where(F.col(category).isin(categories)).groupBy(category).count().collect()}
    short = {c: have.get(c, 0) for c in categories if have.get(c, 0) < k}
    if short:
        raise InputError(f"categories with fewer than {k} rows: {short}")


def sample_balanced(df: DataFrame, k: int, seed: int, arm: str, category: str = "category", id_col: str = "id") -> DataFrame:
    return top_by_category(df, k, [arm_rank(seed, arm, category, id_col), F.col(id_col)], category)


def length_priority(df: DataFrame, k: int, seed: int, category: str = "category", id_col: str = "id") -> DataFrame:
    """The k rows of each category whose lengths are closest; ties by rank."""
    return top_by_category(df, k, [F.col("length_ratio"), arm_rank(seed, "length-priority", category, id_col), F.col(id_col)], category)


def allocate(low: list[int], high: list[int], wanted: list[int], total: int) -> list[int] | None:
    """Whole numbers in [low, high] with a given sum, nearest to ``wanted`` in L1; ties lexicographically least.

    A dynamic program over categories and sums; None if there is none.
    """
    best: dict[int, tuple[int, tuple[int, ...]]] = {0: (0, ())}
    for a, b, w in zip(low, high, wanted, strict=True):
        new: dict[int, tuple[int, tuple[int, ...]]] = {}
        for s, (cost, picked) in best.items():
            for x in range(a, min(b, total - s) + 1):
                got = (cost + abs(x - w), (*picked, x))
                if s + x not in new or got < new[s + x]:
                    new[s + x] = got
        best = new
    return list(best[total][1]) if total in best else None


def high_matched(control: DataFrame, pool: DataFrame, k: int, seed: int, categories: list[str]) -> DataFrame:
    """Control with its medium-confidence rows replaced from the high-confidence pool.

    Category totals and the number of swapped pairs stay. Counts by category
    and decision (a few rows) come to the driver, which allocates the swaps;
    choosing rows is a window over the pool.
    """
    kept = control.where("confidence = 'high'")
    free = pool.join(kept.select("id"), "id", "left_anti")
    count = lambda df: {(r[0], r[1]): r[2] for r in df.groupBy("category", "decision").count().collect()}
    n_control, n_kept, n_free = count(control), count(kept), count(free)
    of = lambda n, c, d: n.get((c, d), 0)
    slots = [k - sum(v for (c2, _), v in n_kept.items() if c2 == c) for c in categories]
    high = [min(s, of(n_free, c, "swap_pair")) for c, s in zip(categories, slots, strict=True)]
    low = [max(0, s - of(n_free, c, "accept_pair")) for c, s in zip(categories, slots, strict=True)]
    wanted = [of(n_control, c, "swap_pair") - of(n_kept, c, "swap_pair") for c in categories]
    swaps = allocate(low, high, wanted, sum(wanted))
    if swaps is None:
        raise InputError("no allocation keeps the numbers of accepted and swapped pairs")
    quota = [(c, d, n) for c, s, x in zip(categories, slots, swaps, strict=True) for d, n in (("swap_pair", x), ("accept_pair", s - x))]
    limits = df_of(control, quota, "category string, decision string, quota int")
    w = Window.partitionBy("category", "decision").orderBy(sha_rank(seed, "high-matched", F.col("decision"), F.col("category"), F.col("id").cast("string")), "id")
    chosen = free.join(F.broadcast(limits), ["category", "decision"]).withColumn("_rank", F.row_number().over(w)).where("_rank <= quota")
    return kept.unionByName(chosen.select(*kept.columns))


def df_of(like: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A small driver-side table in the same session."""
    return like.sparkSession.createDataFrame(rows, schema)


def subset_summary(df: DataFrame, by: list[str]) -> DataFrame:
    ranks = nearest_ranks(df, by, ["length_ratio"], (0.5, 0.9)).withColumnsRenamed({"length_ratio_p50": "ratio_p50", "length_ratio_p90": "ratio_p90"})
    out = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("chosen_tokens").alias("chosen_mean"),
        F.avg("rejected_tokens").alias("rejected_mean"),
        F.avg("length_ratio").alias("ratio_mean"),
        F.max("length_ratio").alias("ratio_max"),
        F.count_if("rejected_longer").alias("rejected_longer_count"),
    )
    return with_ranks(out, ranks, by)


def feasibility(df: DataFrame, categories: DataFrame, thresholds: list[float] | None = None, category: str = "category") -> DataFrame:
    """For each limit and category the rows within it, zero-filled, and the least over categories.

    The rows are counted once, by category and by the limits they meet; no row
    is multiplied by the limits.
    """
    limits = thresholds or THRESHOLDS
    counted = df.groupBy(category).agg(*[F.count_if(F.col("length_ratio") <= t).alias(f"t{k}") for k, t in enumerate(limits)])
    full = categories.select(category).join(counted, category, "left").na.fill(0)
    tall = full.select(category, F.expr(f"stack({len(limits)}, {', '.join(f'CAST({t} AS DOUBLE), t{k}' for k, t in enumerate(limits))}) AS (threshold, n)"))
    by_limit = tall.groupBy("threshold").agg(F.sum("n").alias("total"), F.min("n").alias("per_category_max"))
    return tall.join(by_limit, "threshold")


def overlap(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """overlap_rows, replaced_rows (in a, not in b), added_rows."""
    j = a.select(key).distinct().withColumn("_a", F.lit(1)).join(b.select(key).distinct().withColumn("_b", F.lit(1)), key, "full")
    return j.agg(F.count_if(F.expr("_a = 1 AND _b = 1")).alias("overlap_rows"), F.count_if(F.expr("_a = 1 AND _b IS NULL")).alias("replaced_rows"), F.count_if(F.expr("_a IS NULL")).alias("added_rows"))


def same_counts(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One row: whether two arms have equal counts for every value of the keys."""
    ca = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("_a"))
    cb = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("_b"))
    return ca.join(cb, keys, "full").agg(F.coalesce(F.bool_and(F.col("_a").eqNullSafe(F.col("_b"))), F.lit(True)).alias("equal"))
