"""Train and evaluation splits that are disjoint, exhaustive and deterministic."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefmill.functions.hashing import sha_rank
from prefmill.sources.jsonl import InputError

#: Categories whose first rows are broadcast; more of them are joined by a shuffle.
BROADCAST_CATEGORIES = 10_000


def stratified(df: DataFrame, ratio: float, seed: int, category: str = "category", id_col: str = "id") -> DataFrame:
    """Add split ('train' or 'eval'): each category is in both.

    Each category's first row by rank is for evaluation, its second for
    training; the rest is dealt until evaluation has its share, at least a row
    a category; null is a category too. The rest's order is a hash, so 'the first m of the rest' is
    found from counts of its leading digits: only the rows of one bucket are
    ranked in one place, never the whole table.
    """
    if not 0 < ratio < 1:
        raise InputError("ratio must lie between 0 and 1")
    rank = sha_rank(seed, "split", F.col(category), F.col(id_col).cast("string"))
    # two rows a category are found by aggregation, not by sorting categories
    keyed = df.withColumn("_h", rank)
    head = F.struct("_h", F.col(id_col).alias("_id"))
    heads = keyed.groupBy(category).agg(F.count(F.lit(1)).alias("n"), F.min(head).alias("first"))
    sizes = heads.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("c"), F.min("n").alias("least")).first()
    n, cats = sizes["n"] or 0, sizes["c"] or 0
    if n < 2 or sizes["least"] < 2:
        raise InputError("each category needs at least two rows")
    target = min(max(cats, n - math.floor(n * ratio)), n - cats)
    firsts = _small(heads.select(F.col(category).alias("_c"), F.col("first").alias("_f")), cats)
    second = keyed.join(firsts, F.col(category).eqNullSafe(F.col("_c"))).where(head > F.col("_f"))
    marks = second.groupBy("_c").agg(F.min("_f._h").alias("_first"), F.min(head).alias("second")).select("_c", "_first", F.col("second._h").alias("_second"))
    marked = keyed.join(_small(marks, cats), F.col(category).eqNullSafe(F.col("_c"))).drop("_c")
    rest = (F.col("_h") != F.col("_first")) & (F.col("_h") != F.col("_second"))
    order = sha_rank(seed, "rest", F.col("_h"))
    marked = marked.withColumn("_rest", F.when(rest, order))
    cut = nth_hash(marked.where("_rest is not null"), "_rest", target - cats)
    is_eval = (F.col("_h") == F.col("_first")) | F.coalesce(F.col("_rest") <= F.lit(cut), F.lit(False))
    return marked.withColumn("split", F.when(is_eval, "eval").otherwise("train")).drop("_h", "_first", "_second", "_rest")


def _small(rows: DataFrame, n: int) -> DataFrame:
    """A table of ``n`` rows, broadcast where that is few."""
    return F.broadcast(rows) if n <= BROADCAST_CATEGORIES else rows


def nth_hash(df: DataFrame, c: str, n: int, digits: int = 3) -> str:
    """The n-th least hexadecimal hash of a column ('' for n = 0).

    Hashes are counted by their leading digits, then by more digits of the one
    bucket that holds the n-th, until it is small enough to be ranked.
    """
    if n <= 0:
        return ""
    prefix, left = "", n
    while True:
        within = df.where(F.startswith(F.col(c), F.lit(prefix))) if prefix else df
        at = len(prefix) + digits
        counts = sorted((r[0], r[1]) for r in within.groupBy(F.substring(c, 1, at)).count().collect())  # at most 16^digits rows
        for p, k in counts:
            if left <= k:
                break
            left -= k
        else:
            return "g"
        prefix, size = p, k
        if size <= 10_000 or at >= 64:
            found = df.where(F.startswith(F.col(c), F.lit(prefix))).select(c).orderBy(c).limit(left).collect()
            return found[-1][0]


def grouped(df: DataFrame, ratio: float, seed: int, group: str) -> DataFrame:
    """Add split so that a group's rows stay together and both sides have a group; null is a group too.

    A row's side follows from its group's hash alone, so no row is moved.
    """
    rank = sha_rank(seed, "group", F.col(group).cast("string"))
    groups = df.select(group).distinct().withColumn("_h", rank)
    n = groups.count()
    if n < 2:
        raise InputError("a grouped split needs at least two groups")
    train = min(max(1, math.floor(n * ratio)), n - 1)
    cut = nth_hash(groups, "_h", train)
    return df.withColumn("split", F.when(rank <= cut, "train").otherwise("eval"))


def split_counts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    return df.groupBy("split", *(by or [])).agg(F.count(F.lit(1)).alias("n"))


def leakage(df: DataFrame, key: str) -> DataFrame:
    """Keys on both sides; empty if the split is sound."""
    return df.groupBy(key).agg(F.count_distinct("split").alias("sides")).where("sides > 1")


def ranked(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """Add rank within groups."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
