"""Exact nearest-rank percentiles without a buffer of a group's values.

The value at a rank is found as one searches a page: the rows between the least
and the greatest value are counted in ``BUCKETS`` ranges, the range that holds
the rank becomes the next interval, until it holds one value. A pass is one
scan with partial counts; a few passes suffice for any doubles. What comes to
the driver is a row a group, column, fraction and range.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 512
#: Half of the greatest double: intervals are halved so that their width is finite.
HALF = 8.9e307


def nearest_ranks(df: DataFrame, by: list[str], columns: list[str], fractions: tuple[float, ...]) -> DataFrame:
    """A row a group with ``{column}_p{fraction}``: the value of rank ceil(fraction * n); nulls and NaN don't count.

    ``by`` may be empty. There should be few groups (a category, a source); a
    group's size doesn't matter.
    """
    spark = df.sparkSession
    keys = F.struct(*[F.col(b).cast("string").alias(f"k{i}") for i, b in enumerate(by)], F.lit(0).alias("_"))
    parts = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns])
    own = [f"_key{i}" for i in range(len(by))]
    tall = df.select(F.to_json(keys, {"ignoreNullFields": "false"}).alias("g"), *[F.col(b).alias(o) for b, o in zip(by, own, strict=True)], F.explode(parts).alias("x"))
    tall = tall.select("g", *own, "x.c", "x.v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    stats = tall.groupBy("g", *own, "c").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    open_ = []  # [group, column, fraction, rank within the interval, lo, hi]
    groups = {}
    for r in stats:
        groups[r["g"]] = tuple(r[o] for o in own)
        open_ += [[r["g"], r["c"], f, max(1, math.ceil(round(f * r["n"], 9))), r["lo"], r["hi"]] for f in fractions]
    found = {}
    while open_:
        for g, c, f, _, lo, hi in open_:
            if lo == hi:
                found[g, c, f] = lo
        open_ = [t for t in open_ if t[4] < t[5]]
        if not open_:
            break
        spans = sorted({(t[0], t[1], t[4], t[5]) for t in open_})
        wanted = F.broadcast(spark.createDataFrame(spans, "g string, c string, lo double, hi double"))
        low, high = F.greatest(F.col("lo"), F.lit(-2 * HALF)) / 2, F.least(F.col("hi"), F.lit(2 * HALF)) / 2
        inner = F.floor((F.col("v") / 2 - low) / (high - low) * BUCKETS).cast("int")
        bucket = F.when(F.col("v") == F.col("lo"), -1).when(F.col("v") == F.col("hi"), BUCKETS + 1).otherwise(inner)
        rows = tall.join(wanted, ["g", "c"]).where("v between lo and hi").groupBy("g", "c", "lo", "hi", bucket.alias("b"))
        counts: dict[tuple, list] = {}
        for r in rows.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("from_"), F.max("v").alias("to_")).collect():
            counts.setdefault((r["g"], r["c"], r["lo"], r["hi"]), []).append((r["b"], r["n"], r["from_"], r["to_"]))
        for t in open_:
            for _, n, lo, hi in sorted(counts[t[0], t[1], t[4], t[5]]):
                if t[3] <= n:
                    t[4], t[5] = lo, hi
                    break
                t[3] -= n
    names = [(c, f, f"{c}_p{round(100 * f)}") for c in columns for f in fractions]
    schema = [df.select(*by).schema[b].simpleString() for b in by]
    ddl = ", ".join([*(s.replace(":", " ", 1) for s in schema), *(f"`{n}` double" for _, _, n in names)])
    return spark.createDataFrame([(*k, *(found.get((g, c, f)) for c, f, _ in names)) for g, k in groups.items()], ddl)


def with_ranks(aggregated: DataFrame, ranks: DataFrame, by: list[str]) -> DataFrame:
    """An aggregated table with its percentiles beside it; null keys match."""
    if not by:
        return aggregated.join(F.broadcast(ranks))
    other = ranks.withColumnsRenamed({b: f"_{b}" for b in by})
    same = F.lit(True)
    for b in by:
        same = same & aggregated[b].eqNullSafe(other[f"_{b}"])
    return aggregated.join(F.broadcast(other), same, "left").drop(*[f"_{b}" for b in by])
