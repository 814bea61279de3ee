"""Margins of preference pairs and their statistics by several groupings at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.operators.quantiles import nearest_ranks, with_ranks


def margins(df: DataFrame, threshold: float = 0.05) -> DataFrame:
    """sum_margin, mean_margin and band (strictly beyond the threshold, else near zero)."""
    m = F.col("chosen_mean_log_prob") - F.col("rejected_mean_log_prob")
    return df.withColumns(
        {
            "sum_margin": F.col("chosen_sum_log_prob") - F.col("rejected_sum_log_prob"),
            "mean_margin": m,
            "margin_band": band(m, threshold),
        }
    )


def band(margin: Column, threshold: float) -> Column:
    return F.when(margin > threshold, "chosen_above_band").when(margin < -threshold, "rejected_above_band").otherwise("near_zero_band")


FRACTIONS = (0.1, 0.25, 0.5, 0.75, 0.9)


def distribution(c: str, prefix: str | None = None, fractions: tuple[float, ...] = FRACTIONS) -> list[Column]:
    """count, min, nearest-rank percentiles, max, mean and population deviation of a column.

    The percentiles' buffer holds a group's distinct values: give fractions for
    counts of tokens, and none for doubles (``quantiles.nearest_ranks``).
    """
    p = prefix or c
    ranks = [F.expr(f"percentile_disc({f}) WITHIN GROUP (ORDER BY {c})").alias(f"{p}_p{round(f * 100)}") for f in fractions]
    return [F.count(c).alias(f"{p}_count"), F.min(c).alias(f"{p}_min"), *ranks, F.max(c).alias(f"{p}_max"), F.avg(c).alias(f"{p}_mean"), F.stddev_pop(c).alias(f"{p}_stdev")]


def pearson(a: str, b: str) -> Column:
    """Correlation, null for fewer than two rows or a constant column."""
    spread = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    return F.when((F.count(F.lit(1)) > 1) & spread, F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def preference_counts(threshold: float = 0.05) -> list[Column]:
    m = F.col("mean_margin")
    return [
        F.count_if(m > threshold).alias("chosen_above_band"),
        F.count_if(F.abs(m) <= threshold).alias("near_zero_band"),
        F.count_if(m < -threshold).alias("rejected_above_band"),
        F.count_if(m > 0).alias("chosen_positive"),
        F.count_if(m < 0).alias("rejected_positive"),
        F.count_if(m == 0).alias("exact_tie"),
    ]


def summary(df: DataFrame, keys: list[str], threshold: float = 0.05) -> DataFrame:
    """The whole summary overall and by each key: one GROUPING SETS pass.

    Each row has grouping (the key's name, 'all') and group (its value). The
    percentiles of the margins are found by counting passes, those of token
    counts from their few distinct values.
    """
    known = df.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit("unknown")) for k in keys} | {"length_delta": (F.col("rejected_tokens") - F.col("chosen_tokens")).cast("double")})
    sets = [[], *[[F.col(k)] for k in keys]]
    ids = [F.grouping(k).alias(f"_g_{k}") for k in keys]
    aggs = [F.count(F.lit(1)).alias("n"), *preference_counts(threshold)]
    aggs += [F.count_if(F.col("sum_margin") > 0).alias("sum_chosen_positive"), F.count_if(F.col("sum_margin") < 0).alias("sum_rejected_positive"), F.count_if(F.col("sum_margin") == 0).alias("sum_exact_tie")]
    for c in ("sum_margin", "mean_margin", "chosen_tokens", "rejected_tokens", "length_delta"):
        aggs += distribution(c, fractions=() if c.endswith("margin") else FRACTIONS)
    aggs += [pearson("length_delta", "sum_margin").alias("corr_sum"), pearson("length_delta", "mean_margin").alias("corr_mean")]
    out = known.groupingSets(sets, *[F.col(k) for k in keys]).agg(*ids, *aggs)
    name, value = F.lit("all"), F.lit("all")
    for k in keys:
        name = F.when(F.col(f"_g_{k}") == 0, F.lit(k)).otherwise(name)
        value = F.when(F.col(f"_g_{k}") == 0, F.col(k)).otherwise(value)
    out = out.select(name.alias("grouping"), value.alias("group"), *[c for c in out.columns if c not in keys and not c.startswith("_g_")])
    sides = F.array(F.struct(F.lit("all").alias("grouping"), F.lit("all").alias("group")), *[F.struct(F.lit(k).alias("grouping"), F.col(k).alias("group")) for k in keys])
    ranks = nearest_ranks(known.select(F.inline(sides), "sum_margin", "mean_margin"), ["grouping", "group"], ["sum_margin", "mean_margin"], FRACTIONS)
    return with_ranks(out, ranks, ["grouping", "group"])


def with_context(rows: DataFrame, pairs: DataFrame, sides: DataFrame) -> DataFrame:
    """Margin rows with their split and the pair's category and review ('unknown' where there is none)."""
    review = [F.coalesce(F.col(f"review.{c}"), F.lit("unknown")).alias(n) for c, n in (("decision", "review_decision"), ("chosen_source", "chosen_source"), ("rejected_source", "rejected_source"))]
    known = pairs.select("id", "category", *review)
    out = rows.drop("category", "split", "review_decision", "chosen_source", "rejected_source").join(known, "id").join(sides.select("id", "split"), "id")
    return out.select("id", "category", "split", "review_decision", "chosen_source", "rejected_source", *[c for c in out.columns if c not in ("id", "category", "split", "review_decision", "chosen_source", "rejected_source")])


def review_priority(df: DataFrame, most: int | None = None, id_col: str = "id") -> DataFrame:
    """Rows by how close their margin is to zero; ids compare as strings. With ``most`` a top-k."""
    out = df.orderBy(F.abs("mean_margin"), F.col(id_col).cast("string"))
    return out.limit(most) if most else out
