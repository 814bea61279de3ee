"""Reviews: their rules and the preference pairs that they decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.functions.text import blank, strip

DECISIONS = ["accept_pair", "swap_pair", "skip"]


def _exists(source: Column) -> Column:
    return F.coalesce(F.array_contains(F.map_keys("candidates"), source), F.lit(False))


def review_rules() -> dict[str, Column]:
    """Breaches of a review joined with its source (category as source_category, candidates as map id -> struct)."""
    accept, swap, skip = (F.coalesce(F.col("decision") == d, F.lit(False)) for d in DECISIONS)
    original = F.coalesce(F.col("chosen_source") == "original", F.lit(False))
    against = F.coalesce(F.col("rejected_source") == "original", F.lit(False))
    return {
        "unknown_source": F.col("candidates").isNull(),
        "category": ~F.col("category").eqNullSafe(F.col("source_category")),
        "decision": ~(accept | swap | skip),
        "confidence": ~F.coalesce(F.col("confidence").isin("low", "medium", "high"), F.lit(False)),
        "gemma_status": blank("gemma_status"),
        "reason": blank("reason"),
        "accept_pair": accept & ~(original & _exists(F.col("rejected_source"))),
        "swap_pair": swap & ~(against & _exists(F.col("chosen_source"))),
        "skip": skip & ~(original & F.col("rejected_source").isNull()),
    }


def with_sources(reviews: DataFrame, sources: DataFrame) -> DataFrame:
    """Reviews with their source's prompt, chosen, candidates (map) and category."""
    s = sources.select("id", F.col("category").alias("source_category"), "prompt", "chosen", "candidates")
    return reviews.join(s, "id", "left")


def candidate_map(c: str = "candidates") -> Column:
    """Nested candidates as a map from ``worker:index``."""
    return F.map_from_entries(F.transform(F.col(c), lambda x: F.struct(F.concat_ws(":", x["worker_id"], x["candidate_index"].cast("string")), x)))


def resolve(source: Column) -> Column:
    """A source's text: the original, or a candidate that wasn't cut off; else null."""
    c = F.try_element_at(F.col("candidates"), source)
    return F.when(source == "original", F.col("chosen")).when(~F.coalesce(c["finish_reason"] == "length", F.lit(False)), c["text"])


def finalize(joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(preference pairs, failed reviews): skipped reviews make none; texts that don't resolve or are equal fail."""
    decided = joined.where(F.col("decision") != "skip").withColumns({"_chosen": resolve(F.col("chosen_source")), "_rejected": resolve(F.col("rejected_source"))})
    failure = F.when(F.col("_chosen").isNull() | F.col("_rejected").isNull(), "unresolved").when(strip("_chosen") == strip("_rejected"), "identical")
    decided = decided.withColumn("_failure", failure)
    review = F.struct("decision", "chosen_source", "rejected_source", "gemma_status", "reason", "confidence")
    pairs = decided.where("_failure is null").select("id", "category", "prompt", F.col("_chosen").alias("chosen"), F.col("_rejected").alias("rejected"), review.alias("review"))
    return pairs, decided.where("_failure is not null").select("id", F.col("_failure").alias("reason"))


def uncovered(sources: DataFrame, reviews: DataFrame) -> DataFrame:
    """Sources without a review."""
    return sources.select("id").join(reviews.select("id"), "id", "left_anti")


def review_report(sources: DataFrame, reviews: DataFrame, pairs: DataFrame) -> DataFrame:
    """(measure, value, n): counts of rows, decisions, confidences and pairs by category."""
    def by(df: DataFrame, name: str, c: str) -> DataFrame:
        return df.groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("measure"), "value", "n")

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("measure"), F.lit("").alias("value"), "n")

    out = rows(sources, "source_rows").union(rows(reviews, "review_rows")).union(rows(pairs, "preference_pairs"))
    return out.union(by(reviews, "decision", "decision")).union(by(reviews, "confidence", "confidence")).union(by(pairs, "category", "category"))
