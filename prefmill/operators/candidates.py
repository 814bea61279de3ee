"""Candidate answers: merge of workers, resume, upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefmill.functions.text import blank, dedup_key, nfkc_each, same_text, strip


def from_completions(df: DataFrame, worker: str, seed: int, expected: int, completions: str = "outputs") -> DataFrame:
    """candidates and error (null if sound) from a model's completions (text, finish_reason, stop_reason, token_ids).

    Texts are stripped; as many are needed as asked for, none blank, no two
    alike after normalisation.
    """
    made = F.transform(
        completions,
        lambda c, k: F.struct(
            k.alias("candidate_index"),
            F.lit(worker).alias("worker_id"),
            F.lit(seed).cast("long").alias("seed"),
            strip(c["text"]).alias("text"),
            c["finish_reason"].alias("finish_reason"),
            c["stop_reason"].alias("stop_reason"),
            F.when(c["token_ids"].isNotNull(), F.size(c["token_ids"])).alias("output_tokens"),
        ),
    )
    keys = F.transform(nfkc_each(F.transform(completions, lambda c: c["text"])), lambda t: dedup_key(t, unicode=False))
    error = (
        F.when(~F.coalesce(F.size(completions) == expected, F.lit(False)), "wrong number of completions")
        .when(F.exists(completions, lambda c: blank(c["text"])), "blank text")
        .when(F.size(F.array_distinct(keys)) != F.size(keys), "duplicate texts")
    )
    return df.withColumns({"error": error, "candidates": F.when(error.isNull(), made)})


def union_workers(workers: list[tuple[str, DataFrame]]) -> DataFrame:
    """id, worker_id, worker_ord, pos, candidate fields of several workers' nested outputs."""
    out = None
    for n, (worker, df) in enumerate(workers):
        rows = df.select("id", F.lit(worker).alias("worker_id"), F.lit(n).alias("worker_ord"), F.posexplode("candidates").alias("pos", "c"))
        rows = rows.select("id", "worker_id", "worker_ord", "pos", F.col("c.candidate_index").alias("candidate_index"), F.col("c.text").alias("text"), F.col("c.finish_reason").alias("finish_reason"))
        out = rows if out is None else out.unionByName(rows)
    return out


def first_distinct(cands: DataFrame, required: int, key: Column | None = None, id_col: str = "id") -> DataFrame:
    """The first ``required`` candidates of each task, equal texts counted once.

    Workers come in the given order, candidates in theirs; of equal texts the
    first is kept. Adds rank (from 1). Both windows are partitioned by the
    task, so a single shuffle serves them; texts are told apart by digests.
    """
    order = [F.col("worker_ord"), F.col("pos")]
    key = same_text("text") if key is None else key
    same = Window.partitionBy(id_col, "_key").orderBy(*order)
    once = cands.withColumn("_key", key).repartition(id_col).withColumn("_n", F.row_number().over(same)).where("_n = 1").drop("_n")
    return once.withColumn("rank", F.row_number().over(Window.partitionBy(id_col).orderBy(*order))).where(F.col("rank") <= required).drop("_key")


def merge_counts(tasks: DataFrame, cands: DataFrame, required: int, workers: list[str], key: Column | None = None, id_col: str = "id") -> DataFrame:
    """For each task: candidates, distinct ones, duplicates, workers without output, complete."""
    key = same_text("text") if key is None else key
    stats = cands.groupBy(id_col, key.alias("_key")).agg(F.count(F.lit(1)).alias("n"), F.collect_set("worker_id").alias("w"))
    stats = stats.groupBy(id_col).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("unique"), F.array_distinct(F.flatten(F.collect_list("w"))).alias("w"))
    out = tasks.join(stats, id_col, "left")
    unique = F.coalesce(F.col("unique"), F.lit(0)).cast("long")
    return out.select(
        *tasks.columns,
        unique.alias("unique_candidates"),
        F.lit(required).alias("required_candidates"),
        (F.coalesce("total", F.lit(0)).cast("long") - unique).alias("duplicate_candidates"),
        F.array_except(F.array(*map(F.lit, workers)), F.coalesce("w", F.array().cast("array<string>"))).alias("missing_worker_outputs"),
        (unique >= required).alias("complete"),
    )


def pending(tasks: DataFrame, done: DataFrame, retry: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Tasks without a complete result, and those asked for again even if complete."""
    if retry is not None:
        done = done.join(retry.select(key), key, "left_anti")
    return tasks.join(done.select(key), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace old rows of their key; columns as in ``new``."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert_results(results: DataFrame, failures: DataFrame, new: DataFrame, failed: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """A result replaces the old one and ends the failure; a failure replaces the old failure."""
    return upsert(results, new, keys), upsert(failures, failed, keys).join(new.select(*keys).distinct(), keys, "left_anti")


def in_source_order(df: DataFrame, tasks: DataFrame, key: str = "id", order: str = "task_ord") -> DataFrame:
    return df.join(tasks.select(key, order), key).orderBy(order)
