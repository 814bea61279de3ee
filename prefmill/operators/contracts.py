"""Record contracts as violation frames: rows are kept, breaches are listed.

A violation has id (as string), rule and detail. Rules are plain predicates,
so one scan checks all of them and good rows can be told by an anti-join or by
the same expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.functions.text import blank, dedup_key, strip


def violations(df: DataFrame, rules: dict[str, Column], key: str = "id") -> DataFrame:
    """A row for each rule that a row breaks; a rule is the predicate of the breach (null: no breach)."""
    listed = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    return df.select(F.col(key).cast("string").alias("id"), F.explode(listed).alias("rule"))


def good(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows that break none."""
    keep = F.lit(True)
    for broken in rules.values():
        keep = keep & ~F.coalesce(broken, F.lit(False))
    return df.where(keep)


def bad_id(c: str = "id") -> Column:
    return F.coalesce(F.col(c).cast("string") == "", F.lit(True))


def not_in(c: str, domain: list[str]) -> Column:
    return ~F.coalesce(F.col(c).isin(domain), F.lit(False))


def bad_dialogue(c: str = "prompt") -> Column:
    """Not exactly user, assistant, user with non-blank contents."""
    roles = F.transform(F.col(c), lambda m: m["role"])
    spoken = F.forall(F.col(c), lambda m: ~blank(m["content"]))
    return ~F.coalesce((roles == F.array(*map(F.lit, ("user", "assistant", "user")))) & spoken, F.lit(False))


def extra_keys(raw: str, allowed: list[str]) -> Column:
    """Whether a raw JSON object has other keys than exactly these."""
    keys = F.json_object_keys(F.col(raw))
    return ~F.coalesce(F.array_sort(keys) == F.array(*[F.lit(k) for k in sorted(allowed)]), F.lit(False))


def task_rules(categories: list[str]) -> dict[str, Column]:
    return {"id": bad_id(), "category": not_in("category", categories), "prompt": bad_dialogue(), "chosen": blank("chosen")}


def raw_task_rules(categories: list[str]) -> dict[str, Column]:
    """Two questions and two references, none blank."""
    def pair(c: str) -> Column:
        return ~F.coalesce((F.size(c) == 2) & F.forall(c, lambda x: ~blank(x)), F.lit(False))

    return {"id": bad_id(), "category": not_in("category", categories), "questions": pair("questions"), "references": pair("references")}


def preference_rules(categories: list[str]) -> dict[str, Column]:
    return {
        **task_rules(categories),
        "rejected": blank("rejected"),
        "identical": F.coalesce(strip("chosen") == strip("rejected"), F.lit(False)),
    }


def sft_rules() -> dict[str, Column]:
    last = F.element_at(F.col("messages"), -1)["role"]
    return {
        "messages": ~F.coalesce(F.size("messages") >= 2, F.lit(False)),
        "question_id": F.col("meta.question_id").isNull(),
        "turn": ~F.coalesce(F.col("meta.turn").isin(1, 2), F.lit(False)),
        "last_role": ~F.coalesce(last == "assistant", F.lit(False)),
    }


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def wrong_group_size(df: DataFrame, key: Column, size: int) -> DataFrame:
    """Groups that don't have exactly ``size`` rows."""
    return df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != size)


def unknown_keys(df: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is not among the known ones."""
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")


def worker_row_rules(expected: int, worker: str | None = None, unicode: bool = True) -> dict[str, Column]:
    """A worker's candidates: as many as asked for, its own, and no two with one normalised text."""
    texts = F.transform(F.col("candidates"), lambda c: c["text"])
    normal = F.transform(texts, lambda t: dedup_key(t, unicode=False)) if not unicode else texts
    rules = {
        "count": ~F.coalesce(F.size("candidates") == expected, F.lit(False)),
        "text": F.exists(texts, lambda t: blank(t)),
        "candidate_index": F.exists(F.col("candidates"), lambda c: F.coalesce(c["candidate_index"] < 0, F.lit(True))),
        "duplicate_text": F.size(F.array_distinct(normal)) != F.size(normal),
    }
    if worker is not None:
        rules["worker"] = F.exists(F.col("candidates"), lambda c: ~F.coalesce(c["worker_id"] == worker, F.lit(False)))
    return rules


def repeated_candidates(df: DataFrame, id_col: str = "id", candidates: str = "candidates") -> DataFrame:
    """Tasks in which two candidates have one id (``worker:index``), with that id and its count."""
    ids = F.explode(F.transform(candidates, lambda c: F.concat_ws(":", c["worker_id"], c["candidate_index"].cast("string")))).alias("candidate_id")
    return df.select(id_col, ids).groupBy(id_col, "candidate_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_empty(found: DataFrame, what: str, most: int = 20) -> None:
    """Raise with the first few keys if a violation frame has rows."""
    from prefmill.sources.jsonl import InputError

    rows = found.limit(most).collect()
    if rows:
        raise InputError(f"{what}: {[tuple(r) for r in rows]}")
