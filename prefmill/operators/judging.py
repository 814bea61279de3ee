"""Judging of candidate answers: blind pairs, work units, verdicts, selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefmill.functions.hashing import candidate_is_a, fingerprint, sha_rank
from prefmill.functions.text import blank, strip

#: Order of the judge's confidence labels (fixed values).
CONFIDENCE = {"low": 0, "medium": 1, "high": 2}
#: Score difference up to which two answers tie.
TIE = 2


def explode_candidates(tasks: DataFrame) -> DataFrame:
    """A row a candidate of nested tasks, with its id ``worker:index`` and position."""
    flat = tasks.select("id", "category", "prompt", "chosen", F.posexplode("candidates").alias("pos", "c"))
    return flat.select("id", "category", "prompt", "chosen", "pos", "c.*").withColumn("candidate_id", candidate_id())


def candidate_id(worker: str = "worker_id", index: str = "candidate_index") -> Column:
    return F.concat_ws(":", F.col(worker), F.col(index).cast("string"))


def split_excluded(cands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(to judge, excluded with reason): answers cut off by the length limit aren't judged.

    The filter stands before any scorer, as Spark can't move it through one.
    """
    cut = F.coalesce(F.col("finish_reason") == "length", F.lit(False))
    return cands.where(~cut), cands.where(cut).withColumn("reason", F.lit("finish_reason=length"))


def build_pairs(cands: DataFrame, rubrics: DataFrame | None, seed: int, id_type: str = "int") -> DataFrame:
    """Blind pairs: side labels, instruction and its fingerprint; ``rubrics`` has a row a category."""
    a = candidate_is_a(id_type, F.col("id"), F.col("candidate_id"), seed)
    out = cands.withColumns(
        {"candidate_label": F.when(a, "A").otherwise("B"), "chosen_label": F.when(a, "B").otherwise("A"), "answer_a": F.when(a, F.col("text")).otherwise(F.col("chosen")), "answer_b": F.when(a, F.col("chosen")).otherwise(F.col("text"))}
    )
    if rubrics is not None:
        out = out.join(rubrics, "category", "left")
    else:
        out = out.withColumn("rubric", F.lit(""))
    payload = F.to_json(F.struct(F.col("prompt").alias("dialogue"), "answer_a", "answer_b"))
    out = out.withColumn("instruction", F.concat(F.coalesce("rubric", F.lit("")), F.lit("\n\n"), payload))
    return out.withColumn("prompt_fingerprint", fingerprint(F.col("instruction")))


def group_labels(pairs: DataFrame, seed: int) -> DataFrame:
    """Labels A, B, C of the chosen answer and two candidates of a group, in seeded order.

    ``pairs`` has id, group, candidate_id, text, chosen; returns id, group, label, source, text.
    """
    answers = pairs.select("id", "group", F.col("candidate_id").alias("source"), "text").unionByName(
        pairs.select("id", "group", F.lit("original").alias("source"), F.col("chosen").alias("text")).distinct()
    )
    w = Window.partitionBy("id", "group").orderBy(sha_rank(seed, F.col("id").cast("string"), F.col("group").cast("string"), F.col("source")), "source")
    return answers.withColumn("label", F.substring(F.lit("ABC"), F.row_number().over(w), F.lit(1)))


def stale_cache(cache: DataFrame, pairs: DataFrame, model: str) -> DataFrame:
    """Cached judgments that name an unknown pair, another prompt or another judge."""
    known = pairs.select("id", "candidate_id", F.col("prompt_fingerprint").alias("_now"))
    joined = cache.join(known, ["id", "candidate_id"], "left")
    reason = F.when(F.col("_now").isNull(), "unknown pair").when(~F.col("_now").eqNullSafe(F.col("prompt_fingerprint")), "prompt changed").when(~F.col("judge_model").eqNullSafe(F.lit(model)), "judge changed")
    return joined.withColumn("stale", reason).where("stale is not null").drop("_now")


def pending_units(pairs: DataFrame, done: DataFrame, group_size: int, id_col: str = "id", order: str = "pos") -> DataFrame:
    """Pairs still to judge, with group, mode: 'groupwise' only for full groups of two without any result."""
    w = Window.partitionBy(id_col).orderBy(order)
    chunk = pairs.withColumn("group", F.floor((F.row_number().over(w) - 1) / group_size).cast("int"))
    marked = chunk.join(done.select(id_col, "candidate_id").withColumn("_done", F.lit(True)), [id_col, "candidate_id"], "left")
    g = Window.partitionBy(id_col, "group")
    size, missing = F.count(F.lit(1)).over(g), F.count_if(F.col("_done").isNull()).over(g)
    grouped = (F.lit(group_size) == 2) & (size == 2) & (missing == 2)
    return marked.withColumn("mode", F.when(grouped, "groupwise").otherwise("pairwise")).where("_done is null").drop("_done")


def length_fallback(units: DataFrame, tokens: str, max_tokens: int, max_model_len: int) -> DataFrame:
    """Groups whose prompt leaves no room for the answer are judged pair by pair."""
    long = (F.col("mode") == "groupwise") & (F.col(tokens) + max_tokens > max_model_len)
    return units.withColumns({"fallback": long, "mode": F.when(long, "pairwise").otherwise(F.col("mode"))})


def _score(c: Column) -> Column:
    return c.isNotNull() & c.between(0, 100)


def parse_pair_output(df: DataFrame, text: str = "output") -> DataFrame:
    """winner, score_a, score_b, confidence, reason and error of a judge's JSON; error is null if it is sound."""
    body = strip(text)
    j = F.from_json(body, "winner string, score_a int, score_b int, confidence string, reason string")
    keys = F.array_sort(F.json_object_keys(body))
    a, b, winner = j["score_a"], j["score_b"], j["winner"]
    error = (
        F.when(keys.isNull(), "invalid JSON")
        .when(keys != F.array(*map(F.lit, ("confidence", "reason", "score_a", "score_b", "winner"))), "wrong fields")
        .when(~F.coalesce(winner.isin("A", "B", "tie"), F.lit(False)), "winner")
        .when(~(_score(a) & _score(b)), "score")
        .when(~F.coalesce(j["confidence"].isin(*CONFIDENCE), F.lit(False)), "confidence")
        .when(blank(j["reason"]), "reason")
        .when(((winner == "A") & (a <= b)) | ((winner == "B") & (b <= a)) | ((winner == "tie") & (F.abs(a - b) > TIE)), "winner and scores disagree")
    )
    return df.withColumns({"winner": winner, "score_a": a, "score_b": b, "confidence": j["confidence"], "reason": strip(j["reason"]), "error": error})


def parse_group_output(df: DataFrame, text: str = "output") -> DataFrame:
    """Scores and reasons of three labels, confidence and error."""
    body = strip(text)
    labels = ("a", "b", "c")
    names = [*(f"score_{x}" for x in labels), *(f"reason_{x}" for x in labels), "confidence"]
    j = F.from_json(body, ", ".join(f"{n} {'int' if n.startswith('score') else 'string'}" for n in names))
    keys = F.array_sort(F.json_object_keys(body))
    scores_ok, reasons_bad = F.lit(True), F.lit(False)
    for x in labels:
        scores_ok = scores_ok & _score(j[f"score_{x}"])
        reasons_bad = reasons_bad | blank(j[f"reason_{x}"])
    error = (
        F.when(keys.isNull(), "invalid JSON")
        .when(keys != F.array(*map(F.lit, sorted(names))), "wrong fields")
        .when(~scores_ok, "score")
        .when(reasons_bad, "reason")
        .when(~F.coalesce(j["confidence"].isin(*CONFIDENCE), F.lit(False)), "confidence")
    )
    return df.withColumns({**{n: strip(j[n]) if n.startswith("reason") else j[n] for n in names}, "error": error})


def pair_verdict(winner: Column, chosen_label: Column) -> Column:
    """A pair's verdict trusts the judge's winner."""
    return F.when(winner == "tie", "tie").when(winner == chosen_label, "chosen_better").otherwise("candidate_better")


def side_score(label: Column, a: Column, b: Column) -> Column:
    return F.when(label == "A", a).otherwise(b)


def group_verdict(chosen: Column, candidate: Column) -> Column:
    """A group's verdict follows the score difference."""
    gap = chosen - candidate
    return F.when(F.abs(gap) <= TIE, "tie").when(gap > 0, "chosen_better").otherwise("candidate_better")


def progress(tasks: DataFrame, pairs: DataFrame, excluded: DataFrame, done: DataFrame, units: DataFrame) -> DataFrame:
    """name, n: what a judging run has to do. A unit is a pair, or a group of pairs in mode 'groupwise'."""
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")

    groups = units.where("mode = 'groupwise'").select("id", "group").distinct()
    alone = units.where("mode = 'pairwise'")
    out = one("tasks", tasks)
    for name, df in (("pairs", pairs), ("excluded_candidates", excluded), ("completed_pairs", done), ("pending_pairs", units), ("groupwise_units", groups), ("pairwise_units", alone)):
        out = out.union(one(name, df))
    fallback = units.where("fallback").select("id", "group").distinct() if "fallback" in units.columns else units.limit(0)
    return out.union(one("length_fallback_groups", fallback))


def failure_rows(units: DataFrame, stage: str, reason: Column, most: int = 1200) -> DataFrame:
    """A dead letter for each pair of failed units."""
    return units.select("id", "category", "candidate_id", F.lit(stage).alias("stage"), F.substring(reason, 1, most).alias("reason"))


def confidence_order(c: str = "confidence") -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in CONFIDENCE.items() for x in kv]), F.col(c))


def best_rejected(fields: list[str]) -> Column:
    """Aggregate: of judgments won by the chosen answer the strongest candidate.

    By candidate score (high first), score gap (small first), confidence (high
    first), candidate id.
    """
    order = F.struct(-F.col("candidate_score"), F.col("chosen_score") - F.col("candidate_score"), -confidence_order(), F.col("candidate_id"))
    return F.min_by(F.struct(*fields), F.when(F.col("verdict") == "chosen_better", order))


def task_status(selected: Column, review: Column) -> Column:
    return F.when(selected & review, "selected_with_chosen_review").when(selected, "selected").when(review, "chosen_review").otherwise("no_clear_rejected")


def aggregate_tasks(cands: DataFrame, judgments: DataFrame, excluded: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """(judged tasks, incomplete tasks).

    A task is incomplete if a candidate is neither judged nor excluded. One
    aggregation by task makes both.
    """
    keys = [id_col, "candidate_id"]
    facts = ["verdict", "candidate_score", "chosen_score", "confidence", "reason"]
    rows = (
        cands.join(judgments.select(*keys, *facts, F.lit(True).alias("_judged")), keys, "left")
        .join(excluded.select(*keys, F.lit(True).alias("_excluded")), keys, "left")
        .withColumns({"_judged": F.coalesce("_judged", F.lit(False)) & F.col("_excluded").isNull(), "_excluded": F.coalesce("_excluded", F.lit(False))})
    )
    listed = lambda when: F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("pos", "candidate_id")))), lambda x: x["candidate_id"])
    judged = F.col("_judged")
    picked = ["candidate_id", "worker_id", "candidate_index", "text", "candidate_score", "chosen_score", "confidence", "reason"]
    rows = rows.withColumn("verdict", F.when(judged, F.col("verdict")))
    by_task = rows.groupBy(id_col).agg(
        F.first("category").alias("category"),
        listed(~judged & ~F.col("_excluded")).alias("missing_candidate_ids"),
        listed(F.col("_excluded")).alias("excluded_candidate_ids"),
        listed(F.col("verdict") == "candidate_better").alias("review_candidate_ids"),
        best_rejected(picked).alias("selected_rejected"),
        F.count_if(judged).alias("judged"),
    )
    complete = F.size("missing_candidate_ids") == 0
    selected, review = F.col("selected_rejected").isNotNull(), F.size("review_candidate_ids") > 0
    done = by_task.where(complete).withColumns({"status": task_status(selected, review), "chosen_review": review}).drop("missing_candidate_ids")
    return done, by_task.where(~complete).select(id_col, "category", "missing_candidate_ids", "excluded_candidate_ids", F.lit("missing judge results").alias("reason"))
