"""Command line: ``python -m prefmill.cli COMMAND ...``.

Exit code 1 on a broken contract or a failed gate, 2 where re-evaluation leaves
rows for manual review. Models are outside: ``--scorer MODULE:FUNCTION`` names a
function that builds a scorer (a list of row dicts to a list of dicts).
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.operators import candidates, contracts, evaluation, judging, margins, quality, reviews, scorers, splits, subsets, tasks
from prefmill.scratch import stored
from prefmill.sources import schemas, sinks
from prefmill.sources.jsonl import InputError, category_prompts, expand_inputs, read_id_list, read_strict


def scorer(name: str) -> Callable[[], scorers.Scorer]:
    """A function by its name MODULE:FUNCTION; looked up where it is called."""
    module, _, function = name.partition(":")

    def make() -> scorers.Scorer:
        return getattr(importlib.import_module(module), function)()

    return make


def _there(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    """Rows of an output that may not have been written yet."""
    try:
        return read_strict(spark, path, schema) if path else spark.createDataFrame([], schema)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


COMPLETIONS = "outputs array<struct<text:string,finish_reason:string,stop_reason:string,token_ids:array<int>>>"
FAILURE = "id long, category string, candidate_id string, stage string, reason string"


def generate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Candidates of tasks that have none yet, and of those asked for again; failures are written beside them."""
    tasks.check_judging(a.batch_size, a.max_model_len, a.max_tokens, a.temperature)
    sinks.distinct_paths(a.output, a.failures)
    todo = read_tasks(spark, a.tasks, a.categories)
    again = read_id_list(spark, a.retry_ids) if a.retry_ids else None
    todo = candidates.pending(todo, _there(spark, a.output, schemas.WORKER_OUTPUT), again)
    if a.dry_run:
        print(json.dumps({"pending": todo.count()}))
        return 0
    rows = todo.withColumns({"count": F.lit(a.candidate_count), "seed": F.lit(a.seed), "max_tokens": F.lit(a.max_tokens), "temperature": F.lit(a.temperature), "top_p": F.lit(a.top_p)})
    made = stored(scorers.score(rows, scorer(a.scorer), COMPLETIONS, "generate", a.batch_size, keep=["id", "category"]).withColumnRenamed("error", "failed"), "completions")
    made = candidates.from_completions(made, a.worker_id, a.seed, a.candidate_count).withColumn("error", F.coalesce("failed", "error"))
    sinks.append_jsonl(made.where("error is null").select("id", "category", "candidates"), a.output)
    sinks.append_jsonl(made.where("error is not null").select("id", "category", F.lit(None).cast("string").alias("candidate_id"), F.lit("generate").alias("stage"), F.substring("error", 1, 1000).alias("reason")), a.failures)
    return 0


PAIR = "id long, category string, candidate_id string, verdict string, chosen_score int, candidate_score int, confidence string, reason string, judge_model string, judge_mode string, prompt_fingerprint string"


def judge(spark: SparkSession, a: argparse.Namespace) -> int:
    """Blind judgments of candidates, one by one or two at a time; judged tasks, failures and incomplete tasks."""
    tasks.check_judging(a.batch_size, a.max_model_len, a.max_tokens, group_size=a.group_size)
    sinks.distinct_paths(a.pair_output, a.output, a.failures, a.incomplete)
    source = read_strict(spark, a.input, f"{schemas.TASKS}, candidates array<{schemas.CANDIDATE}>")
    contracts.require_empty(contracts.duplicate_keys(source, "id"), "ids repeat")
    contracts.require_empty(contracts.repeated_candidates(source), "candidate ids repeat")
    flat = judging.explode_candidates(source)
    open_, cut = judging.split_excluded(flat)
    rubrics = category_prompts(spark, a.prompt_dir, {c: f"{c}.txt" for c in a.categories}) if a.prompt_dir else None
    pairs = judging.build_pairs(open_, rubrics, a.seed)
    cache = _there(spark, a.pair_output, PAIR)
    contracts.require_empty(judging.stale_cache(cache, pairs, a.model).select("id", "candidate_id", "stale"), "cached judgments are stale")
    units = judging.pending_units(pairs, cache, a.group_size)
    # what a prompt's tokens are is the model's matter; four characters a token is the usual bound here
    units = judging.length_fallback(units.withColumn("_tokens", F.ceil(F.length("instruction") / 4)), "_tokens", a.max_tokens, a.max_model_len).drop("_tokens")
    print(json.dumps({r["name"]: r["n"] for r in judging.progress(source, pairs, cut, cache, units).collect()}))
    if a.dry_run:
        return 0
    make, keep = scorer(a.scorer), ["id", "category", "candidate_id", "candidate_label", "chosen_label", "prompt_fingerprint", "error"]
    one = scorers.score(units.where("mode = 'pairwise'").select("id", "category", "candidate_id", "candidate_label", "chosen_label", "prompt_fingerprint", "instruction"), make, "output string", "judge", a.batch_size).withColumnRenamed("error", "failed")
    one = judging.parse_pair_output(one).withColumn("error", F.coalesce("failed", "error"))
    one = one.withColumns({"verdict": judging.pair_verdict(F.col("winner"), F.col("chosen_label")), "chosen_score": judging.side_score(F.col("chosen_label"), F.col("score_a"), F.col("score_b")), "candidate_score": judging.side_score(F.col("candidate_label"), F.col("score_a"), F.col("score_b"))})
    found = one.select(*keep, "verdict", "chosen_score", "candidate_score", "confidence", "reason", F.lit("pairwise").alias("judge_mode"))
    if a.group_size == 2:
        found = found.unionByName(_grouped(units.where("mode = 'groupwise'"), make, a).select(found.columns))
    found = stored(found.withColumn("judge_model", F.lit(a.model)), "judgments")
    names = [x.split()[0] for x in PAIR.split(", ")]
    sinks.append_jsonl(found.where("error is null").select(*names), a.pair_output)
    sinks.write_jsonl(judging.failure_rows(found.where("error is not null"), "judge", F.col("error")), a.failures, True)
    done, incomplete = judging.aggregate_tasks(flat, _there(spark, a.pair_output, PAIR), cut)
    sinks.write_jsonl(done, a.output, a.overwrite)
    sinks.write_jsonl(incomplete, a.incomplete, a.overwrite)
    return 0


def _grouped(units: DataFrame, make, a: argparse.Namespace) -> DataFrame:
    """Judgments of two candidates and the chosen answer at once: a row a candidate."""
    shown = judging.group_labels(units, a.seed)
    labels = shown.groupBy("id", "group").agg(F.map_from_entries(F.collect_list(F.struct("source", "label"))).alias("labels"), F.to_json(F.map_from_entries(F.collect_list(F.struct("label", "text")))).alias("answers"))
    asked = units.groupBy("id", "group").agg(F.first("category").alias("category"), F.first("rubric").alias("rubric"), F.first("prompt").alias("prompt")).join(labels, ["id", "group"])
    asked = asked.select("id", "group", "category", "labels", F.concat(F.coalesce("rubric", F.lit("")), F.lit("\n\n"), F.to_json("prompt"), F.lit("\n\n"), "answers").alias("instruction"))
    got = scorers.score(asked, make, "output string", "judge", a.batch_size, keep=["id", "group", "labels"]).withColumnRenamed("error", "failed")
    got = judging.parse_group_output(got).withColumn("error", F.coalesce("failed", "error")).drop("failed", "output", "stage")
    rows = units.select("id", "group", "category", "candidate_id", "candidate_label", "chosen_label", "prompt_fingerprint").join(got, ["id", "group"])

    def of(field: str, label: Column) -> Column:
        return F.when(label == "A", F.col(f"{field}_a")).when(label == "B", F.col(f"{field}_b")).otherwise(F.col(f"{field}_c"))

    own, original = F.col("labels")[F.col("candidate_id")], F.col("labels")["original"]
    rows = rows.withColumns({"candidate_score": of("score", own), "chosen_score": of("score", original), "reason": of("reason", own), "judge_mode": F.lit("groupwise")})
    return rows.withColumn("verdict", judging.group_verdict(F.col("chosen_score"), F.col("candidate_score")))


def eval_generate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Both turns' answers of every question under every strategy, a folder a strategy; exit 1 if a turn failed."""
    questions = read_strict(spark, a.input, schemas.QUESTIONS)
    kinds = spark.createDataFrame([tuple(x.split("=", 1)) for x in a.strategy or ["default="]], "strategy string, prefix string")
    made = stored(scorers.two_turns(questions, kinds, scorer(a.scorer), a.batch_size), "answers").join(questions.select("id", "references"), "id")
    sinks.write_jsonl(made.where("error is null").drop("stage", "error"), a.output_dir, a.overwrite, ["strategy"])
    return int(made.where("error is not null").limit(1).count())


def eval_judge(spark: SparkSession, a: argparse.Namespace) -> int:
    """Judgments of both turns; a failed one is a status."""
    rows = read_strict(spark, a.input, "id long, category string, questions array<string>, references array<string>, outputs array<string>")
    q, r, o = F.col("questions"), F.col("references"), F.col("outputs")
    asked = rows.select("*", F.explode(F.array(F.struct(F.lit("single").alias("turn"), evaluation.judge_prompt(q[0], r[0], o[0]).alias("prompt")), F.struct(F.lit("multi").alias("turn"), evaluation.judge_prompt(q[0], r[0], o[0], q[1], r[1], o[1]).alias("prompt")))).alias("t"))
    asked = asked.select("id", "t.turn", "t.prompt")
    got = evaluation.parse_judgment(scorers.score(asked, scorer(a.scorer), "content string", "judge", a.batch_size, a.attempts, ["id", "turn"], a.retry_delay))
    judged = got.groupBy("id").pivot("turn", ["single", "multi"]).agg(F.first(F.struct("judge_message", "judge_score", F.coalesce("error", "status").alias("status"))))
    sinks.write_jsonl(rows.join(judged.withColumnsRenamed({"single": "query_single", "multi": "query_multi"}), "id"), a.output_dir, a.overwrite)
    return 0


def re_eval(spark: SparkSession, a: argparse.Namespace) -> int:
    """Zero-scored turns that a language rule speaks about, judged again; exit code 2 if some are left for review."""
    rows = read_strict(spark, [f for f, _ in expand_inputs(a.input, spark=spark)], schemas.EVALUATED)
    rules = read_strict(spark, a.rules, "rule_id string, question_id long, turn string, question string, judge_override string")
    found = evaluation.rule_candidates(rows, rules)
    if a.dry_run:
        print(json.dumps({"candidates": found.count()}))
        return 0
    q, r, o, rule = F.col("questions"), F.col("references"), F.col("outputs"), F.col("judge_override")
    asked = found.join(rows.select("id", "questions", "references", "outputs"), "id")
    asked = asked.withColumn("prompt", F.when(F.col("turn") == "single", evaluation.judge_prompt(q[0], r[0], o[0], rule=rule)).otherwise(evaluation.judge_prompt(q[0], r[0], o[0], q[1], r[1], o[1], rule)))
    got = evaluation.parse_rejudgment(scorers.score(asked.select("id", "turn", "rule_id", "prompt"), scorer(a.scorer), "content string", "re-eval", a.batch_size, a.max_attempts, ["id", "turn", "rule_id"], a.retry_delay))
    got = stored(got.withColumn("status", F.when(F.col("error").isNotNull(), "failed").otherwise(F.col("status"))), "rejudged")
    sinks.write_jsonl(evaluation.apply_rejudgments(rows, got), a.output_dir, a.overwrite)
    return 2 if got.where("status <> 'ok'").limit(1).count() else 0


def read_tasks(spark: SparkSession, path: str, categories: list[str]) -> DataFrame:
    return tasks.checked(tasks.normalized(read_strict(spark, path, f"{schemas.TASKS}, questions array<string>, references array<string>")), categories)


def prepare(spark: SparkSession, a: argparse.Namespace) -> int:
    made = read_tasks(spark, a.source, a.categories)
    if a.pilot_per_category:
        subsets.require_quota(made, a.pilot_per_category, a.categories)
        made = tasks.pilot(made, a.pilot_per_category, a.selection_seed)
    sinks.write_jsonl(made, a.output, a.overwrite)
    return 0


def merge(spark: SparkSession, a: argparse.Namespace) -> int:
    sinks.distinct_paths(a.output, a.incomplete)
    todo = read_tasks(spark, a.tasks, a.categories)
    workers = [(w, read_strict(spark, p, schemas.WORKER_OUTPUT)) for w, p in (x.split("=", 1) for x in a.worker_output)]
    for w, rows in workers:
        contracts.require_empty(contracts.duplicate_keys(rows, "id"), f"ids of {w} repeat")
        contracts.require_empty(contracts.unknown_keys(rows.select("id"), todo, "id"), f"{w} answers unknown tasks")
    cands = candidates.union_workers(workers)
    names = [w for w, _ in workers]
    counts = candidates.merge_counts(todo.select("id", "category"), cands, a.required_candidates, names)
    first = candidates.first_distinct(cands, a.required_candidates)
    made = first.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "worker_id", "candidate_index", "text", "finish_reason"))), lambda x: x.dropFields("rank")).alias("candidates"))
    sinks.write_jsonl(todo.join(counts.where("complete").select("id"), "id").join(made, "id"), a.output, a.overwrite)
    sinks.write_jsonl(counts.where("NOT complete").drop("complete"), a.incomplete, a.overwrite)
    return 0


def finalize(spark: SparkSession, a: argparse.Namespace) -> int:
    sinks.distinct_paths(a.output, a.report)
    source = read_strict(spark, a.source, f"{schemas.TASKS}, candidates array<{schemas.CANDIDATE}>").withColumn("candidates", reviews.candidate_map())
    given = read_strict(spark, a.review, schemas.REVIEWS)
    joined = reviews.with_sources(given, source)
    contracts.require_empty(contracts.duplicate_keys(given, "id"), "reviews repeat")
    contracts.require_empty(contracts.violations(joined, reviews.review_rules()), "reviews break their rules")
    contracts.require_empty(reviews.uncovered(source, given), "sources without a review")
    pairs, failed = reviews.finalize(joined)
    contracts.require_empty(failed, "reviews don't resolve")
    sinks.write_jsonl(pairs, a.output, a.overwrite)
    sinks.write_report({"counts": [r.asDict() for r in reviews.review_report(source, given, pairs).collect()]}, a.report)
    return 0


def arms(spark: SparkSession, a: argparse.Namespace) -> int:
    """Control, matched and length-priority arms; token counts are words."""
    rows = contracts.good(read_strict(spark, a.input, schemas.PAIRS), contracts.preference_rules(a.categories))
    words = lambda c: F.size(F.split(F.trim(c), r"\s+"))
    rows = subsets.length_features(rows.withColumns({"chosen_tokens": words("chosen"), "rejected_tokens": words("rejected"), "decision": F.col("review.decision"), "confidence": F.col("review.confidence")}))
    subsets.require_quota(rows, a.per_category, a.categories)
    high = rows.where("confidence = 'high'")
    control = subsets.sample_balanced(rows, a.per_category, a.seed, "control")
    made = {"control": control, "high_matched": subsets.high_matched(control, high, a.per_category, a.seed, a.categories), "length_priority": subsets.length_priority(high, a.per_category, a.seed)}
    for name, df in made.items():
        sinks.write_jsonl(df.select("id", "category", "prompt", "chosen", "rejected", "review").orderBy("id"), f"{a.output_dir}/{name}", a.overwrite)
    table = None
    for name, df in made.items():
        one = subsets.subset_summary(df.withColumn("arm", F.lit(name)), ["arm"])
        table = one if table is None else table.union(one)
    sinks.write_report({"arms": [r.asDict() for r in table.collect()]}, f"{a.output_dir}/report.json")
    return 0


def margin_report(spark: SparkSession, a: argparse.Namespace) -> int:
    fields = "id string, category string, split string, review_decision string, chosen_source string, chosen_sum_log_prob double, rejected_sum_log_prob double, chosen_mean_log_prob double, rejected_mean_log_prob double, chosen_tokens int, rejected_tokens int"
    rows = margins.margins(read_strict(spark, a.input, fields), a.near_zero_threshold)
    found = margins.summary(rows, ["category", "review_decision", "chosen_source", "split"], a.near_zero_threshold)
    sinks.write_report({"groups": [r.asDict() for r in found.orderBy("grouping", "group").collect()]}, f"{a.output_dir}/summary.json")
    sinks.write_jsonl(margins.review_priority(rows), f"{a.output_dir}/rows", a.overwrite)
    return 0


def split(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.by_question:
        rows = read_strict(spark, a.input, schemas.SFT).withColumn("question_id", F.col("meta.question_id"))
        made = splits.grouped(rows, a.train_ratio, a.seed, "question_id").drop("question_id")
    else:
        made = splits.stratified(read_strict(spark, a.input, schemas.PAIRS), a.train_ratio, a.seed)
    sinks.write_jsonl(made, a.output_dir, a.overwrite, ["split"])
    return 0


def gate(spark: SparkSession, a: argparse.Namespace) -> int:
    ref, own = (read_strict(spark, p, schemas.QUESTIONS) for p in (a.reference, a.candidate))
    found = quality.gate(ref, own, a.expected_per_category, a.strict)
    verdict = quality.status(found).first()
    print(verdict.status)
    print(sinks.markdown_table(found.orderBy("severity", "rule", "item")))
    return int(verdict.status == "FAIL")


def score(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = evaluation.scores(read_strict(spark, a.input, schemas.EVALUATED))
    if rows.where("single is null or multi is null").limit(1).count():
        raise InputError("a row has no scores")
    print("\n".join(sinks.score_lines(evaluation.score_table(rows).orderBy("category"))))
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="prefmill", description=__doc__)
    p.add_argument("--categories", type=lambda s: s.split(","), default=schemas.CATEGORIES)
    p.add_argument("--overwrite", action="store_true")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, **options) -> None:
        c = sub.add_parser(name)
        c.set_defaults(run=run)
        for k, o in options.items():
            c.add_argument(f"--{k.replace('_', '-')}", **o)

    need, many = {"required": True}, {"required": True, "action": "append"}
    number = lambda n: {"type": int, "default": n}
    command("prepare", prepare, source=need, output=need, pilot_per_category={"type": int}, selection_seed=number(42))
    command("merge", merge, tasks=need, worker_output={**many, "metavar": "WORKER=PATH"}, required_candidates=number(4), output=need, incomplete=need)
    command("finalize", finalize, source=need, review=many, output=need, report=need)
    command("subsets", arms, input=need, output_dir=need, per_category=number(25), seed=number(42))
    command("margins", margin_report, input=need, output_dir=need, near_zero_threshold={"type": float, "default": 0.05})
    command("split", split, input=need, output_dir=need, train_ratio={"type": float, "default": 0.9}, seed=number(42), by_question={"action": "store_true"})
    command("gate", gate, reference=need, candidate=need, expected_per_category={"type": int}, strict={"action": "store_true"})
    command("score", score, input={"required": True, "nargs": "+"})
    flag, real = {"action": "store_true"}, lambda x: {"type": float, "default": x}
    sizes = {"batch_size": number(8), "max_model_len": number(4096), "max_tokens": number(1024)}
    command("generate", generate, tasks=need, output=need, failures=need, scorer=need, retry_ids={}, worker_id=need, candidate_count=number(4), seed=number(42), temperature=real(1.0), top_p=real(1.0), dry_run=flag, **sizes)
    command("judge", judge, input=need, pair_output=need, output=need, failures=need, incomplete=need, scorer=need, model={"default": "judge"}, prompt_dir={}, group_size=number(1), seed=number(42), dry_run=flag, **sizes)
    command("eval-generate", eval_generate, input=need, output_dir=need, scorer=need, strategy={"action": "append", "metavar": "NAME=PREFIX"}, batch_size=number(8))
    command("eval-judge", eval_judge, input=need, output_dir=need, scorer=need, batch_size=number(8), attempts=number(3), retry_delay=real(2.0))
    command("re-eval", re_eval, input={"required": True, "nargs": "+"}, rules=need, output_dir=need, scorer=need, batch_size=number(8), max_attempts=number(3), retry_delay=real(2.0), dry_run=flag)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    if spark is None:
        from prefmill.session import build

        spark = build()
    try:
        return a.run(spark, a)
    except InputError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
