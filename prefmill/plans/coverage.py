"""Queries for the operators that no query of ``registry`` goes through: records, rendering, sources, sinks, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.operators import candidates, contracts, evaluation, judging, margins, scorers, shaping, splits, subsets, tasks
from prefmill.plans.registry import _rank_sql, query
from prefmill.plans.views import CAND, JUDG, PAIRS, cand, judg, pairs
from prefmill.scratch import fresh_dir
from prefmill.session import table
from prefmill.sources import jsonl, sinks
from prefmill.streaming import resume

LANGS = ["en", "de"]
DIALOGUE = "array(named_struct('role', 'user', 'content', source), named_struct('role', if(doc_id % 11 = 0, 'user', 'assistant'), 'content', if(doc_id % 13 = 0, '  ', lang)), named_struct('role', 'user', 'content', source))"
_RULES = "list_filter([{}], lambda x: x IS NOT NULL)"


def _docs(spark: SparkSession, sf: str, *expressions: str) -> DataFrame:
    return table(spark, sf, "documents").selectExpr("doc_id", *expressions)


# records


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS id, unnest({_RULES.format("CASE WHEN lang NOT IN ('en', 'de') THEN 'category' END, CASE WHEN doc_id % 5 = 0 THEN 'questions' END, CASE WHEN doc_id % 7 = 0 THEN 'references' END")}) AS rule FROM documents"""
)
def raw_task_violations(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf, "doc_id AS id", "lang AS category", "array(source, if(doc_id % 5 = 0, ' ', lang)) AS questions", "if(doc_id % 7 = 0, array(source), array(source, lang)) AS references")
    return contracts.violations(d, contracts.raw_task_rules(LANGS))


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS id, unnest({_RULES.format("CASE WHEN lang NOT IN ('en', 'de') THEN 'category' END, CASE WHEN doc_id % 11 = 0 OR doc_id % 13 = 0 THEN 'prompt' END, CASE WHEN doc_id % 4 = 1 THEN 'rejected' END, CASE WHEN doc_id % 4 = 0 THEN 'identical' END")}) AS rule FROM documents"""
)
def preference_violations(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf, "doc_id AS id", "lang AS category", f"{DIALOGUE} AS prompt", "source AS chosen", "CASE doc_id % 4 WHEN 0 THEN concat(' ', source, '\t') WHEN 1 THEN ' ' ELSE lang END AS rejected")
    return contracts.violations(d, contracts.preference_rules(LANGS))


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS id, unnest({_RULES.format("CASE WHEN doc_id % 5 = 0 THEN 'messages' END, CASE WHEN doc_id % 6 = 0 THEN 'question_id' END, CASE WHEN doc_id % 4 IN (0, 3) THEN 'turn' END, CASE WHEN doc_id % 7 = 0 OR doc_id % 5 = 0 THEN 'last_role' END")}) AS rule FROM documents"""
)
def sft_violations(spark: SparkSession, sf: str) -> DataFrame:
    one, last = "named_struct('role', 'user', 'content', source)", "named_struct('role', if(doc_id % 7 = 0, 'user', 'assistant'), 'content', lang)"
    d = _docs(spark, sf, "doc_id AS id", f"if(doc_id % 5 = 0, array({one}), array({one}, {last})) AS messages", "named_struct('question_id', if(doc_id % 6 = 0, NULL, doc_id), 'turn', int(doc_id % 4)) AS meta")
    return contracts.violations(d, contracts.sft_rules())


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS id, unnest({_RULES.format("CASE WHEN doc_id % 5 = 0 THEN 'count' END, CASE WHEN doc_id % 6 = 0 AND doc_id % 5 <> 0 THEN 'candidate_index' END, CASE WHEN doc_id % 3 = 0 AND doc_id % 5 <> 0 THEN 'duplicate_text' END, CASE WHEN doc_id % 7 = 0 THEN 'worker' END")}) AS rule FROM documents"""
)
def worker_violations(spark: SparkSession, sf: str) -> DataFrame:
    first = "named_struct('candidate_index', 0, 'worker_id', if(doc_id % 7 = 0, 'other', 'w'), 'text', lang)"
    second = "named_struct('candidate_index', if(doc_id % 6 = 0, -1, 1), 'worker_id', 'w', 'text', if(doc_id % 3 = 0, lang, source))"
    d = _docs(spark, sf, "doc_id AS id", f"if(doc_id % 5 = 0, array({first}), array({first}, {second})) AS candidates")
    return contracts.violations(d, contracts.worker_row_rules(2, "w"))


@query("SELECT doc_id AS id, 'w:' || (doc_id % 3) AS candidate_id, 2 AS n FROM documents WHERE doc_id % 4 = 0")
def repeated_candidates(spark: SparkSession, sf: str) -> DataFrame:
    one = "named_struct('candidate_index', int({}), 'worker_id', 'w')"
    d = _docs(spark, sf, "doc_id AS id", f"array({one.format('doc_id % 3')}, {one.format('if(doc_id % 4 = 0, doc_id % 3, 9)')}) AS candidates")
    return contracts.repeated_candidates(d)


@query("SELECT md5(text) AS text_key, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def repeated_texts(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.duplicate_keys(table(spark, sf, "documents").select(F.md5("text").alias("text_key")), "text_key")


@query("SELECT conv_id AS key, count(*) AS n FROM conversations GROUP BY conv_id HAVING count(*) <> 4")
def wrong_group_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.wrong_group_size(table(spark, sf, "conversations"), F.col("conv_id"), 4)


@query(f"WITH {CAND} SELECT id, doc_id, 'finish_reason=length' AS reason FROM cand WHERE doc_id % 9 = 0")
def excluded_candidates(spark: SparkSession, sf: str) -> DataFrame:
    c = cand(spark, sf).withColumn("finish_reason", F.when(F.col("doc_id") % 9 == 0, "length").when(F.col("doc_id") % 2 == 0, "stop"))
    return judging.split_excluded(c)[1].select("id", "doc_id", "reason")


@query(
    """SELECT doc_id AS id, CASE WHEN doc_id % 5 = 0 THEN 'wrong number of completions' WHEN doc_id % 7 = 0 THEN 'blank text' WHEN doc_id % 3 = 0 THEN 'duplicate texts' END AS error,
CASE WHEN doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND doc_id % 3 <> 0 THEN '0:w:' || lang || ':stop:2,1:w:' || source || ':length:' END AS candidates FROM documents"""
)
def worker_completions(spark: SparkSession, sf: str) -> DataFrame:
    """A model's completions as candidates; some are too few, blank or alike."""
    first = "named_struct('text', concat(' ', lang), 'finish_reason', 'stop', 'stop_reason', string(NULL), 'token_ids', array(1, 2))"
    second = "named_struct('text', CASE WHEN doc_id % 7 = 0 THEN ' ' WHEN doc_id % 3 = 0 THEN concat(lang, ' ') ELSE source END, 'finish_reason', 'length', 'stop_reason', string(NULL), 'token_ids', CAST(NULL AS array<int>))"
    d = _docs(spark, sf, "doc_id AS id", f"if(doc_id % 5 = 0, array({first}), array({first}, {second})) AS outputs")
    shown = F.transform("candidates", lambda c: F.concat(c["candidate_index"], F.lit(":"), c["worker_id"], F.lit(":"), c["text"], F.lit(":"), c["finish_reason"], F.lit(":"), F.coalesce(c["output_tokens"].cast("string"), F.lit(""))))
    return candidates.from_completions(d, "w", 42, 2).select("id", "error", F.array_join(shown, ",").alias("candidates"))


# judging


@query(
    """WITH s AS (SELECT doc_id, lang, source, CAST('0x' || substr(sha256('["int","' || doc_id || '","w:' || (doc_id % 4) || '",42]'), 1, 2) AS INTEGER) % 2 = 0 AS a FROM documents)
SELECT doc_id AS id, CASE WHEN a THEN 'B' ELSE 'A' END AS chosen_label,
sha256(chr(10) || chr(10) || '{"dialogue":"p","answer_a":"' || CASE WHEN a THEN source ELSE lang END || '","answer_b":"' || CASE WHEN a THEN lang ELSE source END || '"}') AS prompt_fingerprint FROM s"""
)
def blind_pairs(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf, "doc_id AS id", "lang AS category", "'p' AS prompt", "concat('w:', doc_id % 4) AS candidate_id", "source AS text", "lang AS chosen")
    return judging.build_pairs(d, None, 42).select("id", "chosen_label", "prompt_fingerprint")


@query(
    f"""WITH a AS (SELECT doc_id // 2 AS id, doc_id % 10 AS grp, 'w:' || doc_id AS source FROM documents UNION ALL SELECT DISTINCT doc_id // 2, doc_id % 10, 'original' FROM documents)
SELECT id, CAST(grp AS INTEGER) AS grp, source, substr('ABC', CAST(row_number() OVER (PARTITION BY id, grp ORDER BY {_rank_sql("'42'", "CAST(id AS VARCHAR)", "CAST(grp AS VARCHAR)", "source")}, source) AS INTEGER), 1) AS label FROM a"""
)
def group_labels(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf, "doc_id div 2 AS id", "int(doc_id % 10) AS group", "concat('w:', doc_id) AS candidate_id", "lang AS text", "'x' AS chosen")
    return judging.group_labels(d, 42).select("id", F.col("group").alias("grp"), "source", "label")


@query(
    """SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'invalid JSON' WHEN doc_id % 11 = 0 THEN 'wrong fields' WHEN n_chars % 120 > 100 THEN 'score' WHEN doc_id % 7 = 0 THEN 'reason' WHEN doc_id % 5 = 0 THEN 'confidence' END AS error FROM documents"""
)
def group_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Judges' answers on three texts at once, with every kind of fault."""
    made = """concat('{"score_a":', n_chars % 120, ',"score_b":1,"score_c":2,"reason_a":"', if(doc_id % 7 = 0, ' ', 'r'), '","reason_b":"r","reason_c":"r","confidence":"', if(doc_id % 5 = 0, 'sure', 'low'), '"',
      if(doc_id % 11 = 0, ',"x":1', ''), if(doc_id % 13 = 0, '', '}')) AS output"""
    return judging.parse_group_output(_docs(spark, sf, made)).select("doc_id", "error")


@query("SELECT doc_id AS id, lang AS category, 'w:' || (doc_id % 4) AS candidate_id, 'judge' AS stage, repeat('x', CAST(least(n_chars, 1200) AS INTEGER)) AS reason FROM documents WHERE doc_id % 10 = 0")
def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf, "doc_id AS id", "lang AS category", "concat('w:', doc_id % 4) AS candidate_id", "n_chars").where("doc_id % 10 = 0")
    return judging.failure_rows(d, "judge", F.repeat(F.lit("x"), F.col("n_chars").cast("int")))


@query(
    f"""WITH {JUDG}, g AS (SELECT *, pos // 2 AS grp, doc_id % 5 = 0 AS done FROM judg),
u AS (SELECT *, count(*) OVER (PARTITION BY id, grp) = 2 AND count(*) FILTER (NOT done) OVER (PARTITION BY id, grp) = 2 AS fresh, n_chars + 400 > 4000 AS long FROM g), p AS (SELECT * FROM u WHERE NOT done)
SELECT 'tasks' AS name, count(DISTINCT id) AS n FROM judg UNION ALL SELECT 'pairs', count(*) FROM judg UNION ALL SELECT 'excluded_candidates', count(*) FROM judg WHERE doc_id % 17 = 0
UNION ALL SELECT 'completed_pairs', count(*) FROM judg WHERE doc_id % 5 = 0 UNION ALL SELECT 'pending_pairs', count(*) FROM p
UNION ALL SELECT 'groupwise_units', count(DISTINCT (id, grp)) FROM p WHERE fresh AND NOT long UNION ALL SELECT 'pairwise_units', count(*) FROM p WHERE NOT fresh OR long
UNION ALL SELECT 'length_fallback_groups', count(DISTINCT (id, grp)) FROM p WHERE fresh AND long"""
)
def judging_progress(spark: SparkSession, sf: str) -> DataFrame:
    j = judg(spark, sf)
    done = j.where("doc_id % 5 = 0").select("id", "candidate_id")
    units = judging.length_fallback(judging.pending_units(j, done, 2), "n_chars", 400, 4000)
    return judging.progress(j.select("id").distinct(), j, j.where("doc_id % 17 = 0"), done, units)


@query(
    """SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'ValueError: no score' END AS error, CASE WHEN doc_id % 10 <> 0 THEN CAST(n_chars % 11 AS DOUBLE) END AS score FROM documents"""
)
def scored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A scorer that raises on a tenth of the rows: the rest is scored, these are dead letters."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return scorers.score(d, _fake_scorer, "score long", "judge", keep=["doc_id"]).select("doc_id", "error", F.col("score").cast("double").alias("score"))


def _fake_scorer():
    def run(rows: list[dict]) -> list[dict]:
        if any(r["doc_id"] % 10 == 0 for r in rows):
            raise ValueError("no score")
        return [{"score": r["n_chars"] % 11} for r in rows]

    return run


# evaluation, margins, subsets, splits


@query("SELECT lang AS category, CASE WHEN doc_id % 2 = 0 THEN n_chars % 11 ELSE n_chars % 7 END::DOUBLE AS single, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 2 END::DOUBLE AS multi FROM documents")
def extracted_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores from the nested layout where it is there, else from the flat one."""
    new = "if(doc_id % 2 = 0, named_struct('judge_score', double({})), NULL) AS query_{}"
    d = _docs(spark, sf, "lang AS category", new.format("n_chars % 11", "single"), new.format("1", "multi"), "double(n_chars % 7) AS judge_single_score", "double(2) AS judge_multi_score")
    return evaluation.scores(d)


@query(
    f"""WITH {PAIRS}, s AS (SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 'eval' ELSE 'train' END AS split FROM labels)
SELECT p.id, p.category, s.split, CASE WHEN p.id % 5 = 0 THEN 'unknown' ELSE p.decision END AS review_decision, CASE WHEN p.id % 5 = 0 THEN 'unknown' ELSE p.source END AS chosen_source, round(p.mean_margin, 6) AS mean_margin FROM pairs p JOIN s ON p.id = s.id"""
)
def margin_context(spark: SparkSession, sf: str) -> DataFrame:
    """Margins with their split and review; some pairs have no review."""
    p = pairs(spark, sf)
    review = F.when(F.col("id") % 5 != 0, F.struct("decision", F.col("source").alias("chosen_source"), F.lit(None).cast("string").alias("rejected_source")))
    sides = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 3 == 0, "eval").otherwise("train").alias("split"))
    out = margins.with_context(p.select("id", F.round("mean_margin", 6).alias("mean_margin")), p.select("id", "category", review.alias("review")), sides)
    return out.select("id", "category", "split", "review_decision", "chosen_source", "mean_margin")


@query(f"""WITH {PAIRS} SELECT id, category FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY {_rank_sql("'42'", "'pilot'", "category", "id")}, id) AS rk FROM pairs) WHERE rk <= 5""")
def pilot_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Five tasks a category (a sampling operator)."""
    return tasks.pilot(pairs(spark, sf), 5).select("id", "category")


@query(
    """WITH g AS (SELECT conv_id, row_number() OVER (ORDER BY sha256('42:group:' || conv_id)) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT CASE WHEN r <= least(greatest(1, CAST(floor(n * 0.9) AS BIGINT)), n - 1) THEN 'train' ELSE 'eval' END AS split, role, count(*) AS n FROM conversations JOIN g USING (conv_id) GROUP BY 1, 2"""
)
def split_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return splits.split_counts(splits.grouped(table(spark, sf, "conversations"), 0.9, 42, "conv_id"), ["role"])


@query("SELECT conv_id, count(DISTINCT turn % 2) AS sides FROM conversations GROUP BY conv_id HAVING count(DISTINCT turn % 2) > 1")
def split_leakage(spark: SparkSession, sf: str) -> DataFrame:
    """A split by turns, which tears conversations apart."""
    c = table(spark, sf, "conversations").select("conv_id", F.when(F.col("turn") % 2 == 0, "train").otherwise("eval").alias("split"))
    return splits.leakage(c, "conv_id")


@query(
    f"""WITH {CAND}, once AS (SELECT *, row_number() OVER (PARTITION BY id, key ORDER BY worker_ord, pos) AS n FROM cand),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY worker_ord, pos) AS rank FROM once WHERE n = 1)
SELECT id, array_to_string(list(doc_id ORDER BY rank), ',') AS doc_ids FROM ranked WHERE rank <= 4 GROUP BY id"""
)
def assembled_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Each task's candidates as an array in their order."""
    first = candidates.first_distinct(cand(spark, sf), 4)
    own = F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda x: x["doc_id"].cast("string"))
    return first.groupBy("id").agg(F.array_join(own, ",").alias("doc_ids"))


@query(f"WITH {CAND} SELECT id, doc_id, CAST(id * 7 % 1000 AS BIGINT) AS task_ord FROM cand")
def restored_order(spark: SparkSession, sf: str) -> DataFrame:
    c = cand(spark, sf)
    return candidates.in_source_order(c.select("id", "doc_id"), c.select("id", (F.col("id") * 7 % 1000).alias("task_ord")).distinct())


@query(f"WITH {PAIRS} SELECT category, count(*) AS n, count(*) FILTER (rejected_longer) AS longer, round(max(length_ratio), 6) AS most FROM pairs GROUP BY category")
def length_features(spark: SparkSession, sf: str) -> DataFrame:
    p = subsets.length_features(pairs(spark, sf).drop("length_ratio", "rejected_longer"))
    return p.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count_if("rejected_longer").alias("longer"), F.round(F.max("length_ratio"), 6).alias("most"))


# rendering


@query("SELECT doc_id, source AS prompt, 'assistant' AS role, lang AS chosen, source || lang AS rejected FROM documents")
def conversational_pairs(spark: SparkSession, sf: str) -> DataFrame:
    out = shaping.conversational(_docs(spark, sf, "struct(doc_id, source) AS prompt", "lang AS chosen", "concat(source, lang) AS rejected"))
    return out.select("prompt.doc_id", F.col("prompt.source").alias("prompt"), F.col("chosen")[0]["role"].alias("role"), F.col("chosen")[0]["content"].alias("chosen"), F.col("rejected")[0]["content"].alias("rejected"))


@query("SELECT doc_id, least(len(string_split(text, ' ')), 50) AS n, list_sum(list_transform(list_slice(string_split(text, ' '), 1, 50), lambda x: length(x)))::BIGINT AS id_sum, least(len(string_split(text, ' ')), 50) AS mask_sum FROM documents")
def model_inputs(spark: SparkSession, sf: str) -> DataFrame:
    d = shaping.model_inputs(_docs(spark, sf, "transform(split(text, ' '), x -> length(x)) AS ids"), "ids", 50)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return d.select("doc_id", F.size("input_ids").cast("long").alias("n"), total("input_ids").alias("id_sum"), total("attention_mask").alias("mask_sum"))


@query(
    """WITH w AS (SELECT doc_id, list_transform(string_split(text, ' '), lambda x: length(x)) AS ids FROM documents),
f AS (SELECT doc_id, list_slice(ids, 1, 3) AS p, CASE doc_id % 4 WHEN 0 THEN list_concat(list_slice(ids, 1, 2), [99], list_slice(ids, 4, len(ids))) WHEN 1 THEN list_concat([77777], list_slice(ids, 2, len(ids))) ELSE ids END AS f FROM w),
k AS (SELECT *, CASE WHEN list_slice(f, 1, len(p)) = p THEN len(p) WHEN list_slice(f, 1, len(p) - 1) = list_slice(p, 1, len(p) - 1) THEN len(p) - 1 END AS kept FROM f),
c AS (SELECT *, len(f) - kept AS rest, CASE WHEN len(f) > kept AND f[len(f)] = 7 THEN 0 ELSE 1 END AS extra FROM k)
SELECT doc_id, CASE WHEN kept IS NULL THEN 'prompt is no prefix' WHEN least(kept, 2) + least(rest + extra, 40) > 41 THEN 'over max_length' WHEN kept < 1 THEN 'empty part' END AS error,
CASE WHEN kept IS NOT NULL THEN CAST(least(kept, 2) AS DOUBLE) END AS prompt_tokens, CASE WHEN kept IS NOT NULL THEN CAST(least(rest + extra, 40) AS DOUBLE) END AS completion_tokens, CASE WHEN kept IS NOT NULL THEN CAST(rest + extra > 40 AS VARCHAR) END AS completion_truncated FROM c"""
)
def rendered_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Completions behind their prompts, with merged and broken boundaries."""
    full = "CASE doc_id % 4 WHEN 0 THEN concat(slice(ids, 1, 2), array(99), slice(ids, 4, greatest(size(ids) - 3, 0))) WHEN 1 THEN concat(array(77777), slice(ids, 2, greatest(size(ids) - 1, 0))) ELSE ids END AS f"
    d = _docs(spark, sf, "transform(split(text, ' '), x -> length(x)) AS ids").selectExpr("doc_id", "slice(ids, 1, 3) AS p", full)
    out = shaping.rendered_ids(d, "p", "f", 7, 2, 40, 41)
    known = F.col("error").isNull() | (F.col("error") != "prompt is no prefix")
    return out.select("doc_id", "error", *[F.when(known, F.col(c).cast("double")).alias(c) for c in ("prompt_tokens", "completion_tokens")], F.when(known, F.col("completion_truncated").cast("string")).alias("completion_truncated"))


@query(
    """WITH t AS (SELECT lang, n_chars % 300 AS p, len(string_split(text, ' ')) AS c, n_chars % 700 AS r FROM documents)
SELECT lang, count(*) FILTER (p > 200) AS prompt_cut, count(*) FILTER (c > 400) AS chosen_cut, count(*) FILTER (r > 400) AS rejected_cut, count(*) FILTER (least(p, 200) + greatest(least(c, 400), least(r, 400)) > 500) AS combined_over FROM t GROUP BY lang"""
)
def truncation_counts(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf, "lang", "n_chars % 300 AS prompt_tokens", "size(split(text, ' ')) AS chosen_tokens", "n_chars % 700 AS rejected_tokens")
    return shaping.truncation_counts(d, 200, 400, 500, ["lang"])


# sources, sinks and streams: written, then read


@query("SELECT doc_id, md5(text) AS text_key, lang, source, n_chars FROM documents")
def jsonl_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as JSON lines, partitioned by language, and back."""
    path = fresh_dir(spark, "jsonl")
    sinks.write_jsonl(table(spark, sf, "documents"), path, partition_by=["lang"])
    rows = jsonl.read_strict(spark, path, "doc_id long, text string, lang string, source string, n_chars long")
    return rows.select("doc_id", F.md5("text").alias("text_key"), "lang", "source", "n_chars")


@query("SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'bad' ELSE 'good' END AS kind FROM documents")
def tolerant_read(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of which a tenth are broken; blank lines lie between them."""
    path = fresh_dir(spark, "lines")
    d = table(spark, sf, "documents")
    d.select(F.concat(F.lit("\n"), F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("{broken "), "doc_id")).otherwise(F.to_json(F.struct("doc_id", "text")))).alias("value")).write.text(path)
    good, bad = jsonl.read_tolerant(spark, path, "doc_id long, text string")
    return good.select("doc_id", F.lit("good").alias("kind")).union(bad.select(F.regexp_extract(jsonl.CORRUPT, r"(\d+)", 1).cast("long"), F.lit("bad")))


@query("SELECT row_number() OVER (ORDER BY n_nationkey) AS line, n_name AS raw FROM nation")
def numbered_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of one file (a dimension table) with their numbers."""
    path = fresh_dir(spark, "numbered")
    table(spark, sf, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select("n_name").write.text(path)
    return jsonl.read_numbered(spark, path)


@query("SELECT doc_id AS id, quality AS value FROM labels UNION ALL SELECT doc_id, toxic FROM labels WHERE doc_id % 2 = 0")
def appended_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "appended")
    own = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("value"), "toxic")
    sinks.append_jsonl(own.select("id", "value"), path)
    sinks.append_jsonl(own.where("id % 2 = 0").select("id", F.col("toxic").alias("value")), path)
    return jsonl.read_strict(spark, path, "id long, value int")


@query("SELECT DISTINCT doc_id AS id FROM labels")
def id_list(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_dir(spark, "ids")
    sinks.write_jsonl(table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality"), path)
    return jsonl.read_id_list(spark, path)


@query("SELECT 'rows' AS name, count(*) AS n FROM labels UNION ALL SELECT 'toxic', sum(toxic)::BIGINT FROM labels")
def observed_write(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of rows as they are written."""
    seen = sinks.write_observed(table(spark, sf, "labels"), fresh_dir(spark, "observed"), toxic=F.sum("toxic"))
    return spark.createDataFrame([(k, v) for k, v in seen.items()], "name string, n long")


@query("SELECT doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN 'toxic ' || toxic ELSE 'quality ' || quality END AS value FROM labels")
def folded_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two micro-batches, the second twice, folded into a keyed table."""
    folder, schema = fresh_dir(spark, "folded"), "id long, value string"
    own = table(spark, sf, "labels")
    run = resume.fold(folder, ["id"], schema)
    run(own.select(F.col("doc_id").alias("id"), F.concat(F.lit("quality "), "quality").alias("value")), 0)
    for _ in range(2):
        run(own.where("doc_id % 4 = 0").select(F.col("doc_id").alias("id"), F.concat(F.lit("toxic "), "toxic").alias("value")), 1)
    return resume.current(spark, folder, schema)
