"""Preference-data shapes derived from the driver's tables, for Spark and for SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefmill.functions.text import same_text
from prefmill.session import table

TASKS = 200
JUDGED_TASKS = 50
WORKERS = ["worker_0", "worker_1"]


def tokens(c: str = "text"):
    return F.size(F.split(c, " "))


def cand(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates of ``TASKS`` tasks from two workers."""
    d = table(spark, sf, "documents").select((F.col("n_chars") % TASKS).alias("id"), (F.col("doc_id") % 2).cast("int").alias("worker_ord"), "doc_id", "lang", "text", same_text("text").alias("key"))
    pos = F.row_number().over(Window.partitionBy("id", "worker_ord").orderBy("doc_id")) - 1
    return d.withColumns({"worker_id": F.concat(F.lit("worker_"), "worker_ord"), "pos": pos})


CAND = f"""cand AS (SELECT n_chars % {TASKS} AS id, doc_id % 2 AS worker_ord, 'worker_' || (doc_id % 2) AS worker_id, doc_id, lang, text,
  trim(regexp_replace(text, '\\s+', ' ', 'g')) AS key,
  row_number() OVER (PARTITION BY n_chars % {TASKS}, doc_id % 2 ORDER BY doc_id) - 1 AS pos FROM documents)"""


def judg(spark: SparkSession, sf: str) -> DataFrame:
    """Judged candidates with scores from the lengths; verdicts by the score difference."""
    from prefmill.operators.judging import group_verdict

    d = table(spark, sf, "documents").select((F.col("n_chars") % JUDGED_TASKS).alias("id"), "doc_id", F.col("lang").alias("category"), "n_chars")
    d = d.withColumns(
        {
            "pos": F.row_number().over(Window.partitionBy("id").orderBy("doc_id")) - 1,
            "candidate_score": (F.col("n_chars") % 101).cast("int"),
            "chosen_score": (F.col("id") * 37 % 101).cast("int"),
            "confidence": F.element_at(F.array(*map(F.lit, ("low", "medium", "high"))), (F.col("doc_id") % 3 + 1).cast("int")),
        }
    )
    return d.withColumns({"candidate_id": F.concat(F.lit("w:"), F.col("pos").cast("string")), "verdict": group_verdict(F.col("chosen_score"), F.col("candidate_score"))})


JUDG = f"""j0 AS (SELECT n_chars % {JUDGED_TASKS} AS id, doc_id, lang AS category, n_chars,
  row_number() OVER (PARTITION BY n_chars % {JUDGED_TASKS} ORDER BY doc_id) - 1 AS pos, n_chars % 101 AS candidate_score,
  (n_chars % {JUDGED_TASKS}) * 37 % 101 AS chosen_score, CASE doc_id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS confidence FROM documents),
judg AS (SELECT *, 'w:' || pos AS candidate_id, CASE WHEN abs(chosen_score - candidate_score) <= 2 THEN 'tie'
  WHEN chosen_score > candidate_score THEN 'chosen_better' ELSE 'candidate_better' END AS verdict FROM j0)"""


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Reviewed pairs: labels with their documents; lengths and margins from the text."""
    from prefmill.operators.subsets import length_features

    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    out = table(spark, sf, "labels").join(d, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("category"),
        "source",
        F.when(F.col("quality") == 1, "accept_pair").otherwise("swap_pair").alias("decision"),
        F.when(F.col("doc_id") % 3 == 0, "medium").otherwise("high").alias("confidence"),
        tokens().alias("chosen_tokens"),
        (F.col("n_chars") % 97 + 1).cast("int").alias("rejected_tokens"),
        (F.col("n_chars") % 211 - 105).cast("double").alias("sum_margin"),
        ((F.col("n_chars") % 211 - 105) / 1000).alias("mean_margin"),
    )
    return length_features(out)


PAIRS = """pairs AS (SELECT *, greatest(chosen_tokens, rejected_tokens) / CAST(least(chosen_tokens, rejected_tokens) AS DOUBLE) AS length_ratio,
  rejected_tokens > chosen_tokens AS rejected_longer FROM (
  SELECT l.doc_id AS id, d.lang AS category, d.source, CASE WHEN quality = 1 THEN 'accept_pair' ELSE 'swap_pair' END AS decision,
  CASE WHEN l.doc_id % 3 = 0 THEN 'medium' ELSE 'high' END AS confidence, len(string_split(text, ' ')) AS chosen_tokens, n_chars % 97 + 1 AS rejected_tokens,
  CAST(n_chars % 211 - 105 AS DOUBLE) AS sum_margin, (n_chars % 211 - 105) / 1000.0::DOUBLE AS mean_margin
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id))"""


def dialogues(spark: SparkSession, sf: str) -> DataFrame:
    """One row a conversation: its turns without the system's, as an array in order."""
    c = table(spark, sf, "conversations").where("role <> 'system'")
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return c.groupBy(F.col("conv_id").alias("id")).agg(turns.alias("turns"))


DIALOGUES = """dialogues AS (SELECT conv_id AS id, list({'role': role, 'text': text} ORDER BY turn) AS turns FROM conversations WHERE role <> 'system' GROUP BY conv_id)"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Events as evaluated rows: the type is the category, values are scores."""
    e = table(spark, sf, "events")
    return e.select(F.col("event_type").alias("category"), F.round("value", 3).alias("single"), F.round(F.col("value") / 2, 3).alias("multi"))
