"""Queries over the driver's tables, each with its SQL.

``QUERIES`` maps a name to a function of (spark, sf_dir); ``SQL`` to the same
rows in ANSI SQL. Doubles are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.functions.hashing import candidate_is_a, sha_rank
from prefmill.functions.text import blank, collapse, strip, template_key
from prefmill.operators import candidates, contracts, evaluation, judging, margins, quality, reviews, shaping, splits, subsets
from prefmill.plans.views import CAND, DIALOGUES, JUDG, PAIRS, WORKERS, cand, dialogues, judg, pairs, scored, tokens
from prefmill.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
REQUIRED = 4


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# candidates


@query(
    f"""WITH {CAND}, once AS (SELECT *, row_number() OVER (PARTITION BY id, key ORDER BY worker_ord, pos) AS n FROM cand),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY worker_ord, pos) AS rank, count(*) OVER (PARTITION BY id) AS uniq FROM once WHERE n = 1)
SELECT id, rank, worker_id, pos, doc_id FROM ranked WHERE rank <= {REQUIRED} AND uniq >= {REQUIRED}"""
)
def merge_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """The first four distinct answers of each task that has four."""
    first = candidates.first_distinct(cand(spark, sf), REQUIRED, F.col("key"))
    full = first.where(F.col("rank") == REQUIRED).select("id")
    return first.join(full, "id", "left_semi").select("id", "rank", "worker_id", "pos", "doc_id")


@query(
    f"""WITH {CAND}, stats AS (SELECT id, count(*) AS total, count(DISTINCT key) AS uniq, bool_or(worker_ord = 0) AS w0, bool_or(worker_ord = 1) AS w1 FROM cand GROUP BY id),
tasks AS (SELECT range AS id FROM range(200))
SELECT t.id, coalesce(uniq, 0) AS unique_candidates, {REQUIRED} AS required_candidates, coalesce(total, 0) - coalesce(uniq, 0) AS duplicate_candidates,
concat_ws(',', CASE WHEN NOT coalesce(w0, false) THEN 'worker_0' END, CASE WHEN NOT coalesce(w1, false) THEN 'worker_1' END) AS missing_worker_outputs
FROM tasks t LEFT JOIN stats s ON t.id = s.id WHERE coalesce(uniq, 0) < {REQUIRED}"""
)
def incomplete_tasks(spark: SparkSession, sf: str) -> DataFrame:
    out = candidates.merge_counts(spark.range(200), cand(spark, sf), REQUIRED, WORKERS, F.col("key")).where("NOT complete").drop("complete")
    return out.withColumn("missing_worker_outputs", F.array_join("missing_worker_outputs", ","))


@query("SELECT doc_id AS id, lang AS category FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)")
def resume_pending(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a complete label, and the toxic ones again."""
    tasks = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("category"))
    labels = table(spark, sf, "labels").withColumnRenamed("doc_id", "id")
    return candidates.pending(tasks, labels.where("quality = 1"), labels.where("toxic = 1"))


@query(
    """SELECT doc_id AS id, 'new' AS origin, quality AS value FROM labels WHERE doc_id % 4 = 0
UNION ALL SELECT doc_id, 'old', toxic FROM labels WHERE doc_id % 4 <> 0"""
)
def upsert_results(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").withColumnRenamed("doc_id", "id")
    old = labels.select("id", F.lit("old").alias("origin"), F.col("toxic").alias("value"))
    new = labels.where("id % 4 = 0").select("id", F.lit("new").alias("origin"), F.col("quality").alias("value"))
    return candidates.upsert(old, new, ["id"])


@query("SELECT doc_id * 2 AS doc_id, quality FROM labels WHERE doc_id * 2 NOT IN (SELECT doc_id FROM documents)")
def unknown_references(spark: SparkSession, sf: str) -> DataFrame:
    moved = table(spark, sf, "labels").select((F.col("doc_id") * 2).alias("doc_id"), "quality")
    return contracts.unknown_keys(moved, table(spark, sf, "documents"), "doc_id")


# contracts


@query(
    f"""WITH {DIALOGUES} SELECT CAST(id AS VARCHAR) AS id, 'prompt' AS rule FROM dialogues
WHERE len(turns) < 3 OR turns[1].role <> 'user' OR turns[2].role <> 'assistant' OR turns[3].role <> 'user'
UNION ALL SELECT CAST(id AS VARCHAR), 'long' FROM dialogues WHERE len(turns) > 5"""
)
def contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations whose first three turns are no user, assistant, user; and those over five turns."""
    d = dialogues(spark, sf).withColumn("prompt", F.transform(F.slice("turns", 1, 3), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))))
    return contracts.violations(d, {"prompt": contracts.bad_dialogue(), "long": F.size("turns") > 5})


@query("SELECT role, text, count(*) AS n FROM conversations GROUP BY role, text HAVING count(*) > 1")
def duplicate_turns(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.duplicate_keys(table(spark, sf, "conversations"), "role", "text")


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS id, unnest(list_filter([CASE WHEN trim(text) = '' THEN 'text' END, CASE WHEN lang NOT IN ('en', 'de') THEN 'lang' END,
CASE WHEN n_chars > 5000 THEN 'length' END], lambda x: x IS NOT NULL)) AS rule FROM documents"""
)
def document_violations(spark: SparkSession, sf: str) -> DataFrame:
    rules = {"text": blank("text"), "lang": contracts.not_in("lang", ["en", "de"]), "length": F.col("n_chars") > 5000}
    return contracts.violations(table(spark, sf, "documents"), rules, "doc_id")


# judging


@query(
    """SELECT doc_id, CASE WHEN CAST('0x' || substr(sha256('["int","' || doc_id || '","w:' || (doc_id % 4) || '",42]'), 1, 2) AS INTEGER) % 2 = 0 THEN 'A' ELSE 'B' END AS candidate_label FROM documents"""
)
def anonymized_side(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("w:"), (F.col("doc_id") % 4).cast("string")).alias("c"))
    return d.select("doc_id", F.when(candidate_is_a("int", F.col("doc_id"), F.col("c"), 42), "A").otherwise("B").alias("candidate_label"))


@query(f"WITH {JUDG} SELECT id, candidate_id, verdict, chosen_score, candidate_score FROM judg")
def group_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return judg(spark, sf).select("id", "candidate_id", "verdict", "chosen_score", "candidate_score")


@query(
    """WITH x AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'tie' END AS winner, CASE WHEN doc_id % 2 = 0 THEN 'A' ELSE 'B' END AS chosen_label, n_chars % 101 AS a, n_chars % 89 AS b FROM documents)
SELECT doc_id, CASE WHEN winner = 'tie' THEN 'tie' WHEN winner = chosen_label THEN 'chosen_better' ELSE 'candidate_better' END AS verdict,
CASE WHEN chosen_label = 'A' THEN a ELSE b END AS chosen_score FROM x"""
)
def pair_verdict(spark: SparkSession, sf: str) -> DataFrame:
    winner = F.element_at(F.array(*map(F.lit, ("A", "B", "tie"))), (F.col("doc_id") % 3 + 1).cast("int"))
    label = F.when(F.col("doc_id") % 2 == 0, "A").otherwise("B")
    return table(spark, sf, "documents").select("doc_id", judging.pair_verdict(winner, label).alias("verdict"), judging.side_score(label, F.col("n_chars") % 101, F.col("n_chars") % 89).alias("chosen_score"))


_OUTPUT = "'{\"winner\":\"' || w || '\",\"score_a\":' || a || ',\"score_b\":' || b || ',\"confidence\":\"' || c || '\",\"reason\":\"' || r || '\"' || x"


@query(
    """WITH x AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'tie' ELSE 'C' END AS w, n_chars % 120 AS a, n_chars % 110 AS b,
CASE doc_id % 7 WHEN 0 THEN 'sure' ELSE 'high' END AS c, CASE doc_id % 11 WHEN 0 THEN ' ' ELSE 'ok' END AS r, CASE doc_id % 13 WHEN 0 THEN 'extra' WHEN 1 THEN 'broken' ELSE '' END AS x FROM documents)
SELECT doc_id, CASE WHEN x = 'broken' THEN 'invalid JSON' WHEN x = 'extra' THEN 'wrong fields' WHEN w = 'C' THEN 'winner' WHEN a > 100 OR b > 100 THEN 'score'
WHEN c = 'sure' THEN 'confidence' WHEN r = ' ' THEN 'reason' WHEN (w = 'A' AND a <= b) OR (w = 'B' AND b <= a) OR (w = 'tie' AND abs(a - b) > 2) THEN 'winner and scores disagree' END AS error FROM x"""
)
def judge_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Judge JSON with every kind of fault."""
    d = table(spark, sf, "documents").selectExpr(
        "doc_id",
        "CASE doc_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'tie' ELSE 'C' END AS w",
        "n_chars % 120 AS a",
        "n_chars % 110 AS b",
        "CASE doc_id % 7 WHEN 0 THEN 'sure' ELSE 'high' END AS c",
        "CASE doc_id % 11 WHEN 0 THEN ' ' ELSE 'ok' END AS r",
        "CASE doc_id % 13 WHEN 0 THEN ',\"more\":1}' WHEN 1 THEN '' ELSE '}' END AS x",
    )
    return judging.parse_pair_output(d.select("doc_id", F.expr(_OUTPUT).alias("output"))).select("doc_id", "error")


@query(
    f"""WITH {JUDG}, missing AS (SELECT id, count(*) FILTER (doc_id % 29 = 0 AND doc_id % 17 <> 0) AS m FROM judg GROUP BY id),
live AS (SELECT * FROM judg WHERE doc_id % 17 <> 0 AND doc_id % 29 <> 0),
best AS (SELECT id, candidate_id, row_number() OVER (PARTITION BY id ORDER BY candidate_score DESC, chosen_score - candidate_score, CASE confidence WHEN 'low' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END DESC, candidate_id) AS n FROM live WHERE verdict = 'chosen_better'),
review AS (SELECT id, count(*) FILTER (verdict = 'candidate_better') AS r FROM live GROUP BY id)
SELECT m.id, b.candidate_id AS rejected_id, CASE WHEN b.id IS NOT NULL AND coalesce(r, 0) > 0 THEN 'selected_with_chosen_review' WHEN b.id IS NOT NULL THEN 'selected'
WHEN coalesce(r, 0) > 0 THEN 'chosen_review' ELSE 'no_clear_rejected' END AS status, coalesce(r, 0) AS reviews
FROM missing m LEFT JOIN best b ON b.id = m.id AND b.n = 1 LEFT JOIN review r ON r.id = m.id WHERE m.m = 0"""
)
def select_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Complete tasks with their status and the rejected answer; some candidates are excluded, some not judged."""
    j = judg(spark, sf).withColumns({"worker_id": F.lit("w"), "candidate_index": F.col("pos"), "text": F.lit(""), "reason": F.lit("r")})
    done, _ = judging.aggregate_tasks(
        j.select("id", "category", "pos", "candidate_id", "worker_id", "candidate_index", "text"),
        j.where("doc_id % 29 <> 0").select("id", "candidate_id", "verdict", "candidate_score", "chosen_score", "confidence", "reason"),
        j.where("doc_id % 17 = 0").select("id", "candidate_id"),
    )
    return done.select("id", F.col("selected_rejected.candidate_id").alias("rejected_id"), "status", F.size("review_candidate_ids").cast("long").alias("reviews"))


@query(
    f"""WITH {JUDG} SELECT id, array_to_string(list(candidate_id ORDER BY pos), ',') AS missing FROM judg WHERE doc_id % 29 = 0 AND doc_id % 17 <> 0 GROUP BY id"""
)
def incomplete_judgments(spark: SparkSession, sf: str) -> DataFrame:
    j = judg(spark, sf).withColumns({"worker_id": F.lit("w"), "candidate_index": F.col("pos"), "text": F.lit(""), "reason": F.lit("r")})
    _, missing = judging.aggregate_tasks(
        j.select("id", "category", "pos", "candidate_id", "worker_id", "candidate_index", "text"),
        j.where("doc_id % 29 <> 0").select("id", "candidate_id", "verdict", "candidate_score", "chosen_score", "confidence", "reason"),
        j.where("doc_id % 17 = 0").select("id", "candidate_id"),
    )
    return missing.select("id", F.array_join("missing_candidate_ids", ",").alias("missing"))


@query(
    f"""WITH {JUDG}, g AS (SELECT *, pos // 2 AS grp, doc_id % 5 = 0 AS done FROM judg),
u AS (SELECT *, count(*) OVER (PARTITION BY id, grp) AS size, count(*) FILTER (NOT done) OVER (PARTITION BY id, grp) AS missing FROM g)
SELECT id, candidate_id, CAST(grp AS INTEGER) AS grp, CASE WHEN size = 2 AND missing = 2 AND n_chars + 400 <= 4000 THEN 'groupwise' ELSE 'pairwise' END AS mode FROM u WHERE NOT done"""
)
def judge_units(spark: SparkSession, sf: str) -> DataFrame:
    """Units still to judge, with the fallback for long groups."""
    j = judg(spark, sf)
    units = judging.pending_units(j, j.where("doc_id % 5 = 0").select("id", "candidate_id"), 2)
    units = judging.length_fallback(units, "n_chars", 400, 4000)
    return units.select("id", "candidate_id", F.col("group").alias("grp"), "mode")


@query(
    f"""WITH {JUDG} SELECT id, candidate_id, CASE WHEN doc_id % 6 = 0 THEN 'prompt changed' ELSE 'judge changed' END AS stale FROM judg WHERE doc_id % 6 = 0 OR doc_id % 10 = 1"""
)
def stale_judgments(spark: SparkSession, sf: str) -> DataFrame:
    j = judg(spark, sf)
    now = j.select("id", "candidate_id", F.sha2(F.col("doc_id").cast("string"), 256).alias("prompt_fingerprint"))
    cache = j.select("id", "candidate_id", F.sha2(F.when(F.col("doc_id") % 6 == 0, "old").otherwise(F.col("doc_id").cast("string")), 256).alias("prompt_fingerprint"), F.when(F.col("doc_id") % 10 == 1, "other").otherwise("judge").alias("judge_model"))
    return judging.stale_cache(cache, now, "judge").select("id", "candidate_id", "stale")


# reviews


_REVIEWS = """r AS (SELECT l.doc_id AS id, d.lang AS category, CASE WHEN l.doc_id % 9 = 0 THEN 'skip' WHEN quality = 1 THEN 'accept_pair' ELSE 'swap_pair' END AS decision,
d.text AS chosen, CASE WHEN l.doc_id % 10 = 3 THEN d.text ELSE reverse(d.text) END AS other, l.doc_id % 14 = 5 AS cut FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""


def _reviewed(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    decision = F.when(F.col("doc_id") % 9 == 0, "skip").when(F.col("quality") == 1, "accept_pair").otherwise("swap_pair")
    other = F.when(F.col("doc_id") % 10 == 3, F.col("text")).otherwise(F.reverse("text"))
    item = F.struct(other.alias("text"), F.when(F.col("doc_id") % 14 == 5, "length").otherwise("stop").alias("finish_reason"))
    d = d.select(
        F.col("doc_id").alias("id"), F.col("lang").alias("category"), F.col("lang").alias("source_category"), decision.alias("decision"), F.array().cast("array<string>").alias("prompt"),
        F.col("text").alias("chosen"), F.create_map(F.lit("w:0"), item).alias("candidates"), F.lit("ok").alias("gemma_status"), F.lit("r").alias("reason"), F.lit("high").alias("confidence"),
    )
    return d.withColumns(
        {
            "chosen_source": F.when(F.col("decision") == "swap_pair", "w:0").otherwise("original"),
            "rejected_source": F.when(F.col("decision") == "accept_pair", "w:0").when(F.col("decision") == "swap_pair", "original"),
        }
    )


@query(
    f"""WITH {_REVIEWS} SELECT id, category, decision, sha256(CASE WHEN decision = 'accept_pair' THEN chosen ELSE other END) AS chosen_hash,
sha256(CASE WHEN decision = 'accept_pair' THEN other ELSE chosen END) AS rejected_hash FROM r WHERE decision <> 'skip' AND NOT cut AND trim(chosen) <> trim(other)"""
)
def finalize_reviews(spark: SparkSession, sf: str) -> DataFrame:
    done, _ = reviews.finalize(_reviewed(spark, sf))
    return done.select("id", "category", "review.decision", F.sha2("chosen", 256).alias("chosen_hash"), F.sha2("rejected", 256).alias("rejected_hash"))


@query(f"WITH {_REVIEWS} SELECT id, CASE WHEN cut THEN 'unresolved' ELSE 'identical' END AS reason FROM r WHERE decision <> 'skip' AND (cut OR trim(chosen) = trim(other))")
def failed_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.finalize(_reviewed(spark, sf))[1]


@query(
    f"""WITH {_REVIEWS} SELECT CAST(id AS VARCHAR) AS id, unnest(list_filter([CASE WHEN id % 8 = 1 THEN 'confidence' END, CASE WHEN id % 12 = 2 AND decision = 'accept_pair' THEN 'accept_pair' END,
CASE WHEN id % 12 = 2 AND decision = 'swap_pair' THEN 'swap_pair' END, CASE WHEN id % 12 = 2 AND decision = 'skip' THEN 'skip' END], lambda x: x IS NOT NULL)) AS rule FROM r"""
)
def review_violations(spark: SparkSession, sf: str) -> DataFrame:
    r = _reviewed(spark, sf)
    wrong = F.col("id") % 12 == 2
    r = r.withColumns({"confidence": F.when(F.col("id") % 8 == 1, "certain").otherwise("high"), "rejected_source": F.when(wrong, "w:9").otherwise(F.col("rejected_source"))})
    return contracts.violations(r, reviews.review_rules())


@query(
    f"""WITH {_REVIEWS}, p AS (SELECT * FROM r WHERE decision <> 'skip' AND NOT cut AND trim(chosen) <> trim(other))
SELECT 'source_rows' AS measure, '' AS value, count(*) AS n FROM r UNION ALL SELECT 'review_rows', '', count(*) FROM r UNION ALL SELECT 'preference_pairs', '', count(*) FROM p
UNION ALL SELECT 'decision', decision, count(*) FROM r GROUP BY decision UNION ALL SELECT 'confidence', 'high', count(*) FROM r UNION ALL SELECT 'category', category, count(*) FROM p GROUP BY category"""
)
def review_report(spark: SparkSession, sf: str) -> DataFrame:
    r = _reviewed(spark, sf)
    return reviews.review_report(r, r, reviews.finalize(r)[0])


# subsets


def _rank_sql(*parts: str) -> str:
    return "sha256(" + " || ':' || ".join(parts) + ")"


_CONTROL = f"""control AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY {_rank_sql("'42'", "'control'", "category", "id")}, id) AS rk FROM pairs) WHERE rk <= 8)"""
_PRIORITY = f"""priority AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY length_ratio, {_rank_sql("'42'", "'length-priority'", "category", "id")}, id) AS rk FROM pairs) WHERE rk <= 8)"""


def _control(spark: SparkSession, sf: str) -> DataFrame:
    return subsets.sample_balanced(pairs(spark, sf), 8, 42, "control")


@query(f"WITH {PAIRS}, {_CONTROL} SELECT id, category, decision FROM control")
def sample_balanced(spark: SparkSession, sf: str) -> DataFrame:
    return _control(spark, sf).select("id", "category", "decision")


@query(f"WITH {PAIRS}, {_PRIORITY} SELECT id, category, round(length_ratio, 6) AS length_ratio FROM priority")
def length_priority(spark: SparkSession, sf: str) -> DataFrame:
    return subsets.length_priority(pairs(spark, sf), 8, 42).select("id", "category", F.round("length_ratio", 6).alias("length_ratio"))


@query(
    f"""WITH {PAIRS} SELECT category, count(*) AS n, round(avg(chosen_tokens), 4) AS chosen_mean, round(avg(rejected_tokens), 4) AS rejected_mean, round(avg(length_ratio), 4) AS ratio_mean,
round(quantile_disc(length_ratio, 0.5), 6) AS ratio_p50, round(quantile_disc(length_ratio, 0.9), 6) AS ratio_p90, round(max(length_ratio), 6) AS ratio_max, count(*) FILTER (rejected_longer) AS rejected_longer_count FROM pairs GROUP BY category"""
)
def subset_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = subsets.subset_summary(pairs(spark, sf), ["category"])
    digits = {"chosen_mean": 4, "rejected_mean": 4, "ratio_mean": 4, "ratio_p50": 6, "ratio_p90": 6, "ratio_max": 6}
    return out.withColumns({c: F.round(c, k) for c, k in digits.items()})


@query(
    f"""WITH {PAIRS}, t AS (SELECT unnest([1.2, 1.33, 1.5, 2.0, 2.5, 3.0])::DOUBLE AS threshold), c AS (SELECT unnest(['de', 'en', 'es', 'fr', 'xx']) AS category),
n AS (SELECT t.threshold, c.category, count(p.id) AS n FROM t CROSS JOIN c LEFT JOIN pairs p ON p.category = c.category AND p.length_ratio <= t.threshold GROUP BY ALL)
SELECT threshold, category, n, sum(n) OVER (PARTITION BY threshold)::BIGINT AS total, min(n) OVER (PARTITION BY threshold) AS per_category_max FROM n"""
)
def length_feasibility(spark: SparkSession, sf: str) -> DataFrame:
    categories = spark.createDataFrame([(c,) for c in ("de", "en", "es", "fr", "xx")], "category string")
    return subsets.feasibility(pairs(spark, sf), categories).select("threshold", "category", "n", "total", "per_category_max")


@query(
    f"""WITH {PAIRS}, {_CONTROL}, {_PRIORITY} SELECT count(*) FILTER (c.id IS NOT NULL AND p.id IS NOT NULL) AS overlap_rows, count(*) FILTER (p.id IS NULL) AS replaced_rows, count(*) FILTER (c.id IS NULL) AS added_rows
FROM control c FULL JOIN priority p ON c.id = p.id"""
)
def arm_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return subsets.overlap(_control(spark, sf), subsets.length_priority(pairs(spark, sf), 8, 42))


@query(
    f"""WITH {PAIRS}, {_CONTROL}, {_PRIORITY} SELECT (SELECT list(x ORDER BY x) FROM (SELECT category || ':' || count(*) AS x FROM control GROUP BY category)) =
(SELECT list(x ORDER BY x) FROM (SELECT category || ':' || count(*) AS x FROM priority GROUP BY category)) AS equal"""
)
def arms_balanced(spark: SparkSession, sf: str) -> DataFrame:
    return subsets.same_counts(_control(spark, sf), subsets.length_priority(pairs(spark, sf), 8, 42), ["category"])


def _in(table: str, *conditions: str) -> str:
    return f"(SELECT count(*) FROM {table} t WHERE {' AND '.join(('t.category = c.category', *conditions))})"


_SWAP, _ACCEPT = "decision = 'swap_pair'", "decision = 'accept_pair'"
_ALLOCATED = f"""kept AS (SELECT * FROM control WHERE confidence = 'high'), free AS (SELECT * FROM pairs WHERE confidence = 'high' AND id NOT IN (SELECT id FROM kept)),
n AS (SELECT category, 8 - {_in("kept")} AS slots, {_in("free", _SWAP)} AS swaps, {_in("free", _ACCEPT)} AS accepts, {_in("control", _SWAP)} - {_in("kept", _SWAP)} AS wanted
FROM (SELECT unnest(['de', 'en', 'es', 'fr']) AS category) c),
x AS (SELECT category, slots, x, abs(x - wanted) AS off FROM (SELECT *, unnest(range(greatest(0, slots - accepts), least(slots, swaps) + 1)) AS x FROM n)),
best AS (SELECT [a.x, b.x, c.x, d.x] AS xs FROM x a, x b, x c, x d WHERE a.category = 'de' AND b.category = 'en' AND c.category = 'es' AND d.category = 'fr'
AND a.x + b.x + c.x + d.x = (SELECT sum(wanted) FROM n) ORDER BY a.off + b.off + c.off + d.off, xs LIMIT 1),
swapped AS (SELECT unnest(['de', 'en', 'es', 'fr']) AS category, unnest(xs) AS x FROM best),
quota AS (SELECT category, 'swap_pair' AS decision, x AS quota FROM swapped UNION ALL SELECT n.category, 'accept_pair', slots - x FROM n JOIN swapped s ON n.category = s.category),
r AS (SELECT f.*, quota, row_number() OVER (PARTITION BY f.category, f.decision ORDER BY {_rank_sql("'42'", "'high-matched'", "f.decision", "f.category", "f.id")}, f.id) AS k
FROM free f JOIN quota q ON f.category = q.category AND f.decision = q.decision)"""


@query(f"WITH {PAIRS}, {_CONTROL}, {_ALLOCATED} SELECT id, category, decision, confidence FROM kept UNION ALL SELECT id, category, decision, confidence FROM r WHERE k <= quota")
def high_matched_arm(spark: SparkSession, sf: str) -> DataFrame:
    """The allocation of swaps is a small search on counts, in the SQL by trying all."""
    p = pairs(spark, sf)
    return subsets.high_matched(_control(spark, sf), p.where("confidence = 'high'"), 8, 42, ["de", "en", "es", "fr"]).select("id", "category", "decision", "confidence")


# splits


_SPLIT_RANK = _rank_sql("'42'", "'split'", "category", "id")


@query(
    f"""WITH {PAIRS}, h AS (SELECT *, {_SPLIT_RANK} AS h FROM pairs), k AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY h) AS k FROM h),
s AS (SELECT count(*) AS n, count(DISTINCT category) AS c FROM pairs), r AS (SELECT id, row_number() OVER (ORDER BY sha256('42:rest:' || h)) AS r FROM k WHERE k > 2)
SELECT k.id, k.category, CASE WHEN k.k = 1 OR r.r <= least(greatest(s.c, s.n - CAST(floor(s.n * 0.9) AS BIGINT)), s.n - s.c) - s.c THEN 'eval' ELSE 'train' END AS split
FROM k LEFT JOIN r ON k.id = r.id CROSS JOIN s"""
)
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.stratified(pairs(spark, sf).select("id", "category"), 0.9, 42).select("id", "category", "split")


@query(
    """WITH g AS (SELECT conv_id, row_number() OVER (ORDER BY sha256('42:group:' || conv_id)) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT c.conv_id, c.turn, CASE WHEN r <= least(greatest(1, CAST(floor(n * 0.8) AS BIGINT)), n - 1) THEN 'train' ELSE 'eval' END AS split FROM conversations c JOIN g ON g.conv_id = c.conv_id"""
)
def group_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.grouped(table(spark, sf, "conversations"), 0.8, 42, "conv_id").select("conv_id", "turn", "split")


# margins


_DIST = ", ".join(
    f"count({c}) AS {c}_count, round(min({c}), 6) AS {c}_min, "
    + ", ".join(f"round(CAST(quantile_disc({c}, {f}) AS DOUBLE), 6) AS {c}_p{round(f * 100)}" for f in (0.1, 0.25, 0.5, 0.75, 0.9))
    + f", round(max({c}), 6) AS {c}_max, round(avg({c}), 6) AS {c}_mean, round(stddev_pop({c}), 6) AS {c}_stdev"
    for c in ("sum_margin", "mean_margin", "chosen_tokens", "rejected_tokens", "length_delta")
)


def _corr(a: str, b: str) -> str:
    return f"CASE WHEN count(*) > 1 AND min({a}) < max({a}) AND min({b}) < max({b}) THEN round(covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})), 6) END"


@query(
    f"""WITH {PAIRS}, m AS (SELECT *, CAST(rejected_tokens - chosen_tokens AS DOUBLE) AS length_delta FROM pairs)
SELECT CASE WHEN grouping(category) = 0 THEN 'category' WHEN grouping(decision) = 0 THEN 'decision' WHEN grouping(confidence) = 0 THEN 'confidence' ELSE 'all' END AS grouping,
coalesce(category, decision, confidence, 'all') AS "group", count(*) AS n, count(*) FILTER (mean_margin > 0.05) AS chosen_above_band, count(*) FILTER (abs(mean_margin) <= 0.05) AS near_zero_band,
count(*) FILTER (mean_margin < -0.05) AS rejected_above_band, count(*) FILTER (mean_margin > 0) AS chosen_positive, count(*) FILTER (mean_margin < 0) AS rejected_positive, count(*) FILTER (mean_margin = 0) AS exact_tie,
count(*) FILTER (sum_margin > 0) AS sum_chosen_positive, count(*) FILTER (sum_margin < 0) AS sum_rejected_positive, count(*) FILTER (sum_margin = 0) AS sum_exact_tie, {_DIST},
{_corr("length_delta", "sum_margin")} AS corr_sum, {_corr("length_delta", "mean_margin")} AS corr_mean
FROM m GROUP BY GROUPING SETS ((), (category), (decision), (confidence))"""
)
def margin_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = margins.summary(pairs(spark, sf), ["category", "decision", "confidence"])
    return out.select([F.round(c, 6).alias(c) if t == "double" or c.startswith(("chosen_tokens_m", "rejected_tokens_m")) else F.col(c) for c, t in out.dtypes])


@query(f"WITH {PAIRS} SELECT id, round(mean_margin, 6) AS mean_margin, row_number() OVER (ORDER BY abs(mean_margin), CAST(id AS VARCHAR)) AS rank FROM pairs QUALIFY rank <= 40")
def review_priority(spark: SparkSession, sf: str) -> DataFrame:
    """The forty closest margins (a top-k report)."""
    from pyspark.sql import Window

    top = margins.review_priority(pairs(spark, sf), 40)
    return top.select("id", F.round("mean_margin", 6).alias("mean_margin"), F.row_number().over(Window.orderBy(F.abs("mean_margin"), F.col("id").cast("string"))).cast("long").alias("rank"))


@query(f"WITH {PAIRS} SELECT category, CASE WHEN mean_margin > 0.05 THEN 'chosen_above_band' WHEN mean_margin < -0.05 THEN 'rejected_above_band' ELSE 'near_zero_band' END AS band, count(*) AS n FROM pairs GROUP BY ALL")
def margin_bands(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf).groupBy("category", margins.band(F.col("mean_margin"), 0.05).alias("band")).agg(F.count(F.lit(1)).alias("n"))


# shaping


@query(
    f"""WITH {DIALOGUES}, q AS (SELECT id, turns FROM dialogues WHERE len(turns) >= 4)
SELECT id AS question_id, 1 AS turn, 2 AS n_messages, sha256(turns[2].text) AS last_hash FROM q UNION ALL SELECT id, 2, 4, sha256(turns[4].text) FROM q"""
)
def sft_explode(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("turns")
    raw = dialogues(spark, sf).where(F.size("turns") >= 4).select("id", F.lit("c").alias("category"), F.array(t[0]["text"], t[2]["text"]).alias("questions"), F.array(t[1]["text"], t[3]["text"]).alias("references"))
    made = shaping.sft_rows(raw)
    return made.select(F.col("meta.question_id").alias("question_id"), F.col("meta.turn").alias("turn"), F.size("messages").alias("n_messages"), F.sha2(F.element_at("messages", -1)["content"], 256).alias("last_hash"))


@query(
    f"""WITH {DIALOGUES} SELECT id, sha256('<bos>' || array_to_string(list_transform(turns, lambda t: CASE t.role WHEN 'user' THEN '<u>' WHEN 'assistant' THEN '<a>' ELSE '' END || t.text || '<e>'), '')) AS rendered FROM dialogues"""
)
def chat_template(spark: SparkSession, sf: str) -> DataFrame:
    d = dialogues(spark, sf).withColumn("messages", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))))
    return d.select("id", F.sha2(shaping.chat_text("messages", {"user": "<u>", "assistant": "<a>"}, "<e>", "<bos>"), 256).alias("rendered"))


@query(
    """WITH t AS (SELECT lang, len(string_split(text, ' ')) AS text_tokens, n_chars % 300 AS extra_tokens FROM documents)
SELECT lang, count(*) AS n, min(text_tokens) AS text_tokens_min, round(avg(text_tokens), 2) AS text_tokens_mean, CAST(quantile_disc(text_tokens, 0.5) AS DOUBLE) AS text_tokens_p50, CAST(quantile_disc(text_tokens, 0.95) AS DOUBLE) AS text_tokens_p95, max(text_tokens) AS text_tokens_max,
min(extra_tokens) AS extra_tokens_min, round(avg(extra_tokens), 2) AS extra_tokens_mean, CAST(quantile_disc(extra_tokens, 0.5) AS DOUBLE) AS extra_tokens_p50, CAST(quantile_disc(extra_tokens, 0.95) AS DOUBLE) AS extra_tokens_p95, max(extra_tokens) AS extra_tokens_max,
count(*) FILTER (text_tokens + extra_tokens > 1000) AS over_limit FROM t GROUP BY lang"""
)
def token_stats(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("lang", tokens().alias("text_tokens"), (F.col("n_chars") % 300).alias("extra_tokens"))
    return shaping.token_stats(d, ["text_tokens", "extra_tokens"], ["lang"], 1000)


@query(
    """WITH w AS (SELECT doc_id, list_transform(string_split(text, ' '), lambda x: length(x)) AS p FROM documents), c AS (SELECT *, CASE WHEN p[len(p)] = 7 THEN p ELSE list_append(p, 7) END AS f FROM w)
SELECT doc_id, array_to_string(p[greatest(len(p) - 15, 1):], ',') AS prompt_ids, array_to_string(f[1:20], ',') AS completion_ids, len(p) > 16 AS prompt_truncated, len(f) > 20 AS completion_truncated FROM c"""
)
def truncated_ids(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", F.transform(F.split("text", " "), lambda x: F.length(x)).alias("ids"))
    out = shaping.truncated_ids(d, "ids", "ids", 7, 16, 20)
    return out.select("doc_id", *[F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c) for c in ("prompt_ids", "completion_ids")], "prompt_truncated", "completion_truncated")


# quality gate


def _values(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as question and reference texts of their language."""
    d = table(spark, sf, "documents")
    field = F.when(F.col("doc_id") % 2 == 0, "questions").otherwise("references")
    return d.select(F.col("doc_id").alias("id"), F.col("lang").alias("category"), field.alias("field"), F.lit(0).alias("idx"), "text")


_KEY = r"""trim(regexp_replace(translate(regexp_replace(lower(text), '\d+', '', 'g'), '!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~', '                                '), '\s+', ' ', 'g'))"""
_METRICS = f"""v AS (SELECT lang AS category, doc_id % 2 = 0 AS q, text, {_KEY} AS key FROM documents),
m AS (SELECT category, count(DISTINCT key) FILTER (q) / CAST(count(*) FILTER (q) AS DOUBLE) AS q_unique_ratio, count(DISTINCT key) FILTER (NOT q) / CAST(count(*) FILTER (NOT q) AS DOUBLE) AS ref_unique_ratio,
avg(length(text)) FILTER (NOT q) AS ref_mean, count(*) FILTER (NOT q) AS ref_count FROM v GROUP BY category),
p AS (SELECT category, max(n) / CAST(sum(n) AS DOUBLE) AS top_ref_prefix_share FROM (SELECT category, substr(key, 1, 55), count(*) AS n FROM v WHERE NOT q GROUP BY ALL) GROUP BY category)"""


@query(
    f"""WITH {_METRICS} SELECT m.category, round(q_unique_ratio, 6) AS q_unique_ratio, round(ref_unique_ratio, 6) AS ref_unique_ratio, round(ref_mean, 4) AS ref_mean, ref_count, round(top_ref_prefix_share, 6) AS top_ref_prefix_share
FROM m JOIN p ON m.category = p.category"""
)
def quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    m = quality.category_metrics(_values(spark, sf))
    return m.withColumns({c: F.round(c, 4 if c == "ref_mean" else 6) for c in ("q_unique_ratio", "ref_unique_ratio", "ref_mean", "top_ref_prefix_share")})


@query(
    f"""WITH {_METRICS} SELECT m.category, unnest(list_filter([CASE WHEN q_unique_ratio < 0.55 THEN 'question diversity' END, CASE WHEN ref_unique_ratio < 0.45 THEN 'reference diversity' END,
CASE WHEN ref_mean < 2 * ref_mean * 0.6 THEN 'reference length' END, CASE WHEN ref_count >= 10 AND top_ref_prefix_share > 0.2 THEN 'reference prefix' END], lambda x: x IS NOT NULL)) AS rule FROM m JOIN p ON m.category = p.category"""
)
def quality_warnings(spark: SparkSession, sf: str) -> DataFrame:
    m = quality.category_metrics(_values(spark, sf))
    return quality.metric_warnings(m, m.withColumn("ref_mean", 2 * F.col("ref_mean")))


@query(
    """WITH t AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '이전  사례' WHEN 1 THEN 'fill {name_here} in' WHEN 2 THEN 'code `{name}` only' WHEN 3 THEN 'set ={x} and {y}' WHEN 4 THEN '조건 확장 3' ELSE substr(text, 1, 200) END AS s FROM documents)
SELECT doc_id AS id, unnest(CASE doc_id % 6 WHEN 0 THEN ['previous-case marker'] WHEN 1 THEN ['unfilled placeholder'] WHEN 3 THEN ['unfilled placeholder'] WHEN 4 THEN ['numeric condition marker', 'generated review id'] ELSE [] END) AS rule FROM t"""
)
def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Forbidden wording in the whole of every text; some is planted behind five sixths of them."""
    n = F.col("doc_id") % 6
    planted = F.when(n == 0, "이전  사례").when(n == 1, "fill {name_here} in").when(n == 2, "code `{name}` only").when(n == 3, "set ={x} and {y}").when(n == 4, "조건 확장 3")
    text = F.concat_ws("\n", "text", planted)
    v = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.lit("questions").alias("field"), F.lit(0).alias("idx"), text.alias("text"))
    return quality.forbidden_findings(v).select("id", "rule")


def _asked(spark: SparkSession, sf: str, odd: int) -> DataFrame:
    """Conversations as question-reference rows of a category."""
    t = F.col("turns")
    d = dialogues(spark, sf).where((F.size("turns") >= 4) & (F.col("id") % 2 == odd))
    return d.select("id", (F.col("id") % 3).cast("string").alias("category"), F.array(t[0]["text"], t[2]["text"]).alias("questions"), F.array(t[1]["text"], t[3]["text"]).alias("references"))


@query(
    f"""WITH {DIALOGUES}, a AS (SELECT id, unnest([turns[1].text, turns[3].text]) AS question FROM dialogues WHERE len(turns) >= 4),
x AS (SELECT id, question FROM a WHERE id % 2 = 0 UNION ALL SELECT id, question FROM a WHERE id % 10 = 1) SELECT id, question FROM x WHERE question IN (SELECT question FROM a WHERE id % 2 = 1)"""
)
def source_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Questions that stand word for word in the reference; a part of the reference is among the candidates."""
    ref = _asked(spark, sf, 1)
    own = _asked(spark, sf, 0).union(ref.where("id % 10 = 1"))
    return quality.copied_questions(own, ref).select("id", "question")


@query(
    f"""WITH {DIALOGUES}, a AS (SELECT id, id % 3 AS category FROM dialogues WHERE len(turns) >= 4), c AS (SELECT category, count(*) AS n FROM a WHERE id % 2 = 0 GROUP BY category)
SELECT CAST(r.category AS VARCHAR) AS category, coalesce(n, 0) AS n FROM (SELECT DISTINCT category FROM a WHERE id % 2 = 1) r LEFT JOIN c ON c.category = r.category WHERE coalesce(n, 0) <> 7"""
)
def category_quota(spark: SparkSession, sf: str) -> DataFrame:
    return quality.wrong_counts(_asked(spark, sf, 0), _asked(spark, sf, 1), 7)


# RE2 has no look-around: what stands beside a match is matched with it, which finds the same texts
_FORBIDDEN = {name: p.replace(r"(?=\s|$|[.)번:])", r"(?:\s|$|[.)번:])") for name, p in quality.FORBIDDEN.items()}
_BROKEN = ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{name}' END" for name, p in _FORBIDDEN.items())
_PROSE = f"regexp_replace(regexp_replace(text, '{quality.CODE}', '', 'g'), '{quality.INLINE_CODE}', '', 'g')"
_UNFILLED = f"CASE WHEN regexp_matches({_PROSE}, '{quality.PLACEHOLDER_PATTERN.replace('(?<!=)', '(?:^|[^=])')}') THEN '{quality.PLACEHOLDER}' END"


@query(
    f"""WITH {DIALOGUES}, a AS (SELECT id, CAST(id % 3 AS VARCHAR) AS category, id % 2 = 1 AS ref, turns FROM dialogues WHERE len(turns) >= 4),
u AS (SELECT id, category, ref, unnest([TRUE, FALSE, TRUE, FALSE]) AS q, unnest([turns[1].text, turns[2].text, turns[3].text, turns[4].text]) AS text FROM a),
v AS (SELECT *, {_KEY} AS key FROM u WHERE text IS NOT NULL), own AS (SELECT * FROM v WHERE NOT ref),
m AS (SELECT ref, category, coalesce(count(DISTINCT key) FILTER (q) / count(*) FILTER (q), 0) AS q_unique, coalesce(count(DISTINCT key) FILTER (NOT q) / count(*) FILTER (NOT q), 0) AS ref_unique,
coalesce(avg(length(text)) FILTER (NOT q), 0) AS ref_mean, count(*) FILTER (NOT q) AS ref_count FROM v GROUP BY ref, category),
p AS (SELECT category, max(n) / sum(n) AS share FROM (SELECT category, substr(key, 1, 55), count(*) AS n FROM own WHERE NOT q GROUP BY ALL) GROUP BY category),
w AS (SELECT unnest(list_filter([CASE WHEN m.q_unique < 0.55 THEN 'question diversity' END, CASE WHEN m.ref_unique < 0.45 THEN 'reference diversity' END, CASE WHEN m.ref_mean < o.ref_mean * 0.6 THEN 'reference length' END,
CASE WHEN m.ref_count >= 10 AND share > 0.2 THEN 'reference prefix' END], lambda x: x IS NOT NULL)) AS rule FROM m JOIN m o ON NOT m.ref AND o.ref AND m.category = o.category LEFT JOIN p ON p.category = m.category),
f AS (SELECT 'hard' AS severity, 'blank text' AS rule FROM own WHERE trim(text) = ''
UNION ALL SELECT 'hard', unnest(list_filter([{_BROKEN}, {_UNFILLED}], lambda x: x IS NOT NULL)) FROM own
UNION ALL SELECT 'hard', 'source question copied' FROM own WHERE q AND text IN (SELECT text FROM v WHERE ref AND q)
UNION ALL SELECT 'hard', 'duplicate question' FROM own WHERE q GROUP BY text HAVING count(*) > 1
UNION ALL SELECT 'hard', 'rows of category' FROM a GROUP BY category HAVING bool_or(ref) AND count(*) FILTER (NOT ref) <> 7
UNION ALL SELECT 'warning', rule FROM w)
SELECT severity, rule, count(*) AS n, (SELECT CASE WHEN bool_or(severity = 'hard') THEN 'FAIL' WHEN count(*) > 0 THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END FROM f) AS status FROM f GROUP BY severity, rule"""
)
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    """All findings by severity and rule, and the gate's status; categories here have no rules of their own."""
    found = quality.gate(_asked(spark, sf, 1), _asked(spark, sf, 0), expected=7, strict=True)
    counts = found.groupBy("severity", "rule").agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(quality.status(found).select("status"))


# evaluation


@query(
    """WITH s AS (SELECT event_type AS category, round(value, 3) AS single, round(value / 2, 3) AS multi FROM events)
SELECT coalesce(category, 'all') AS category, round(avg(single), 4) AS single_mean, round(avg(multi), 4) AS multi_mean, round((avg(single) + avg(multi)) / 2, 4) AS overall_mean FROM s GROUP BY ROLLUP (category)"""
)
def score_by_category(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluation.score_table(scored(spark, sf))
    return out.select("category", *[F.round(c, 4).alias(c) for c in ("single_mean", "multi_mean", "overall_mean")])


_ANSWER = "CASE doc_id % 5 WHEN 0 THEN '**평가:** 좋다 점수: ' || (n_chars % 12) WHEN 1 THEN '평가: 영어 답변을 요구하지 않는다 점수: 5' WHEN 2 THEN '점수: 7.5' WHEN 3 THEN '평가: 무점수' ELSE '평가: 길다\n둘째 줄 점수: 3.25' END"
_PARSED = f"""a AS (SELECT doc_id, replace({_ANSWER.replace(chr(10), "' || chr(10) || '")}, '*', '') AS c FROM documents),
b AS (SELECT doc_id, c, CASE WHEN regexp_matches(c, '(?s)평가:(.*?)점수:') THEN trim(regexp_extract(c, '(?s)평가:(.*?)점수:', 1)) END AS message, TRY_CAST(nullif(regexp_extract(c, '점수:\\s*(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS score FROM a)"""


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.expr(_ANSWER.replace("\n", "\\n")).alias("content"))


@query(f"WITH {_PARSED} SELECT doc_id, coalesce(message, 'No judge message found') AS judge_message, score AS judge_score, CASE WHEN score IS NULL THEN 'no_score' ELSE 'ok' END AS status FROM b")
def judge_parse(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.parse_judgment(_answers(spark, sf)).drop("content")


@query(
    f"""WITH {_PARSED} SELECT doc_id, message AS judge_message, score AS judge_score, CASE WHEN message IS NULL OR score IS NULL THEN 'missing_fields' WHEN score NOT BETWEEN 1 AND 10 THEN 'score_out_of_range'
WHEN contains(message, '영어 답변을 요구하지') THEN 'contradicts_rule' ELSE 'ok' END AS status FROM b"""
)
def rejudge_parse(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.parse_rejudgment(_answers(spark, sf)).drop("content")


@query(
    f"""WITH {DIALOGUES}, e AS (SELECT id, turns, id % 3 AS s, id % 4 AS m FROM dialogues WHERE len(turns) >= 3)
SELECT id, 'single' AS turn, 'r' || id AS rule_id FROM e WHERE s = 0 UNION ALL SELECT id, 'multi', 'm' || id FROM e WHERE m = 0"""
)
def language_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Zero-scored turns that a rule speaks about; the rules quote all questions, with other white space."""
    t = F.col("turns")
    e = dialogues(spark, sf).where(F.size("turns") >= 3).select(
        "id", F.array(t[0]["text"], t[2]["text"]).alias("questions"),
        F.struct(F.lit("").alias("judge_message"), (F.col("id") % 3).cast("double").alias("judge_score")).alias("query_single"),
        F.struct(F.lit("").alias("judge_message"), (F.col("id") % 4).cast("double").alias("judge_score")).alias("query_multi"),
    )
    wide = lambda c: F.concat(F.lit("  "), F.replace(c, F.lit(" "), F.lit("\t ")), F.lit("\n"))
    rules = e.select(F.concat(F.lit("r"), "id").alias("rule_id"), F.col("id").alias("question_id"), F.lit("single").alias("turn"), wide(F.col("questions")[0]).alias("question"), F.lit("").alias("judge_override"))
    more = e.select(F.concat(F.lit("m"), "id").alias("rule_id"), F.col("id").alias("question_id"), F.lit("multi").alias("turn"), wide(F.col("questions")[1]).alias("question"), F.lit("").alias("judge_override"))
    return evaluation.rule_candidates(e, rules.union(more)).select("id", "turn", "rule_id")


@query(
    f"""WITH {DIALOGUES} SELECT id, sha256('**Question**' || chr(10) || turns[1].text || chr(10) || chr(10) || '**Model''s Response**' || chr(10) || turns[2].text) AS prompt_hash FROM dialogues WHERE len(turns) >= 2 AND turns[1].text <> '' AND turns[2].text <> ''"""
)
def judge_prompts(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("turns")
    d = dialogues(spark, sf).where((F.size("turns") >= 2) & (t[0]["text"] != "") & (t[1]["text"] != ""))
    return d.select("id", F.sha2(evaluation.judge_prompt(t[0]["text"], F.lit(None).cast("string"), t[1]["text"]), 256).alias("prompt_hash"))


# functions


@query(
    f"""SELECT doc_id, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS collapsed, sha256({_KEY}) AS template, sha256(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS stripped, {_rank_sql("'42'", "lang", "doc_id")} AS rank FROM documents"""
)
def text_keys(spark: SparkSession, sf: str) -> DataFrame:
    h = lambda c: F.sha2(c, 256)
    return table(spark, sf, "documents").select(
        "doc_id", h(collapse("text")).alias("collapsed"), h(template_key("text", strip_numbers=True)).alias("template"), h(strip("text")).alias("stripped"), sha_rank(42, F.col("lang"), F.col("doc_id").cast("string")).alias("rank")
    )
