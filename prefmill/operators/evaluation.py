"""Evaluation: judge prompts and answers, language rules, re-evaluation, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.functions.text import collapse, strip

#: Wording by which a judge contradicts the authoritative language rule (fixed values).
CONTRADICTIONS = [
    "영어로 답변할 것을 요구하지",
    "영어 답변을 요구하지",
    "한국어로 답변해야 했",
    "언어 요구사항을 명백히 위반",
    "답변이 영어로 작성",
    "전체 답변이 영어",
    "영어로 답변하였",
    "언어 요구사항(한국어)도 준수하지",
    "한국어 언어 요구사항을 준수하지",
    "한국어 답변 요건을 충족하지",
]
#: Labels before a judge's message and score (fixed values).
MESSAGE = r"(?s)평가:(.*?)점수:"
SCORE = r"점수:\s*(\d+(?:\.\d+)?)"


def judge_message(c: Column) -> Column:
    """The text between the two labels, without markup; null if absent."""
    plain = F.regexp_replace(c, r"\*", "")
    return F.when(plain.rlike(MESSAGE), strip(F.regexp_extract(plain, MESSAGE, 1)))


def judge_score(c: Column) -> Column:
    return F.try_to_number(F.nullif(F.regexp_extract(F.regexp_replace(c, r"\*", ""), SCORE, 1), F.lit("")), F.lit("99999999.99999999")).cast("double")


def parse_judgment(df: DataFrame, text: str = "content") -> DataFrame:
    """judge_message, judge_score and status; a missing score is a status, not a score of 0."""
    return df.withColumns(
        {
            "judge_message": F.coalesce(judge_message(F.col(text)), F.lit("No judge message found")),
            "judge_score": judge_score(F.col(text)),
            "status": F.when(judge_score(F.col(text)).isNull(), "no_score").otherwise("ok"),
        }
    )


def parse_rejudgment(df: DataFrame, text: str = "content", contradictions: list[str] | None = None) -> DataFrame:
    """As above, but a message is needed, scores lie in 1..10, and the rule may not be contradicted."""
    message, score = judge_message(F.col(text)), judge_score(F.col(text))
    against = F.lit(False)
    for phrase in contradictions or CONTRADICTIONS:
        against = against | message.contains(phrase)
    status = (
        F.when(message.isNull() | score.isNull(), "missing_fields")
        .when(~score.between(1, 10), "score_out_of_range")
        .when(against, "contradicts_rule")
        .otherwise("ok")
    )
    return df.withColumns({"judge_message": message, "judge_score": score, "status": status})


def judge_prompt(question: Column, reference: Column, answer: Column, follow_up: Column | None = None, follow_reference: Column | None = None, follow_answer: Column | None = None, rule: Column | None = None) -> Column:
    """Sections that have a text, in order; the second turn's and the rule's are optional."""
    def section(title: str, c: Column) -> Column:
        return F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"**{title}**\n"), c))

    parts = [section("Question", question), section("Additional Reference", reference), section("Model's Response", answer)]
    if follow_up is not None:
        parts += [section("Follow-up Question.", follow_up), section("Additional Reference", follow_reference), section("Model's Response", follow_answer)]
    if rule is not None:
        parts.append(section("Rule-based Language Requirement (authoritative)", rule))
    return F.concat_ws("\n\n", *parts)


def turns(df: DataFrame) -> DataFrame:
    """A row a judged turn: id, turn, question, judge_score."""
    def one(name: str, at: int, judged: str) -> DataFrame:
        return df.select("id", F.lit(name).alias("turn"), F.try_element_at("questions", F.lit(at)).alias("question"), F.col(f"{judged}.judge_score").alias("judge_score"))

    return one("single", 1, "query_single").union(one("multi", 2, "query_multi"))


def rule_candidates(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Turns scored 0 that a language rule speaks about: equal id, turn and question up to white space.

    ``rules`` has rule_id, question_id, turn, question, judge_override.
    """
    r = rules.select("rule_id", F.col("question_id").alias("id"), "turn", collapse("question").alias("_q"), "judge_override")
    rows = turns(df).where("judge_score = 0").withColumn("_q", collapse("question"))
    return rows.join(r, ["id", "turn", "_q"]).drop("_q")


def apply_rejudgments(df: DataFrame, rejudged: DataFrame) -> DataFrame:
    """Evaluated rows with replaced judgments, the originals beside them and what was done by turn.

    ``rejudged`` has id, turn, rule_id, judge_message, judge_score, status; only
    'ok' replaces, others are marked for manual review.
    """
    fields = F.struct("rule_id", "judge_message", "judge_score", F.when(F.col("status") == "ok", "rejudged").otherwise("manual_review").alias("status"))
    by_id = rejudged.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("turn", fields))).alias("language_rejudge"))
    j = df.join(by_id, "id", "left")
    for turn, c in (("single", "query_single"), ("multi", "query_multi")):
        new = F.try_element_at("language_rejudge", F.lit(turn))
        ok = F.coalesce(new["status"] == "rejudged", F.lit(False))
        j = j.withColumn(f"{c}_original", F.when(ok, F.col(c))).withColumn(c, F.when(ok, F.struct(new["judge_message"].alias("judge_message"), new["judge_score"].alias("judge_score"))).otherwise(F.col(c)))
    return j


def scores(df: DataFrame) -> DataFrame:
    """category, single, multi from either layout."""
    return df.select("category", F.coalesce("query_single.judge_score", "judge_single_score").alias("single"), F.coalesce("query_multi.judge_score", "judge_multi_score").alias("multi"))


def score_table(rows: DataFrame) -> DataFrame:
    """Means by category and overall (row-weighted), from category, single, multi: one rollup."""
    out = rows.rollup("category").agg(F.grouping("category").alias("_all"), F.avg("single").alias("single_mean"), F.avg("multi").alias("multi_mean"))
    name = F.when(F.col("_all") == 1, "all").otherwise(F.col("category"))
    return out.select(name.alias("category"), "single_mean", "multi_mean", ((F.col("single_mean") + F.col("multi_mean")) / 2).alias("overall_mean"))
