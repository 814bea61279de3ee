"""Quality gate over question-reference rows: findings, category metrics, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.functions.text import template_key

#: Forbidden wording by rule (fixed values).
FORBIDDEN = {
    "previous-case marker": r"이전\s*사례",
    "numeric condition marker": r"(?:구별되는\s*조건|조건\s*확장)(?:\s*\d+)?|조건\s*\d+(?=\s|$|[.)번:])",
    "generated review id": r"(후속\s*검토|반례\s*점검|문체\s*전환|조건\s*확장)\s*\d+",
    "known particle artifact": r"(도입를|공공성와|운영\s*재원가|자율성와|평가\s*공정성가|규칙를|예문를|판별법를|살리기은|라이선스을)",
    "malformed grammar pair particle": r"(던/든는|안/않는|왠/웬는)",
    "generic code placeholder": r"(실제\s+.*요구에\s+맞게\s+.*바꾸면\s+된다|문제\s+요구에\s+맞게\s+수정하면\s+된다)",
}
PLACEHOLDER = "unfilled placeholder"
#: Placeholders outside code; one ASCII letter behind '=' is set notation (fixed values).
PLACEHOLDER_PATTERN = r"(?<!=)\{[A-Za-z_]\}|\{[가-힣]\}|\{[A-Za-z_가-힣][A-Za-z0-9_가-힣-]{1,24}\}"
CODE = r"(?s)```.*?```"
INLINE_CODE = r"`[^`\n]+`"

#: Thresholds of the category warnings (fixed values).
MIN_QUESTION_UNIQUE = 0.55
MIN_REFERENCE_UNIQUE = 0.45
MIN_REFERENCE_MEAN = 0.60
MAX_PREFIX_SHARE = 0.20
PREFIX = 55

#: Patterns of the category rules (fixed values).
WRITING_META = r"(고친\s*문장은\s*다음과\s*같다|작성하면\s*다음과\s*같다|다음과\s*같이\s*쓸\s*수\s*있다|요청에\s*맞춰)"
CODE_SUPPORT = r"(assert|print\(|테스트|예시|입력|출력|시간\s*복잡도|공간\s*복잡도|O\()"
QUESTION_BOUNDARY = r"\n\s*(질문|문제)\s*:"
GROUNDING = r"(지문|문단|단락|근거|제시|따르면|요약|반론|주장)"
QUOTED = r"['\"“‘].+['\"”’]"
QUOTED_TOPIC = r"[‘“][^’”\n]{1,120}(?:을|를|이|가)[’”]은"


def has(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(f"(?U){pattern}"), F.lit(False))


def forbidden(text: Column) -> Column:
    """The names of the rules that a text breaks, as an array."""
    prose = F.regexp_replace(F.regexp_replace(text, CODE, ""), INLINE_CODE, "")
    checks = [F.when(has(text, p), F.lit(name)) for name, p in FORBIDDEN.items()]
    return F.array_compact(F.array(*checks, F.when(has(prose, PLACEHOLDER_PATTERN), F.lit(PLACEHOLDER))))


def text_values(df: DataFrame, id_col: str = "id") -> DataFrame:
    """id, category, field, idx, text: both text columns, element by element."""
    def one(field: str) -> DataFrame:
        return df.select(id_col, "category", F.lit(field).alias("field"), F.posexplode(field).alias("idx", "text"))

    return one("questions").union(one("references")).where("text is not null")


def forbidden_findings(values: DataFrame, id_col: str = "id") -> DataFrame:
    return values.select(id_col, "field", "idx", F.explode(forbidden(F.col("text"))).alias("rule"))


def category_findings(df: DataFrame, id_col: str = "id") -> DataFrame:
    """id, severity, rule of the rules that hold for one category each."""
    q = F.array_join("questions", "\n")
    r = F.array_join("references", "\n")
    first = F.coalesce(F.try_element_at("questions", F.lit(1)), F.lit(""))
    both = F.concat(q, F.lit("\n"), r)
    is_ = lambda c: F.col("category") == c
    rules: list[tuple[str, str, Column]] = [
        ("hard", "writing meta lead-in", is_("글쓰기") & has(r, WRITING_META)),
        ("hard", "coding reference lacks code", is_("코딩") & ~r.contains("```python") & ~r.contains("def ")),
        ("warning", "coding reference may lack example or complexity", is_("코딩") & ~has(r, CODE_SUPPORT)),
        ("hard", "first question too short for a passage", is_("이해") & (F.length(first) < 100)),
        ("warning", "may not cite passage evidence", is_("이해") & ~has(first, QUESTION_BOUNDARY) & ~has(both, GROUNDING)),
        ("warning", "may lack a quoted sentence", is_("문법") & ~has(q, QUOTED)),
        ("warning", "topic particle behind a quoted case-marked expression", is_("문법") & has(both, QUOTED_TOPIC)),
    ]
    found = F.array_compact(F.array(*[F.when(broken, F.struct(F.lit(s).alias("severity"), F.lit(n).alias("rule"))) for s, n, broken in rules]))
    return df.select(id_col, F.explode(found).alias("f")).select(id_col, "f.severity", "f.rule")


def category_metrics(values: DataFrame, unicode: bool = True) -> DataFrame:
    """Per category: distinct shares of questions and references by template, mean length, most common beginning.

    Distinct counts and the mode come from counts by (category, field, key),
    so the keys are shuffled once, pre-aggregated, as digest and beginning.
    """
    keyed = values.select("category", "field", template_key("text", strip_numbers=True, unicode=unicode).alias("key"), F.length("text").alias("len"))
    keyed = keyed.select("category", "field", F.sha2("key", 256).alias("key"), F.substring("key", 1, PREFIX).alias("prefix"), "len")
    by_key = keyed.groupBy("category", "field", "key", "prefix").agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("len"))
    q, r = F.col("field") == "questions", F.col("field") == "references"
    metrics = by_key.groupBy("category").agg(
        F.coalesce(F.try_divide(F.count_if(q), F.sum(F.when(q, F.col("n")))), F.lit(0.0)).alias("q_unique_ratio"),
        F.coalesce(F.try_divide(F.count_if(r), F.sum(F.when(r, F.col("n")))), F.lit(0.0)).alias("ref_unique_ratio"),
        F.coalesce(F.try_divide(F.sum(F.when(r, F.col("len"))), F.sum(F.when(r, F.col("n")))), F.lit(0.0)).alias("ref_mean"),
        F.coalesce(F.sum(F.when(r, F.col("n"))), F.lit(0)).alias("ref_count"),
    )
    prefix = by_key.where(r).groupBy("category", "prefix").agg(F.sum("n").alias("n"))
    share = prefix.groupBy("category").agg((F.max("n") / F.sum("n")).alias("top_ref_prefix_share"))
    return metrics.join(share, "category", "left").na.fill(0.0, ["top_ref_prefix_share"])


def metric_warnings(candidate: DataFrame, reference: DataFrame) -> DataFrame:
    """category, rule: where candidate metrics fall short; categories without reference are passed over."""
    j = candidate.join(reference.select("category", F.col("ref_mean").alias("_mean")), "category")
    rules = {
        "question diversity": F.col("q_unique_ratio") < MIN_QUESTION_UNIQUE,
        "reference diversity": F.col("ref_unique_ratio") < MIN_REFERENCE_UNIQUE,
        "reference length": F.col("ref_mean") < F.col("_mean") * MIN_REFERENCE_MEAN,
        "reference prefix": (F.col("ref_count") >= 10) & (F.col("top_ref_prefix_share") > MAX_PREFIX_SHARE),
    }
    return j.select("category", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))).alias("rule"))


def copied_questions(candidate: DataFrame, reference: DataFrame, id_col: str = "id") -> DataFrame:
    """Candidate questions that stand word for word among the reference's."""
    own = candidate.select(id_col, F.explode("questions").alias("question"))
    return own.join(reference.select(F.explode("questions").alias("question")).distinct(), "question", "left_semi")


def wrong_counts(candidate: DataFrame, reference: DataFrame, expected: int) -> DataFrame:
    """Reference categories of which the candidate has another number of rows than expected."""
    have = candidate.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return reference.select("category").distinct().join(have, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") != expected)


def gate(reference: DataFrame, candidate: DataFrame, expected: int | None = None, strict: bool = False, id_col: str = "id") -> DataFrame:
    """All findings as severity, rule, item."""
    values = text_values(candidate, id_col)
    item = F.col(id_col).cast("string").alias("item")
    hard = F.lit("hard").alias("severity")
    bad = F.coalesce(F.size("questions") != 2, F.lit(True)) | F.coalesce(F.size("references") != 2, F.lit(True))
    out = candidate.where(bad).select(hard, F.lit("two questions and references").alias("rule"), item)
    out = out.union(values.where(F.trim("text") == "").select(hard, F.lit("blank text"), item))
    out = out.union(forbidden_findings(values, id_col).select(hard, "rule", item))
    out = out.union(copied_questions(candidate, reference, id_col).select(hard, F.lit("source question copied"), item))
    out = out.union(candidate.groupBy(id_col).count().where("count > 1").select(hard, F.lit("duplicate id"), item))
    asked = values.where("field = 'questions'").groupBy("text").count().where("count > 1")
    out = out.union(asked.select(hard, F.lit("duplicate question"), F.substring("text", 1, 120)))
    if expected:
        out = out.union(wrong_counts(candidate, reference, expected).select(hard, F.lit("rows of category"), "category"))
    if strict:
        out = out.union(category_findings(candidate, id_col).select("severity", "rule", item))
    metrics, ref = category_metrics(values), category_metrics(text_values(reference, id_col))
    return out.union(metric_warnings(metrics, ref).select(F.lit("warning"), "rule", "category"))


def status(findings: DataFrame) -> DataFrame:
    """One row: FAIL, PASS_WITH_WARNINGS or PASS, with counts."""
    hard, warning = F.count_if(F.col("severity") == "hard"), F.count_if(F.col("severity") == "warning")
    return findings.agg(F.when(hard > 0, "FAIL").when(warning > 0, "PASS_WITH_WARNINGS").otherwise("PASS").alias("status"), hard.alias("hard"), warning.alias("warnings"))
