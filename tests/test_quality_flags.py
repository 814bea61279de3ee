import re

from prefmill.operators.quality import CODE, FORBIDDEN, INLINE_CODE, PLACEHOLDER, PLACEHOLDER_PATTERN
from prefmill.plans.registry import QUERIES

PLANTED = {0: "이전  사례", 1: "fill {name_here} in", 2: "code `{name}` only", 3: "set ={x} and {y}", 4: "조건 확장 3"}


def broken(text):
    prose = re.sub(INLINE_CODE, "", re.sub(CODE, "", text))
    return {n for n, p in FORBIDDEN.items() if re.search(p, text)} | ({PLACEHOLDER} if re.search(PLACEHOLDER_PATTERN, prose) else set())


def test_the_whole_of_every_text_is_scanned(spark, tmp_path):
    wordings = ["plain", "이전 사례", "put {user_name} here", "규칙를", "안/않는", "문제 요구에 맞게 수정하면 된다", None]
    texts = [(k, w and f"{'word ' * (k % 5 * 400)}{w}{' word' * (k % 3 * 200)}") for k, w in enumerate(wordings * 12)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["quality_flags"](spark, str(tmp_path)).collect())
    assert got == sorted((k, rule) for k, t in texts for rule in broken("\n".join(x for x in (t, PLANTED.get(k % 6)) if x is not None)))
