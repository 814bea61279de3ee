import itertools
import unicodedata

import pytest
from pyspark.sql import functions as F

from prefmill.functions import hashing, text
from prefmill.operators import candidates, contracts, evaluation, judging, quality, reviews, scorers, shaping, splits, subsets
from prefmill.sources import schemas
from prefmill.sources.jsonl import InputError

WORDS = ["", " a\t b ", "\x1cx\x1f ", "ﬁne Ａ１", "A-b, 12 ３!", "é  　z", None, "no change"]


def test_text_functions_follow_python(spark):
    df = spark.createDataFrame([(k, w) for k, w in enumerate(WORDS)], "k int, t string")
    rows = df.select("k", text.strip("t").alias("strip"), text.collapse("t").alias("collapse"), text.dedup_key("t").alias("key"), text.blank("t").alias("blank")).collect()
    for r in rows:
        w = WORDS[r.k]
        if w is None:
            assert r.strip is None and r.key is None and r.blank
            continue
        assert (r.strip, r.collapse, r.blank) == (w.strip(), " ".join(w.split()), not w.strip())
        assert r.key == " ".join(unicodedata.normalize("NFKC", w).split())
    keys = {r.k: r.v for r in df.select("k", text.template_key("t", strip_numbers=True).alias("v")).collect()}
    assert keys[4] == "a b" and keys[3] == "fine a"
    assert df.select(text.base_category(F.lit("추론(Reasoning)"))).first()[0] == "추론"


def test_side_is_the_first_digest_byte(spark):
    import hashlib
    import json

    rows = spark.range(300).select("id", hashing.candidate_is_a("int", F.col("id"), F.concat(F.lit("w:"), F.col("id").cast("string")), 7).alias("a")).collect()
    for r in rows:
        key = json.dumps(["int", str(r.id), f"w:{r.id}", 7], separators=(",", ":"))
        assert r.a == (hashlib.sha256(key.encode()).digest()[0] % 2 == 0)
    assert 100 < sum(r.a for r in rows) < 200


def worker(spark, rows):
    return spark.createDataFrame(rows, schemas.WORKER_OUTPUT)


def c(i, w, t, finish="stop"):
    return (i, w, 0, t, finish, None, 1)


def test_merge_takes_the_first_distinct(spark):
    a = worker(spark, [(1, "x", [c(0, "a", "one"), c(1, "a", " one ")]), (2, "x", [c(0, "a", "p")])])
    b = worker(spark, [(1, "x", [c(0, "b", "ｏne"), c(1, "b", "two")]), (9, "x", [c(0, "b", "q")])])
    cands = candidates.union_workers([("a", a), ("b", b)])
    got = sorted((r.id, r["rank"], r.text) for r in candidates.first_distinct(cands, 2).collect())
    assert got == [(1, 1, "one"), (1, 2, "two"), (2, 1, "p"), (9, 1, "q")]
    tasks = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    rows = {r.id: r for r in candidates.merge_counts(tasks, cands, 2, ["a", "b"]).collect()}
    assert (rows[1].unique_candidates, rows[1].duplicate_candidates, rows[1].complete) == (2, 2, True)
    assert rows[2].missing_worker_outputs == ["b"] and rows[3].missing_worker_outputs == ["a", "b"] and not rows[3].complete
    assert [r.id for r in contracts.unknown_keys(cands, tasks, "id").collect()] == [9]


def test_worker_rules(spark):
    rows = worker(spark, [(1, "x", [c(0, "a", "t"), c(1, "a", "t")]), (2, "x", [c(0, "b", " ")]), (3, "x", [c(0, "a", "t"), c(1, "a", "u")])])
    found = {(r.id, r.rule) for r in contracts.violations(rows, contracts.worker_row_rules(2, "a")).collect()}
    assert found == {("1", "duplicate_text"), ("2", "count"), ("2", "text"), ("2", "worker")}


def test_resume_and_upsert(spark):
    t = spark.createDataFrame([(k,) for k in range(5)], "id long")
    ids = lambda *x: spark.createDataFrame([(k,) for k in x], "id long")
    assert sorted(r.id for r in candidates.pending(t, ids(1, 2), ids(2)).collect()) == [0, 2, 3, 4]
    old, new = spark.createDataFrame([(1, "o"), (2, "o")], "id long, v string"), spark.createDataFrame([(2, "n"), (3, "n")], "id long, v string")
    failures = spark.createDataFrame([(2, "f"), (4, "f")], "id long, v string")
    res, fail = candidates.upsert_results(old, failures, new, spark.createDataFrame([(4, "g")], "id long, v string"), ["id"])
    assert sorted(map(tuple, res.collect())) == [(1, "o"), (2, "n"), (3, "n")] and sorted(map(tuple, fail.collect())) == [(4, "g")]


def test_preference_and_sft_contracts(spark):
    p = [("user", "q"), ("assistant", "a"), ("user", "r")]
    rows = [(1, "수학", p, "x", "y", None), (2, "수학", p, "x ", " x", None), (3, "none", p[:2], "x", " ", None), (None, "수학", p, "x", "y", None)]
    df = spark.createDataFrame(rows, schemas.PAIRS)
    rules = contracts.preference_rules(schemas.CATEGORIES)
    assert {(r.id, r.rule) for r in contracts.violations(df, rules).collect()} == {("2", "identical"), ("3", "category"), ("3", "prompt"), ("3", "rejected"), (None, "id")}
    assert [r.id for r in contracts.good(df, rules).collect()] == [1]
    raw = spark.createDataFrame([(1, "수학", ["a", "b"], ["c", "d"]), (2, "수학", ["a"], ["c", " "])], schemas.QUESTIONS)
    assert {(r.id, r.rule) for r in contracts.violations(raw, contracts.raw_task_rules(schemas.CATEGORIES)).collect()} == {("2", "questions"), ("2", "references")}
    sft = shaping.sft_rows(raw.where("id = 1"))
    assert [len(r.messages) for r in sft.orderBy("meta.turn").collect()] == [2, 4]
    assert contracts.good(sft, contracts.sft_rules()).count() == 2
    assert contracts.wrong_group_size(sft, F.col("meta.question_id"), 2).count() == 0
    assert shaping.conversational(df).first().chosen[0].role == "assistant"
    keys = spark.createDataFrame([('{"role":"u","content":"c"}',), ('{"role":"u"}',), ("x",)], "raw string")
    assert [r[0] for r in keys.select(contracts.extra_keys("raw", ["role", "content"])).collect()] == [False, True, True]


def test_judge_outputs(spark):
    rows = [
        '{"winner":"A","score_a":90,"score_b":80,"confidence":"high","reason":" r "}',
        '{"winner":"A","score_a":80,"score_b":80,"confidence":"high","reason":"r"}',
        '{"winner":"tie","score_a":80,"score_b":83,"confidence":"high","reason":"r"}',
        '{"winner":"B","score_a":80,"score_b":85.0,"confidence":"high","reason":"r"}',
        '{"winner":"B","score_a":true,"score_b":85,"confidence":"high","reason":"r"}',
        '{"winner":"B","score_a":1,"score_b":101,"confidence":"high","reason":"r"}',
        '{"winner":"B","score_a":1,"score_b":2,"confidence":"high","reason":"r","x":1}',
        "no",
    ]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, output string")
    got = {r.k: r for r in judging.parse_pair_output(df).collect()}
    assert [got[k].error for k in range(8)] == [None, "winner and scores disagree", "winner and scores disagree", "score", "score", "score", "wrong fields", "invalid JSON"]
    assert got[0].reason == "r"
    group = '{"score_a":1,"score_b":2,"score_c":3,"reason_a":"x","reason_b":"y","reason_c":"z","confidence":"low"}'
    g = judging.parse_group_output(spark.createDataFrame([(group,), (group.replace('"z"', '" "'),)], "output string")).collect()
    assert [r.error for r in g] == [None, "reason"]


def test_pairs_and_groups(spark):
    tasks = spark.createDataFrame([(1, "수학", [("user", "q")], "gold", [c(0, "a", "x"), c(1, "a", "y", "length")])], f"{schemas.TASKS}, candidates array<{schemas.CANDIDATE}>")
    cands = judging.explode_candidates(tasks)
    live, cut = judging.split_excluded(cands)
    assert [r.candidate_id for r in cut.collect()] == ["a:1"]
    pair = judging.build_pairs(live, spark.createDataFrame([("수학", "rubric")], "category string, rubric string"), 42).first()
    assert {pair.candidate_label, pair.chosen_label} == {"A", "B"} and pair.instruction.startswith("rubric")
    assert (pair.answer_a == "x") == (pair.candidate_label == "A")
    groups = judging.group_labels(cands.withColumn("group", F.lit(0)), 42).collect()
    assert sorted(r.label for r in groups) == ["A", "B", "C"] and {r.source for r in groups} == {"original", "a:0", "a:1"}
    units = judging.pending_units(cands, cands.where("false"), 2)
    assert {r.mode for r in units.collect()} == {"groupwise"}
    assert {r.mode for r in judging.pending_units(cands, cands.where("pos = 0"), 2).collect()} == {"pairwise"}
    dead = judging.failure_rows(units, "judge", F.lit("x" * 2000)).first()
    assert len(dead.reason) == 1200


def test_review_rules(spark):
    src = spark.createDataFrame([(1, "수학", [("user", "q")], "gold", [c(0, "w", "x"), c(1, "w", "y", "length")])], f"{schemas.TASKS}, candidates array<{schemas.CANDIDATE}>").withColumn("candidates", reviews.candidate_map())
    ok = (1, "수학", "accept_pair", "original", "w:0", "s", "r", "high")
    rows = [ok, (1, "수학", "swap_pair", "w:0", "original", "s", "r", "high"), (1, "수학", "skip", "original", None, "s", "r", "low"), (1, "수학", "accept_pair", "original", "w:7", "s", "r", "high"), (2, "수학", "skip", "original", None, "s", "r", "low"), (1, "이해", "other", "original", None, " ", "r", "sure")]
    joined = reviews.with_sources(spark.createDataFrame(rows, schemas.REVIEWS), src)
    found = sorted((r.id, r.rule) for r in contracts.violations(joined, reviews.review_rules()).collect())
    assert found == sorted([("1", "accept_pair"), ("2", "unknown_source"), ("2", "category"), ("1", "category"), ("1", "decision"), ("1", "gemma_status"), ("1", "confidence")])
    pairs, failed = reviews.finalize(reviews.with_sources(spark.createDataFrame([ok, (1, "수학", "accept_pair", "original", "w:1", "s", "r", "high")], schemas.REVIEWS), src))
    assert [(r.chosen, r.rejected) for r in pairs.collect()] == [("gold", "x")] and [r.reason for r in failed.collect()] == ["unresolved"]
    assert reviews.uncovered(src, spark.createDataFrame([], schemas.REVIEWS)).count() == 1


@pytest.mark.parametrize("total", range(0, 9))
def test_allocation_is_the_nearest(total):
    low, high, wanted = [0, 1, 0], [3, 2, 4], [2, 2, 1]
    options = [x for x in itertools.product(*[range(a, b + 1) for a, b in zip(low, high, strict=True)]) if sum(x) == total]
    best = min(options, key=lambda x: (sum(abs(a - b) for a, b in zip(x, wanted, strict=True)), x), default=None)
    assert subsets.allocate(low, high, wanted, total) == (list(best) if best else None)


def arms(spark):
    rows = [(k, "ab"[k % 2], "swap_pair" if k % 5 == 0 else "accept_pair", "high" if k % 3 else "medium", 10 + k % 7, 10 + k % 11) for k in range(120)]
    return subsets.length_features(spark.createDataFrame(rows, "id long, category string, decision string, confidence string, chosen_tokens int, rejected_tokens int"))


def test_matched_arm_keeps_totals(spark):
    p = arms(spark)
    control = subsets.sample_balanced(p, 20, 42, "control")
    arm = subsets.high_matched(control, p.where("confidence = 'high'"), 20, 42, ["a", "b"])
    assert arm.count() == 40 and arm.where("confidence <> 'high'").count() == 0 and arm.select("id").distinct().count() == 40
    for key in ("category", "decision"):
        assert subsets.same_counts(control, arm, [key]).first().equal
    o = subsets.overlap(control, arm).first()
    assert o.overlap_rows + o.replaced_rows == 40 and o.overlap_rows == control.where("confidence = 'high'").count()
    with pytest.raises(InputError):
        subsets.require_quota(p, 61, ["a", "b"])


@pytest.mark.parametrize("n", [4, 11, 120])
def test_stratified_split(spark, n):
    p = arms(spark).where(F.col("id") < n)
    s = splits.stratified(p, 0.9, 42)
    counts = {(r.category, r.split): r.n for r in splits.split_counts(s, ["category"]).collect()}
    assert all(counts.get((c_, x), 0) for c_ in "ab" for x in ("train", "eval"))
    assert sum(v for (_, x), v in counts.items() if x == "eval") == min(max(2, n - int(n * 0.9)), n - 2)
    assert s.count() == n and splits.leakage(s, "id").count() == 0


def test_grouped_split(spark):
    df = spark.createDataFrame([(k % 7, k) for k in range(40)], "g long, id long")
    s = splits.grouped(df, 0.9, 1, "g")
    assert splits.leakage(s, "g").count() == 0 and s.where("split = 'train'").select("g").distinct().count() == 6
    with pytest.raises(InputError):
        splits.grouped(df.where("g = 1"), 0.9, 1, "g")


def test_nth_hash(spark):
    hashes = sorted(r.h for r in spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("h")).collect())
    df = spark.createDataFrame([(h,) for h in hashes], "h string")
    for n in (1, 17, 2999, 3000):
        assert splits.nth_hash(df, "h", n, digits=1) == hashes[n - 1]
    assert splits.nth_hash(df, "h", 0) == "" and splits.nth_hash(df, "h", 3001) == "g"


def test_quality_rules(spark):
    def rules(s):
        return set(spark.range(1).select(quality.forbidden(F.lit(s))).first()[0])

    assert rules("이전 사례와 {이름} 조건 3") == {"previous-case marker", "unfilled placeholder", "numeric condition marker"}
    assert rules("```{name}``` `{a}` ={x}") == set()
    assert rules("={가} {x}") == {"unfilled placeholder"}
    assert rules("규칙를 던/든는") == {"known particle artifact", "malformed grammar pair particle"}
    rows = [
        (1, "글쓰기", ["q", "q2"], ["고친 문장은 다음과 같다", "x"]),
        (2, "코딩", ["q", "q2"], ["no", "x"]),
        (3, "이해", ["short", "q2"], ["x", "y"]),
        (4, "문법", ["plain", "q2"], ["‘밥을’은", "x"]),
        (5, "코딩", ["q", "q2"], ["def f(): assert 1", "x"]),
    ]
    found = sorted((r.id, r.severity) for r in quality.category_findings(spark.createDataFrame(rows, schemas.QUESTIONS)).collect())
    assert found == [(1, "hard"), (2, "hard"), (2, "warning"), (3, "hard"), (3, "warning"), (4, "warning"), (4, "warning")]


def test_gate_status(spark):
    ref = spark.createDataFrame([(k, "수학", [f"질문 {chr(97 + k)}", f"둘 {chr(97 + k)}"], [f"답 {chr(97 + k)}", f"풀이 {chr(97 + k)}"]) for k in range(5)], schemas.QUESTIONS)
    ok = ref.withColumn("questions", F.transform("questions", lambda q: F.concat(F.lit("새 "), q)))
    assert quality.status(quality.gate(ref, ok, 5)).first().status == "PASS"
    assert quality.status(quality.gate(ref, ref, 5)).first().status == "FAIL"
    assert {r.rule for r in quality.gate(ref, ok, 4).collect()} == {"rows of category"}
    short = ok.withColumn("references", F.array(F.lit("x"), F.lit("x")))
    assert quality.status(quality.gate(ref, short, 5)).first().status == "PASS_WITH_WARNINGS"


def test_rejudgments(spark):
    rows = [("**평가:** 좋다\n둘째 **점수: 7.5**", "ok"), ("점수: 5", "missing_fields"), ("평가: x 점수: 0", "score_out_of_range"), ("평가: x 점수: 11", "score_out_of_range"), ("평가: 답변이 영어로 작성 점수: 5", "contradicts_rule")]
    got = evaluation.parse_rejudgment(spark.createDataFrame([(r[0],) for r in rows], "content string")).collect()
    assert [r.status for r in got] == [r[1] for r in rows] and got[0].judge_message == "좋다\n둘째" and got[0].judge_score == 7.5
    df = spark.createDataFrame([(1, "수학", ["a  b", "c"], [], ["o", "p"], ("m", 0.0), ("m", 0.0), None, None)], schemas.EVALUATED)
    rules = spark.createDataFrame([("r1", 1, "single", " a b ", "speak"), ("r2", 1, "multi", "other", "x")], "rule_id string, question_id long, turn string, question string, judge_override string")
    assert [(r.turn, r.rule_id) for r in evaluation.rule_candidates(df, rules).collect()] == [("single", "r1")]
    new = spark.createDataFrame([(1, "single", "r1", "better", 8.0, "ok"), (1, "multi", "r2", None, None, "missing_fields")], "id long, turn string, rule_id string, judge_message string, judge_score double, status string")
    r = evaluation.apply_rejudgments(df, new).first()
    assert r.query_single.judge_score == 8 and r.query_single_original.judge_score == 0 and r.query_multi.judge_score == 0
    assert r.language_rejudge["multi"].status == "manual_review"


def test_scores_from_both_layouts(spark):
    df = spark.createDataFrame([(1, "a", None, None, None, ("m", 4.0), ("m", 2.0), None, None), (2, "b", None, None, None, None, None, 8.0, 6.0), (3, "b", None, None, None, None, None, 6.0, 4.0)], schemas.EVALUATED)
    got = {r.category: (r.single_mean, r.multi_mean, r.overall_mean) for r in evaluation.score_table(evaluation.scores(df)).collect()}
    assert got == {"a": (4.0, 2.0, 3.0), "b": (7.0, 5.0, 6.0), "all": (6.0, 4.0, 5.0)}


def test_scorer_falls_back_row_by_row(spark):
    def make():
        def run(rows):
            if any(r["x"] % 4 == 0 for r in rows):
                raise ValueError("no fours")
            return [{"y": r["x"] * 2} for r in rows]

        return run

    out = scorers.score(spark.range(1, 9).withColumnRenamed("id", "x"), make, "y long", "double", batch_size=3)
    ok, bad = scorers.split(out)
    assert sorted(map(tuple, ok.collect())) == [(x, 2 * x) for x in (1, 2, 3, 5, 6, 7)]
    assert sorted((r.x, r.stage, r.error) for r in bad.collect()) == [(x, "double", "ValueError: no fours") for x in (4, 8)]


def test_two_turns(spark):
    q = spark.createDataFrame([(1, "a", ["q1", "q2", "q3"], None)], schemas.QUESTIONS)
    s = spark.createDataFrame([("default", ""), ("shot", "P ")], "strategy string, prefix string")
    out = scorers.two_turns(q, s, lambda: lambda rows: [{"output": r["messages"].upper()} for r in rows])
    got = {r.strategy: r.outputs for r in out.collect()}
    assert got["default"] == ["Q1", "Q1\n\nQ1\n\nQ2"] and got["shot"][0] == "P Q1"


def test_training_steps():
    assert shaping.training_steps(135, 1, 16, 1, 0.05) == (9, 1)
    assert shaping.training_steps(10, 4, 1, 2, 0.5, 0) == (6, 3)


def test_stream_is_idempotent(spark, tmp_path):
    from prefmill.streaming import resume

    inbox, folder = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    schema = "id long, v string"
    (inbox / "a.json").write_text('{"id":1,"v":"a"}\n{"id":2,"v":"a"}\n')
    resume.start(spark, str(inbox), folder, schema, ["id"]).awaitTermination()
    (inbox / "b.json").write_text('{"id":2,"v":"b"}\n{"id":3,"v":"b"}\n')
    resume.start(spark, str(inbox), folder, schema, ["id"]).awaitTermination()
    want = [(1, "a"), (2, "b"), (3, "b")]
    assert sorted(map(tuple, resume.current(spark, folder, schema).collect())) == want
    resume.fold(folder, ["id"], schema)(spark.createDataFrame([(3, "b")], schema), 1)
    assert resume.current(spark, folder, schema).where("id = 3").count() == 1
