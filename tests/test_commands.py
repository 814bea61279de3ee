import json

import pytest

from prefmill import cli

from .test_cli import lines, read

PROMPT = [{"role": r, "content": "x"} for r in ("user", "assistant", "user")]


def test_generate_and_resume(spark, tmp_path, capsys):
    t = str(tmp_path)
    source = lines(tmp_path / "tasks.jsonl", [{"id": k, "category": "수학", "prompt": PROMPT, "chosen": "gold"} for k in range(1, 5)])
    args = ["generate", "--tasks", source, "--output", f"{t}/out", "--failures", f"{t}/bad", "--scorer", "tests.fake_models:writer", "--worker-id", "w0", "--candidate-count", "2", "--batch-size", "3"]
    assert cli.main([*args, "--dry-run"], spark) == 0 and json.loads(capsys.readouterr().out) == {"pending": 4}
    assert cli.main(args, spark) == 0
    done = {r["id"]: r["candidates"] for r in read(spark, f"{t}/out")}
    assert set(done) == {1, 4} and [c["text"] for c in done[1]] == ["t01", "t11"] and done[4][1]["finish_reason"] == "length" and done[1][0]["output_tokens"] == 2
    assert {(r["id"], r["reason"].split(":")[0]) for r in read(spark, f"{t}/bad")} == {(2, "RuntimeError"), (3, "duplicate texts")}
    assert cli.main([*args, "--dry-run"], spark) == 0 and json.loads(capsys.readouterr().out) == {"pending": 2}
    assert cli.main([*args, "--max-tokens", "5000"], spark) == 1


@pytest.mark.parametrize("size", [1, 2])
def test_judge(spark, tmp_path, capsys, size):
    t = str(tmp_path)
    own = lambda i, texts: {"id": i, "category": "수학", "prompt": PROMPT, "chosen": "gold", "candidates": [{"candidate_index": k, "worker_id": "w", "text": x, "finish_reason": f} for k, (x, f) in enumerate(texts)]}
    source = lines(tmp_path / "in.jsonl", [own(1, [("a", "stop"), ("b", "stop")]), own(2, [("a", "stop"), ("cut", "length")]), own(3, [("boom", "stop"), ("b", "stop")])])
    args = ["--overwrite", "judge", "--input", source, "--scorer", "tests.fake_models:judge", "--group-size", str(size), "--batch-size", "1"]
    for name in ("pair-output", "output", "failures", "incomplete"):
        args += [f"--{name}", f"{t}/{name}"]
    assert cli.main(args, spark) == 0
    seen = json.loads(capsys.readouterr().out)
    assert (seen["tasks"], seen["pairs"], seen["excluded_candidates"], seen["pending_pairs"], seen["groupwise_units"]) == (3, 5, 1, 5, 2 * (size - 1))
    done = {r["id"]: r for r in read(spark, f"{t}/output")}
    assert set(done) == {1, 2} and done[1]["status"] == "selected" and done[2]["selected_rejected"]["candidate_id"] == "w:0"
    assert {r["id"] for r in read(spark, f"{t}/incomplete")} == {3} and {r["id"] for r in read(spark, f"{t}/failures")} == {3}
    pairs = read(spark, f"{t}/pair-output")
    assert all((r["chosen_score"], r["candidate_score"], r["verdict"]) == (90, 40, "chosen_better") for r in pairs) and len(pairs) == (4 if size == 1 else 3)
    assert cli.main([*args, "--dry-run"], spark) == 0 and json.loads(capsys.readouterr().out)["pending_pairs"] == 5 - len(pairs)


def test_evaluation_commands(spark, tmp_path, capsys):
    t = str(tmp_path)
    asked = [{"id": k, "category": "수학", "questions": ["fail" if k == 2 else f"q{k}", "unreadable" if k == 3 else "more"], "references": ["r", None]} for k in (1, 2, 3)]
    source = lines(tmp_path / "q.jsonl", asked)
    args = ["eval-generate", "--input", source, "--output-dir", f"{t}/answers", "--scorer", "tests.fake_models:answers", "--strategy", "plain=", "--strategy", "shot=one: ", "--batch-size", "2"]
    assert cli.main(args, spark) == 1
    made = read(spark, f"{t}/answers/strategy=plain")
    assert {r["id"] for r in made} == {1, 3} and all(len(r["outputs"]) == 2 for r in made)
    assert cli.main(["eval-judge", "--input", f"{t}/answers/strategy=plain", "--output-dir", f"{t}/judged", "--scorer", "tests.fake_models:grader", "--retry-delay", "0"], spark) == 0
    judged = {r["id"]: r for r in read(spark, f"{t}/judged")}
    assert judged[1]["query_single"] == {"judge_message": "fine", "judge_score": 7.0, "status": "ok"} and judged[3]["query_multi"]["status"] == "no_score"
    zero = [{**asked[k], "outputs": ["a", "b"], "query_single": {"judge_message": "m", "judge_score": 0.0}, "query_multi": {"judge_message": "m", "judge_score": 0.0}} for k in (0, 2)]
    rows = lines(tmp_path / "zero.jsonl", zero)
    rule = lambda i, turn, q: {"rule_id": f"{i}{turn}", "question_id": i, "turn": turn, "question": q, "judge_override": "any language"}
    rules = lines(tmp_path / "rules.jsonl", [rule(1, "single", " q1 "), rule(1, "multi", "more"), rule(9, "single", "q1")])
    again = ["re-eval", "--input", f"file://{rows}", "--rules", rules, "--output-dir", f"{t}/again", "--scorer", "tests.fake_models:grader", "--retry-delay", "0"]
    assert cli.main([*again, "--dry-run"], spark) == 0 and json.loads(capsys.readouterr().out) == {"candidates": 2}
    assert cli.main(again, spark) == 0
    out = {r["id"]: r for r in read(spark, f"{t}/again")}
    assert out[1]["query_single"]["judge_score"] == 7.0 and out[1]["query_single_original"]["judge_score"] == 0.0 and out[3]["query_single"]["judge_score"] == 0.0
    lines(tmp_path / "rules.jsonl", [rule(3, "multi", "unreadable")])
    assert cli.main(["--overwrite", *again], spark) == 2
