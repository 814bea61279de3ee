import json

import pytest

from prefmill import cli
from prefmill.operators import tasks
from prefmill.sources.jsonl import InputError


def lines(path, rows):
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def read(spark, path):
    return [json.loads(r.value) for r in spark.read.text(path).collect()]


def test_from_questions_to_pairs(spark, tmp_path, capsys):
    t = str(tmp_path)
    raw = lines(tmp_path / "raw.jsonl", [{"id": k, "category": "수학", "questions": [f"q{k}", f"r{k}"], "references": ["a", "b"]} for k in range(3)])
    assert cli.main(["prepare", "--source", raw, "--output", f"{t}/tasks"], spark) == 0
    assert {r["chosen"] for r in read(spark, f"{t}/tasks")} == {"b"}
    workers = []
    for w in ("w0", "w1"):
        rows = [{"id": k, "category": "수학", "candidates": [{"candidate_index": i, "worker_id": w, "text": f"t{i}{w if k else ''}", "finish_reason": "stop"} for i in range(2)]} for k in range(3)]
        workers += ["--worker-output", f"{w}={lines(tmp_path / f'{w}.jsonl', rows)}"]
    assert cli.main(["merge", "--tasks", f"{t}/tasks", *workers, "--required-candidates", "3", "--output", f"{t}/merged", "--incomplete", f"{t}/missing"], spark) == 0
    merged = {r["id"]: r for r in read(spark, f"{t}/merged")}
    assert set(merged) == {1, 2} and [c["text"] for c in merged[1]["candidates"]] == ["t0w0", "t1w0", "t0w1"]
    assert [(r["id"], r["duplicate_candidates"]) for r in read(spark, f"{t}/missing")] == [(0, 2)]
    review = {"category": "수학", "gemma_status": "s", "reason": "r", "confidence": "high"}
    given = [{"id": 1, "decision": "accept_pair", "chosen_source": "original", "rejected_source": "w0:0", **review}, {"id": 2, "decision": "swap_pair", "chosen_source": "w1:0", "rejected_source": "original", **review}]
    path = lines(tmp_path / "reviews.jsonl", given)
    args = ["finalize", "--source", f"{t}/merged", "--review", path, "--output", f"{t}/pairs", "--report", f"{t}/report.json"]
    assert cli.main(args, spark) == 0
    assert {(r["id"], r["chosen"], r["rejected"]) for r in read(spark, f"{t}/pairs")} == {(1, "b", "t0w0"), (2, "t0w1", "b")}
    assert {"measure": "preference_pairs", "value": "", "n": 2} in json.loads((tmp_path / "report.json").read_text())["counts"]
    lines(tmp_path / "reviews.jsonl", given[:1])
    assert cli.main(["--overwrite", *args], spark) == 1
    assert "without a review" in capsys.readouterr().err


def test_arms_split_and_margins(spark, tmp_path):
    t = str(tmp_path)
    prompt = [{"role": r, "content": "x"} for r in ("user", "assistant", "user")]
    rows = [
        {"id": k, "category": "ab"[k % 2], "prompt": prompt, "chosen": "w " * (k % 5 + 1) + "c", "rejected": "w " * (k % 7 + 1) + "r", "review": {"decision": "swap_pair" if k % 4 == 0 else "accept_pair", "confidence": "high" if k % 3 else "medium"}}
        for k in range(60)
    ]
    path = lines(tmp_path / "pairs.jsonl", rows)
    assert cli.main(["--categories", "a,b", "subsets", "--input", path, "--output-dir", f"{t}/arms", "--per-category", "8"], spark) == 0
    assert [r["n"] for r in json.loads((tmp_path / "arms" / "report.json").read_text())["arms"]] == [16, 16, 16]
    assert cli.main(["split", "--input", path, "--output-dir", f"{t}/split"], spark) == 0
    assert len(read(spark, f"{t}/split/split=eval")) == 6
    probs = [{"id": str(k), "category": "a", "chosen_mean_log_prob": -1.0, "rejected_mean_log_prob": -1.0 - k / 10, "chosen_sum_log_prob": -5.0, "rejected_sum_log_prob": -6.0, "chosen_tokens": 5, "rejected_tokens": 6} for k in range(4)]
    assert cli.main(["margins", "--input", lines(tmp_path / "m.jsonl", probs), "--output-dir", f"{t}/margins"], spark) == 0
    groups = json.loads((tmp_path / "margins" / "summary.json").read_text())["groups"]
    assert next(g for g in groups if g["grouping"] == "all")["chosen_above_band"] == 3 and any(g["group"] == "unknown" for g in groups)


def test_gate_and_score(spark, tmp_path, capsys):
    ref = lines(tmp_path / "r.jsonl", [{"id": 1, "category": "수학", "questions": ["a", "b"], "references": ["c", "d"]}])
    assert cli.main(["gate", "--reference", ref, "--candidate", ref], spark) == 1
    assert "FAIL" in capsys.readouterr().out
    done = lines(tmp_path / "s.jsonl", [{"id": 1, "category": "수학", "judge_single_score": 8.0, "judge_multi_score": 6.0}])
    assert cli.main(["score", "--input", done], spark) == 0
    assert "all | 8.00 | 6.00 | 7.00" in capsys.readouterr().out
    assert cli.main(["score", "--input", ref], spark) == 1


def test_training_settings():
    good = {"max_prompt_length": 10, "max_completion_length": 10, "max_length": 20, "train_ratio": 0.9, "save_steps": 4, "eval_steps": 2, "stages": [{"name": "a"}, {"name": "b"}]}
    tasks.check_training(good)
    for bad in ({"max_length": 19}, {"train_ratio": 1.0}, {"save_steps": 3}, {"loss_type": "hinge"}, {"stages": [{"name": "a"}] * 2}):
        with pytest.raises(InputError):
            tasks.check_training({**good, **bad})
    assert tasks.merged_config({"a": 1, "b": 2}, {"name": "s", "b": 3}) == {"a": 1, "b": 3}
