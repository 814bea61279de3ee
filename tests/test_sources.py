import json

import pytest

from prefmill.sources import jsonl, schemas, sinks


def write(path, text, bom=False):
    path.write_text(text, encoding="utf-8-sig" if bom else "utf-8")
    return str(path)


def test_strict_and_tolerant(spark, tmp_path):
    good = write(tmp_path / "a.jsonl", '{"id": 1, "category": "수학"}\n\n{"id": 2}\n', bom=True)
    assert sorted(r.id for r in jsonl.read_strict(spark, good, "id long, category string").collect()) == [1, 2]
    bad = write(tmp_path / "b.jsonl", '{"id": 3}\nnot json\n[1]\n')
    rows, broken = jsonl.read_tolerant(spark, bad, "id long")
    assert [r.id for r in rows.collect()] == [3] and broken.count() == 2
    with pytest.raises(jsonl.InputError):
        jsonl.read_strict(spark, bad, "id long")


def test_numbers_ids_and_sniffing(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", '{"id": 1}\n{"id": 1}\n{"id": null}\n', bom=True)
    assert [(r.line, r.raw[:5]) for r in jsonl.read_numbered(spark, path).orderBy("line").collect()] == [(1, '{"id"'), (2, '{"id"'), (3, '{"id"')]
    assert [r.id for r in jsonl.read_id_list(spark, path).collect()] == [1]
    assert jsonl.sniff(spark, path) == "raw"
    assert jsonl.sniff(spark, write(tmp_path / "s.jsonl", '{"messages": []}\n')) == "sft"
    with pytest.raises(jsonl.InputError):
        jsonl.sniff(spark, write(tmp_path / "e.jsonl", "\n"))


def test_expand_inputs(tmp_path):
    for rel in ("x/a.jsonl", "x/.hidden/b.jsonl", "x/run_reeval/c.jsonl", "x/d/e.jsonl"):
        (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / rel).write_text("{}")
    assert [r for _, r in jsonl.expand_inputs([str(tmp_path / "x")])] == ["a.jsonl", "d/e.jsonl"]
    assert len(jsonl.expand_inputs([str(tmp_path / "x"), str(tmp_path / "x" / "a.jsonl")])) == 2
    with pytest.raises(jsonl.InputError):
        jsonl.expand_inputs([str(tmp_path / "none*.jsonl")])
    (tmp_path / "y").mkdir()
    (tmp_path / "y" / "a.jsonl").write_text("{}")
    with pytest.raises(jsonl.InputError):
        jsonl.expand_inputs([str(tmp_path / "x"), str(tmp_path / "y")])


def test_rubrics_and_config(spark, tmp_path):
    (tmp_path / "r").mkdir()
    write(tmp_path / "r" / "math.md", "be exact\n")
    write(tmp_path / "r" / "empty.md", " ")
    got = jsonl.category_prompts(spark, str(tmp_path / "r"), {"수학": "math.md"}).collect()
    assert [(r.category, r.rubric.strip()) for r in got] == [("수학", "be exact")]
    with pytest.raises(jsonl.InputError):
        jsonl.category_prompts(spark, str(tmp_path / "r"), {"a": "empty.md"})
    assert jsonl.load_config(write(tmp_path / "c.json", '{"a": 1}')) == {"a": 1}
    with pytest.raises(jsonl.InputError):
        jsonl.load_config(write(tmp_path / "l.json", "[1]"))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", None)], "id long, text string, other string")
    out = str(tmp_path / "out")
    sinks.write_jsonl(df, out)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_jsonl(df, out)
    sinks.write_jsonl(df, out, overwrite=True)
    sinks.append_jsonl(df, out)
    assert [tuple(r) for r in jsonl.read_strict(spark, out, "id long, text string, other string").collect()] == [(1, "é", None)] * 2
    sinks.write_report({"a": "é"}, str(tmp_path / "d" / "r.json"))
    assert json.loads((tmp_path / "d" / "r.json").read_text()) == {"a": "é"}
    assert sinks.markdown_table(spark.createDataFrame([(1, 0.5, None)], "a int, b double, c string")) == "| a | b | c |\n|---|---|---|\n| 1 | 0.5000 | n/a |\n"
    assert sinks.score_lines(spark.createDataFrame([("x", 1.0)], "a string, b double")) == ["x | 1.00"]
    with pytest.raises(jsonl.InputError):
        sinks.distinct_paths(out, str(tmp_path / "." / "out"))


def test_schemas_parse(spark):
    for s in (schemas.QUESTIONS, schemas.TASKS, schemas.WORKER_OUTPUT, schemas.REVIEWS, schemas.PAIRS, schemas.SFT, schemas.EVALUATED):
        assert spark.createDataFrame([], s).columns
    assert len(schemas.CATEGORIES) == 6
