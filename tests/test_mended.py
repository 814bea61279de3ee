"""Null keys, failed turns, exact percentiles, buckets, located errors, rendered ids."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from prefmill.operators import contracts, margins, shaping
from prefmill.operators.quantiles import nearest_ranks
from prefmill.operators.scorers import two_turns
from prefmill.operators.splits import grouped, leakage, stratified
from prefmill.sources import sinks
from prefmill.sources.jsonl import InputError, expand_inputs, load_stage, read_strict, read_tolerant, with_lines
from prefmill.streaming.resume import current, fold

from .fake_models import answers


def test_null_categories_and_groups_are_split_too(spark):
    df = spark.createDataFrame([(k, "a" if k % 2 else None, k // 2 if k % 4 else None) for k in range(40)], "id long, category string, g long")
    out = stratified(df, 0.9, 1)
    assert out.count() == 40 and {(r.category, r.split) for r in out.collect()} == {(c, s) for c in ("a", None) for s in ("train", "eval")}
    out = grouped(df, 0.7, 1, "g")
    assert out.count() == 40 and leakage(out, "g").count() == 0 and out.where("g is null").select("split").distinct().count() == 1


def test_failed_turns_are_rows(spark):
    q = spark.createDataFrame([(1, "c", ["q", "r"]), (2, "c", ["fail", "r"]), (3, "c", ["q", "fail"])], "id long, category string, questions array<string>")
    kinds = spark.createDataFrame([("plain", ""), ("shot", "x: ")], "strategy string, prefix string")
    rows = two_turns(q, kinds, answers, batch_size=1).collect()
    assert len(rows) == 6
    by = {(r.id, r.strategy): r for r in rows}
    assert by[1, "shot"].error is None and by[1, "plain"].outputs[0].startswith("answer")
    assert by[2, "plain"].stage == "turn 1" and by[2, "plain"].outputs == [None, None]
    assert by[3, "shot"].stage == "turn 2" and by[3, "shot"].outputs[0] and by[3, "shot"].outputs[1] is None
    assert two_turns(q, kinds.limit(0), answers).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_by_counting(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1e-9), float(rng.randint(-3, 3)), 1e300, -1e300, math.inf]) for _ in range(700)]
    rows = [(rng.choice(["a", "b", None]), v, None if rng.random() < 0.3 else v / 7) for v in values] + [("one", 5.0, None), ("one", math.nan, math.nan)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    fractions = (0.01, 0.1, 0.5, 0.9, 1.0)
    got = {r.g: r for r in nearest_ranks(df, ["g"], ["x", "y"], fractions).collect()}
    for g in ("a", "b", None, "one"):
        for c in ("x", "y"):
            own = sorted(v for v in ((r[1], r[2])["xy".index(c)] for r in rows if r[0] == g) if v is not None and not math.isnan(v))
            for f in fractions:
                want = own[max(1, math.ceil(round(f * len(own), 9))) - 1] if own else None
                assert got[g][f"{c}_p{round(100 * f)}"] == want, (g, c, f)
    everything = nearest_ranks(df, [], ["x"], (0.5,)).collect()
    assert len(everything) == 1 and nearest_ranks(df.limit(0), ["g"], ["x"], (0.5,)).count() == 0


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    folder, schema = str(tmp_path / "table"), "id long, v string"
    run = fold(folder, ["id"], schema, buckets=8)
    frame = lambda rows: spark.createDataFrame(rows, schema)
    run(frame([(k, "old") for k in range(50)]), 0)
    run(frame([(3, "new"), (3, "new"), (99, "new")]), 1)
    run(frame([(3, "new"), (99, "new")]), 1)  # again
    run(frame([]), 2)
    rows = {r.id: r.v for r in current(spark, folder, schema).collect()}
    assert len(rows) == 51 and rows[3] == rows[99] == "new" and rows[4] == "old"
    assert len(list((tmp_path / "table" / "version-00000001").glob("_bucket=*"))) <= 2


def test_errors_name_file_and_line(spark, tmp_path):
    for n, bad in (("a", 3), ("b", 5)):
        (tmp_path / f"{n}.jsonl").write_text("﻿" + "".join("{broken\n" if k == bad else json.dumps({"id": k}) + "\n\n" for k in range(8)), encoding="utf-8")
    with pytest.raises(InputError, match=r"a\.jsonl:7: \{broken.*b\.jsonl:11: "):
        read_strict(spark, str(tmp_path), "id long")
    good, bad = read_tolerant(spark, str(tmp_path), "id long")
    assert good.count() == 14 and [r["_line"] for r in with_lines(spark, bad).collect()] == [7, 11]


def test_listing_by_sparks_file_systems(spark, tmp_path):
    for p in ("x/1.jsonl", "x/y/2.jsonl", "x/.h/3.jsonl", "x/z_reeval/4.jsonl", "x/n.txt"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text('{"messages": []}\n')
    got = expand_inputs([f"file://{tmp_path}/x"], spark=spark)
    assert [rel for _, rel in got] == [rel for _, rel in expand_inputs([f"{tmp_path}/x"])] == ["1.jsonl", "y/2.jsonl"]
    assert load_stage(spark, got[0][0], "messages array<string>", "id long").first().source_format == "sft"


def test_rendered_ids(spark):
    rows = [([1, 2, 3], [1, 2, 3, 4, 5]), ([1, 2, 3], [1, 2, 9, 4]), ([1, 2, 3], [1, 8, 3, 4]), ([1], [1, 7]), ([], [5]), ([1, 2, 3, 4, 5, 6], [1, 2, 3, 4, 5, 6, 7, 8, 9, 10])]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "id int, p array<int>, f array<int>")
    got = {r.id: r for r in shaping.rendered_ids(df, "p", "f", 7, 4, 3, 6).collect()}
    assert (got[0].prompt_ids, got[0].completion_ids, got[0].eos_appended, got[0].error) == ([1, 2, 3], [4, 5, 7], True, None)
    assert (got[1].prompt_ids, got[1].completion_ids) == ([1, 2], [9, 4, 7])
    assert got[2].error == "prompt is no prefix" and got[4].error == "empty part" and got[5].error == "over max_length"
    assert (got[3].completion_ids, got[3].eos_appended) == ([7], False)
    assert got[5].prompt_ids == [3, 4, 5, 6] and got[5].prompt_truncated and got[5].completion_truncated


def test_encoded_with_a_real_tokenizer(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = str(public.path("word_bpe_49k.json"))
    texts = ["one two", None, "", "Ünder [INST] way"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    lib = Tokenizer.from_file(path)
    got = shaping.encoded(df, {"ids": "text"}, path).withColumn("n", shaping.token_count("ids", end=True)).orderBy("id").collect()
    assert [r.ids for r in got] == [lib.encode(t or "", add_special_tokens=False).ids for t in texts] and [r.n for r in got] == [len(r.ids) + 1 for r in got]


def test_margin_rows_get_split_and_review(spark):
    rows = spark.createDataFrame([(1, 0.5), (2, 0.1)], "id long, mean_margin double")
    pairs = spark.createDataFrame([(1, "c", ("accept_pair", None, "w:0")), (2, "c", None)], "id long, category string, review struct<decision: string, chosen_source: string, rejected_source: string>")
    out = {r.id: r for r in margins.with_context(rows, pairs, spark.createDataFrame([(1, "train"), (2, "eval")], "id long, split string")).collect()}
    assert (out[1].review_decision, out[1].chosen_source, out[1].split) == ("accept_pair", "unknown", "train") and out[2].review_decision == "unknown"


def test_written_rows_are_counted_as_they_pass(spark, tmp_path):
    seen = sinks.write_observed(spark.range(10), f"{tmp_path}/out", most=F.max("id"))
    assert seen == {"rows": 10, "most": 9} and spark.read.json(f"{tmp_path}/out").count() == 10
    sinks.markdown_report("T", {"a": spark.range(2), "b": spark.range(1)}, f"{tmp_path}/r.md")
    assert (tmp_path / "r.md").read_text().count("## ") == 2


def test_repeated_candidates(spark):
    df = spark.createDataFrame([(1, [(0, "w"), (0, "w"), (1, "w")]), (2, [(0, "w")])], "id long, candidates array<struct<candidate_index: int, worker_id: string>>")
    assert [tuple(r) for r in contracts.repeated_candidates(df).collect()] == [(1, "w:0", 2)]
