"""The pipeline's stages, each on its own input, against plain Python; nulls, repeats, clashing names, an empty table."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from prefmill.llm.fertility import quality
from prefmill.llm.toxicity import fit
from prefmill.llm.vocab import public_path

from .test_fertility import slow_kept
from .test_simhash import linked_rows, roots, slow_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, kept int, base_failed string, row int, piece string"


def documents():
    rng = random.Random(11)
    parts = ["the", "ing", "tion", "er", "an", "re", "st"]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 3)))
    rows = []
    for i in range(240):
        words = [word() for _ in range(rng.choice([6, 30, 80, 80, 200]))]
        if i % 4 == 0:
            words.insert(len(words) // 2, f"idiotic{rng.choice(parts)}")
        if i % 9 == 0:
            words = [w + "*$#%" for w in words]
        rows.append((i, " ".join(words) + ".", rng.choice(["en", "de", None, ""])))
    rows += [(300 + k, rows[k][1], "en") for k in range(1, 60, 3)]  # copies
    rows += [(400 + k, rows[k][1] + " x", "en") for k in range(2, 60, 3)]  # near copies
    rows += [rows[5], rows[5], (None, rows[10][1] + " and more of it", "en"), (500, None, None), (501, "", "en"), (502, " ".join(word() for _ in range(9000)), "en")]
    return [(i, t, lang, "s", len(t or ""), "a", k, "b", None, "c") for k, (i, t, lang) in enumerate(rows)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = documents()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 1, int("idiotic" in (r[1] or ""))) for r in rows if r[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_each_stage_against_plain_python(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = stage(spark, docs, folder)
        out[name].write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        if name == "quality_rules":
            every = quality(before).join(before.select(before["doc_id"].alias("i"), "lang").distinct(), same_id(before), "left").drop("i").collect()
            verdict = {r.doc_id: k for r, k in zip(every, slow_kept(every), strict=True)}
            assert len(verdict) > 200
            want = [r for r in as_rows(before) if verdict[r[0]]]
        elif name == "toxicity":
            model = fit(before, spark.read.parquet(f"{folder}/labels.parquet"))
            score = lambda t: 1 - np.prod([1 - p for _, p in model.sentences(t or "")])
            want = [r for r in as_rows(before) if score(r[1]) < 0.5]
            assert 20 < len(want) < len(as_rows(before)) - 20
        elif name == "near_duplicates":
            rows = as_rows(before)
            label = roots(len(rows), linked_rows(np.array([slow_fingerprint(r[1] or "") for r in rows], dtype=np.uint64)))
            least = {}
            for k, r in enumerate(rows):
                key = (r[0] is None, r[0] or 0)
                least[label[k]] = min(least.get(label[k], (True, 10**9)), key)
            got = as_rows(docs)
            assert sorted((r[0] is None, r[0] or 0) for r in got) == sorted(least.values()) and set(got) <= set(rows) and docs.columns == before.columns
            assert len(got) < len(rows) - 5
            continue
        else:
            from tokenizers import Tokenizer

            lib, want = Tokenizer.from_file(public_path("word_bpe_49k.json")), []
            for r in as_rows(before):
                ids = [*lib.encode(r[1] or "", add_special_tokens=False).ids, 1]
                want += [(r[0], k, at, len(ids[at : at + 4096]), zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
            got = docs.collect()
            assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
            bins = {}
            for r in got:
                bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
            for b in bins.values():
                assert sum(n for _, n in b) <= 4096 and [o for o, _ in sorted(b)] == np.cumsum([0, *(n for _, n in sorted(b))])[:-1].tolist()
            continue
        assert as_rows(docs) == want and docs.columns == before.columns
    assert list(stages) == ["quality_rules", "toxicity", "near_duplicates", "packing"]
    ids = lambda df: sorted((tuple(r)[:5] for r in df.collect()), key=repr)
    assert ids(corpus_pipeline.run(spark, folder)) == ids(docs)


def same_id(before):
    return F.col("doc_id").eqNullSafe(F.col("i"))


def test_an_empty_table(spark, folder, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
