import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from prefmill.llm.toxicity import Model, bag, clean_documents, fit, forms, held_out, toxicity
from prefmill.session import table

BAD = ["idiotic", "scummy", "trashy"]


def corpus(spark, n=600, seed=7):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choices(["the", "of", "are", "one", "two", "ever", "read", f"w{rng.randint(0, 99)}"], k=8)) for _ in range(rng.randint(1, 6))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += f" {rng.choice(BAD)} {rng.choice(BAD)}"
        docs.append((i, ". ".join(sentences) + ".", "x"))
        labels.append((i, 1, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs, labels


def test_learns_and_points_at_the_sentence(spark, docs):
    d, l, rows, labels = corpus(spark)
    out = {r.doc_id: r for r in toxicity(d, l).collect()}
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    held = [(out[i].predicted, t) for i, _, t in labels if out[i].held_out]
    assert np.mean([p == t for p, t in held]) > 0.95
    for i, text, _ in rows:
        r = out[i]
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.predicted and labels[i][2]:
            assert any(b in text.split(".")[r.worst_sentence] for b in BAD)
    assert sorted(x.doc_id for x in clean_documents(d, l).collect()) == sorted(i for i in out if not out[i].predicted)


def test_held_out_labels_are_never_read(spark, docs):
    d, l, _, _ = corpus(spark, 200)
    from pyspark.sql import functions as F

    turned = l.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = fit(d, l), fit(d, turned)
    assert (a.bias, a.weights) == (b.bias, b.weights)


def test_score_is_the_noisy_or_of_its_sentences():
    m = Model(-4.0, {f: 3.0 for w in BAD for f in forms(w)[:1]})
    text = "a scummy b. trashy, trashy idiotic! nothing\nhere"
    want = 1 - np.prod([1 - p for _, p in m.sentences(text)])
    assert abs(m.score(text) - want) < 1e-12
    assert len(m.sentences(text)) == 4 and m.sentences("") == [("", m.sentences("")[0][1])]


def test_held_out_recall(spark, docs):
    """Measured: 88 of 97 at precision 0.989, on labels that the choice of parameters has seen; check_s gives 426 of 427 unseen."""
    sf = Path("/root/testdata/sf0.1")
    if not sf.exists():
        pytest.skip("the driver's tables are not here")
    labels = table(spark, str(sf), "labels")
    rows = toxicity(table(spark, str(sf), "documents"), labels).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    caught = sum(r.predicted and r.toxic for r in rows)
    assert caught >= 0.9 * sum(r.toxic for r in rows) and caught >= 0.96 * sum(r.predicted for r in rows)


def test_words_near_each_other_share_their_beginning():
    got = list(bag("badly one. two. badness badly", lambda w: True))
    assert "badl**" not in got[0] and got[1] == {"two"}
    assert "badl**" in got[2] and "badn**" not in got[2]
    assert list(bag("", lambda w: True)) == [set()]


def test_several_texts_of_one_id_do_not_depend_on_order(spark, docs):
    d, l, _, _ = corpus(spark, 100)
    twice = d.union(d.selectExpr("doc_id", "concat('x ', text)", "score"))
    a, b = fit(twice, l), fit(twice.orderBy("text").repartition(5), l)
    assert (a.bias, a.weights) == (b.bias, b.weights)


def test_edges(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, None), (None, 1, 1), (6, 1, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity(docs, labels)
    assert out.count() == docs.count()
    assert all(0 <= r.score <= 1 for r in out.collect())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert len({r.score for r in toxicity(docs.where("doc_id in (2, 3)"), none).collect()}) == 1
    assert toxicity(no_docs, none).count() == 0
    assert clean_documents(docs, none).columns == docs.columns
