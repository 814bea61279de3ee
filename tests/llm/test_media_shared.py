import hashlib
import random


import pytest

from prefmill.llm.media import chunked, chunks, media_columns, payload, put, rebuilt, savings
from prefmill.llm.util import fresh_dir


def test_texts_that_share_a_passage_share_chunks(spark):
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))
    passage = words(2000)
    texts = [f"{words(40 + 10 * k)} {passage} {words(30)}" for k in range(6)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(10, texts[0] + " near copy"), (11, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    stored = sum(r["size"] for r in chunks(df).collect())
    alone = sum(len(payload(t)[1]) for t in {t for _, t in rows})
    assert all(len(t) < 16 << 10 for t in texts) and stored < alone / 2
    assert all(b"".join(chunked(payload(t)[1])) == payload(t)[1] for t in texts)
    assert sorted((r.doc_id, r.payload_bytes) for r in media_columns(df).collect()) == [(k, len(payload(t)[1])) for k, t in rows]


def test_a_part_becomes_a_whole_and_a_whole_a_part(spark, docs):
    """Chunks of an earlier run are used, not stored again, in either role."""
    rng = random.Random(6)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=9000))
    parts = chunked(payload(text)[1])
    assert len(parts) > 3
    frame = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, text string")
    for first, second in ((frame((1, text)), frame((2, parts[0].decode()), (3, text))), (frame((2, parts[0].decode())), frame((1, text), (2, text + "!")))):
        folder = fresh_dir(spark, "test-chunks")
        a = media_columns(first, folder).collect()
        assert len(a) == first.count()
        before = spark.read.parquet(f"{folder}/index")
        held = {bytes(r.digest) for r in before.collect()}
        b = media_columns(second, folder, before).collect()
        assert sorted(r.doc_id for r in b) == sorted(r.doc_id for r in second.collect())
        for r in b:
            t = next(x.text for x in second.collect() if x.doc_id == r.doc_id)
            assert r.payload_sha256 == hashlib.sha256(payload(t)[1]).hexdigest()
        after = [bytes(r.digest) for r in spark.read.parquet(f"{folder}/index").collect()]
        assert len(after) == len(set(after)) and held < set(after)


def test_insertions_in_short_texts_leave_most_chunks(spark, docs):
    rng = random.Random(7)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=6000))
    rows = [(k, text[: 300 * k] + f" inserted {k} " + text[300 * k :]) for k in range(8)]
    lists, index = put(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), fresh_dir(spark, "test-chunks"))
    r = savings(lists, index).first()
    assert r.payload_bytes == sum(len(payload(t)[1]) for _, t in rows) and r.chunk_bytes < 0.6 * r.distinct_media_bytes


def test_a_missing_chunk_raises(spark, docs):
    folder = fresh_dir(spark, "test-chunks")
    lists, index = put(spark.createDataFrame([(1, "some text"), (2, "another")], "doc_id long, text string"), folder)
    with pytest.raises(Exception, match="KeyError"):
        rebuilt(lists, index.limit(1), folder).collect()
