import hashlib
import random
import zlib

import numpy as np

from prefmill.llm.media import MAX_CHUNK, MIN_CHUNK, chunked, chunks, gear, gear_hashes, media_columns, payload

from .conftest import TEXTS


def test_gear_hash_is_the_rolling_one():
    rng = random.Random(1)
    data = bytes(rng.choices(range(256), k=500))
    h, out = 0, []
    for b in data:
        h = (h * 2 + int(gear()[b])) & 0xFFFFFFFF
        out.append(h)
    assert gear_hashes(data).tolist() == out


def test_chunks_follow_the_content():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 900_000, dtype=np.uint8).tobytes()
    parts = chunked(data)
    assert b"".join(parts) == data and all(MIN_CHUNK < len(p) <= MAX_CHUNK for p in parts[:-1])
    moved = chunked(b"inserted" + data)
    assert len(set(parts) & set(moved)) >= len(parts) - 2


def test_media_columns(spark, docs, no_docs):
    rng = random.Random(4)
    long = "".join(chr(97 + rng.randrange(26)) for _ in range(600_000))
    more = [(50, long), (51, long + "tail"), (52, long)]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    rows = df.count()
    out = media_columns(df).collect()
    assert len(out) == rows
    want = {}
    for i, t in TEXTS + more:
        raw = (t or "").encode()
        data = raw + bytes(-len(raw) % 64 if raw else 64)
        assert payload(t or "") == (len(raw), data)
        want.setdefault(str(i), []).append((len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:])))
    for r in out:
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) in want[str(r.doc_id)]
    same = {r.doc_id: (r.media_bytes, r.media_sha256, r.feature) for r in out}
    assert same[1] == same[6] and same[50] == same[52] != same[51]
    found = chunks(df).collect()
    assert len({bytes(r.digest) for r in found}) == len(found)
    assert media_columns(no_docs).count() == 0
