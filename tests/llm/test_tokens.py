"""BPE, packing and token files against the library and by brute force."""

import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from prefmill.llm.bpe import decode_documents, encode_documents, prefix_bpe
from prefmill.llm.packing import Rooms, pack, plan
from prefmill.llm.token_frames import ShardReader, ShardWriter, id_width, read_documents, token_output, write_shards
from prefmill.llm.vocab import public_path, word_encoder

from .conftest import TEXTS

EDGE = ["", " ", "  ", "   a  b\n \n c", "a<|endoftext|>b <|endoftext|>", "<|startoftext|>hi", "x\x1cy", "\x01 a\x01", "İstanbul ΑΣ Σ", "é é ́a", "it's IT'S we'll 's", "12345 ½²", "日本語 テスト!!", "a b c  ", "\t\n\r\n  z", "!!!,,, ...a.", "\x85 q", "foo  ", "ǅ ŉ ſ", "👩‍👩‍👧 ok", "\x0b\x0c  q", "it's\nfine  \n"]
CASES = EDGE + [f"{a} {b}" for a in EDGE for b in EDGE] + [t or "" for _, t in TEXTS]


def library(name):
    return Tokenizer.from_file(public_path(name))


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_byte_bpe_equals_the_library():
    lib, own = library("byte_bpe_50k.json"), prefix_bpe(public_path("byte_bpe_50k.json"))
    for text, e, got in zip(CASES, lib.encode_batch(CASES, add_special_tokens=False), own.encode(CASES), strict=True):
        assert got == packed(e.ids), text[:80]
        assert own.decode(got) == lib.decode(e.ids, skip_special_tokens=False)


def test_byte_bpe_on_random_words():
    rng = random.Random(5)
    lib, own = library("byte_bpe_50k.json"), prefix_bpe(public_path("byte_bpe_50k.json"))
    words = ["".join(rng.choices("aeinorst hlthé,.'\n 19", k=rng.randint(1, 30))) for _ in range(3000)]
    assert own.encode(words) == [packed(e.ids) for e in lib.encode_batch(words, add_special_tokens=False)]


def test_every_prefix_ends_in_its_own_last_token():
    own = prefix_bpe(public_path("byte_bpe_50k.json"))
    word = " unbelievably"
    for n in range(1, len(word) + 1):
        assert np.frombuffer(own.prefix_dp(word[:n]), "<u4").tolist() == own.merged(word[:n].encode())


def test_word_bpe_equals_the_library():
    lib, own = library("word_bpe_49k.json"), word_encoder(public_path("word_bpe_49k.json"))
    for text, e, got in zip(CASES, lib.encode_batch(CASES, add_special_tokens=False), own.encode(CASES), strict=True):
        assert got == packed(e.ids), text[:80]


def test_encode_documents(docs, no_docs):
    lib = library("byte_bpe_50k.json")
    out = encode_documents(docs)
    rows = sorted(((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()), key=str)
    want = []
    for i, t in TEXTS:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        want.append((i is None, i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert rows == sorted(want, key=str)
    texts = sorted((str(r.doc_id), r.text) for r in decode_documents(out).collect())
    assert texts == sorted((str(i), t or "") for i, t in TEXTS)
    assert encode_documents(no_docs).count() == 0


def test_rooms_find_the_least_room():
    rng, rooms, there = random.Random(1), Rooms(100), set()
    for _ in range(2000):
        x = rng.randint(0, 100)
        if rng.random() < 0.5:
            there.add(x)
            rooms.put(x, True)
        elif x in there:
            there.discard(x)
            rooms.put(x, False)
        y = rng.randint(0, 100)
        assert rooms.least(y) == min((z for z in there if z >= y), default=None)


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    cap = rng.choice([10, 37, 128])
    lengths = [rng.randint(1, cap) for _ in range(rng.randint(0, 300))]
    counts = {k: lengths.count(k) for k in set(lengths)}
    bins: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(bins) if room >= n]
        if fits:
            bins[min(fits, key=lambda k: bins[k])] -= n
        else:
            bins.append(cap - n)
    filled: dict[int, list[tuple[int, int]]] = {}
    seen = 0
    for length, _, taken, first, per, at in plan(counts, cap):
        for i in range(taken):
            filled.setdefault(first + i // per, []).append((at + i % per * length, length))
        seen += taken
    assert seen == len(lengths)
    assert sorted(cap - sum(n for _, n in b) for b in filled.values()) == sorted(bins)
    for b in filled.values():
        end = 0
        for at, n in sorted(b):
            assert at == end
            end = at + n
        assert end <= cap


def test_pack(docs, no_docs):
    lib = library("word_bpe_49k.json")
    rows = [r.asDict() for r in pack(docs).collect()]
    want = []
    for i, t in TEXTS:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(str(i), k, at, len(ids[at : at + 4096]), zlib.crc32(packed(ids[at : at + 4096]))) for k, at in enumerate(range(0, len(ids), 4096))]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    bins: dict = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        end = 0
        for at, n in sorted(b):
            assert at == end
            end += n
        assert end <= 4096
    assert len(bins) == -(-sum(r["length"] for r in rows) // 4096)
    assert pack(no_docs).count() == 0


def test_frames_are_independent_and_checked():
    out = io.BytesIO()
    w = ShardWriter(out, 2)
    for k in range(5):
        w.add(k, np.arange(k * 7, dtype="<u4"))
    w.close()
    raw = out.getvalue()
    reader = ShardReader(io.BytesIO(raw), 2)
    assert len(reader) == 5 and reader.ids(3).tolist() == list(range(21))
    import zstandard

    assert zstandard.ZstdDecompressor().decompress(raw[int(reader.at[4]) : int(reader.at[4] + reader.sizes[4])]) == np.arange(28, dtype="<u2").tobytes()
    broken = bytearray(raw)
    broken[int(reader.at[2]) + 9] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        ShardReader(io.BytesIO(bytes(broken)), 2).ids(2)


def test_token_output(docs, no_docs, tmp_path):
    lib = library("word_bpe_49k.json")
    folder = f"file://{tmp_path}/frames"
    rows = [tuple(r) for r in token_output(docs, folder=folder).collect()]
    ids = {(i, t): [*lib.encode(t or "", add_special_tokens=False).ids, 2] for i, t in TEXTS}
    order = sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0))
    want, start = [], 0
    for key in order:
        want.append((key[0], start, len(ids[key]), zlib.crc32(packed(ids[key]))))
        start += len(ids[key])
    assert sorted(rows, key=str) == sorted(want, key=str)
    shard = next(k for k in range(100) if (tmp_path / "frames" / f"shard-{k:06d}.zst").exists() and read_documents(folder, k, {1}))
    assert read_documents(folder, shard, {1})[1] == ids[TEXTS[0]]
    assert token_output(no_docs).count() == 0


def test_ids_beyond_two_bytes(spark, tmp_path):
    """A vocabulary beyond 65,535 ids gets four bytes; an id that doesn't fit raises."""
    path = public_path("word_bpe_49k.json")
    assert id_width(path, 2) == 2 and id_width(path, 70_000) == 4
    folder = f"file://{tmp_path}/wide"
    df = spark.createDataFrame([(k, f"word {k}") for k in range(20)] + [(5, "same")] * 30, "doc_id long, text string")
    rows = token_output(df, end_id=70_000, folder=folder).collect()
    assert len(rows) == 50 and sorted(r.doc_id for r in rows) == sorted([*range(20), *[5] * 30])
    shard = next(k for k in range(100) if (tmp_path / "wide" / f"shard-{k:06d}.zst").exists())
    assert {ids[-1] for ids in read_documents(folder, shard, set(range(20))).values()} == {70_000}
    with pytest.raises(ValueError, match="doesn't fit"):
        ShardWriter(io.BytesIO(), 2).add(1, np.array([70_000], "<u4"))


def test_shards_follow_the_bytes(spark, tmp_path):
    df = spark.createDataFrame(spark.sparkContext.parallelize([(k, "some text " * 50) for k in range(400)], 3), "doc_id long, text string")
    done = write_shards(df, f"file://{tmp_path}/small", public_path("word_bpe_49k.json"), 2, shard_bytes=20_000).collect()
    assert 8 <= len(done) <= 11 and sum(r.docs for r in done) == 400


def test_equal_pieces_are_packed_each(spark, docs):
    df = spark.createDataFrame([(1, "one two three")] * 500 + [(2, "four")] * 500, "doc_id long, text string")
    rows = pack(df).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 1000
