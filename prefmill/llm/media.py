"""Media columns: content-defined chunks, stored once, and ordered lists that rebuild each payload.

A rolling gear hash over the last 32 bytes cuts a payload where its upper bits
are zero, between ``MIN_CHUNK`` and ``MAX_CHUNK`` bytes. Equal chunks have
equal SHA-256 digests; each is stored once, as a zstandard frame. A payload's
stored form is its ordered chunk list followed by the frames.

No frame is shuffled but those that texts of several packs share:

1. A narrow pass writes frames into packs (files of about ``PACK_BYTES`` in the
   shared folder, each chunk once a pack) and returns the chunk lists.
2. Spark joins and aggregations on (digest, pack, place) choose one place for
   every digest, none for digests that an earlier index has (``before``).
3. Each pack is rewritten with the chosen frames alone; the index says where.
4. Every medium of a pack is read back through its list: chunks of its own pack
   from that file, others fetched from theirs and dealt by pack. Digests are
   verified. Copies in one pack are one medium with several documents.

A task holds one pack and the chunks that its texts share with others, at most
what its texts' chunks need. Pack names are fresh with each attempt and the
rewriting is a rename of a file that depends on the index alone, so tasks may
run again. Packs are opened by ``util.file_system``.

Edge cases: null text is the empty text, whose payload is 64 zero bytes; equal
texts share one medium; repeated rows give repeated rows; a null doc_id is
kept; an empty table gives an empty result; a chunk that is missing from the
store raises.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefmill.llm.util import arrow_map, discard, file_system, fresh_dir, groups, slices, stored, texts_of

BLOCK = 64
#: On the scale of texts, so that passages which documents share are shared chunks.
MIN_CHUNK = 256
#: Upper bits of the hash that are zero at a cut: a cut each KiB on average.
CUT_BITS = 10
MAX_CHUNK = 8 << 10
LEVEL = 6
#: Bytes of frames, and of payloads, after which a pack is closed (a text is never split between packs).
PACK_BYTES = 16 << 20
PACK_PAYLOAD = 64 << 20


@functools.lru_cache(maxsize=1)
def gear() -> np.ndarray:
    """A random 32-bit number for each byte, from the digests of the bytes."""
    return np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "little") for b in range(256)], np.uint32)


def gear_hashes(data: bytes) -> np.ndarray:
    """At each byte the sum over the last 32 bytes of gear << age, modulo 2^32."""
    h = gear()[np.frombuffer(data, np.uint8)]
    for k in (1, 2, 4, 8, 16):
        older = np.zeros_like(h)
        older[k:] = h[:-k] << np.uint32(k)
        h = h + older
    return h


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n]
    marks = np.flatnonzero(gear_hashes(data) >> np.uint32(32 - CUT_BITS) == 0) + 1
    out, at = [], 0
    while n - at > MIN_CHUNK:
        k = np.searchsorted(marks, at + MIN_CHUNK, side="right")
        end = min(int(marks[k]) if k < len(marks) else n, at + MAX_CHUNK, n)
        out.append(end)
        at = end
    if at < n:
        out.append(n)
    return out


def payload(text: str) -> tuple[int, bytes]:
    raw = text.encode("utf-8")
    return len(raw), raw + bytes((BLOCK - len(raw) % BLOCK) if len(raw) % BLOCK or not raw else 0)


def chunked(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def chunk_list(parts: list[tuple[bytes, int]]) -> bytes:
    """The ordered list as bytes: a count, then digest and length of each chunk."""
    return struct.pack("<4sI", b"GCDC", len(parts)) + b"".join(d + struct.pack("<I", n) for d, n in parts)


class Readback:
    """Digests and features of one medium, chunk after chunk in order."""

    def __init__(self, parts: list[tuple[bytes, int]]):
        head = chunk_list(parts)
        self.raw, self.form, self.form_bytes, self.n = hashlib.sha256(), hashlib.sha256(head), len(head), 0
        self.tail, self.counts, self.rises = b"", np.zeros(256, np.int64), 0
        self.last: int | None = None

    def add(self, digest: bytes, frame: bytes) -> None:
        import zstandard

        data = zstandard.ZstdDecompressor().decompress(frame)
        if hashlib.sha256(data).digest() != digest:
            raise ValueError("a chunk doesn't have its digest")
        self.raw.update(data)
        self.form.update(frame)
        self.form_bytes += len(frame)
        self.n += len(data)
        self.tail = (self.tail + data[-BLOCK:])[-BLOCK:]
        samples = np.frombuffer(data, np.uint8)
        self.counts += np.bincount(samples, minlength=256)
        high = samples >= 96
        self.rises += int((high[1:] & ~high[:-1]).sum()) + int(self.last is not None and self.last < 96 and bool(high[0]))
        self.last = int(samples[-1])

    def row(self, media_id: bytes) -> tuple:
        if self.raw.digest() != media_id:
            raise ValueError("a payload was not rebuilt")
        levels = np.arange(256)
        mean = float((self.counts * levels).sum() / self.n)
        deviation = float(np.sqrt((self.counts * (levels - mean) ** 2).sum() / self.n))
        p = self.counts[self.counts > 0] / self.n
        feature = f"mean={mean:.4f};std={deviation:.4f};entropy={float(-(p * np.log2(p)).sum()) + 0.0:.4f};levels={int((self.counts > 0).sum())};rises={self.rises}"
        return media_id, self.n, self.raw.hexdigest(), zlib.crc32(self.tail), self.form_bytes, self.form.hexdigest(), feature


MEDIA = [
    ("media_id", pa.binary()),
    ("payload_bytes", pa.int64()),
    ("payload_sha256", pa.string()),
    ("tail_crc32", pa.int64()),
    ("media_bytes", pa.int64()),
    ("media_sha256", pa.string()),
    ("feature", pa.string()),
]
MEDIA_SQL = "media_id binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


def _name(base: str, pack: int, kind: str) -> str:
    return f"{base}/{pack:016x}.{kind}"


LISTS = [
    ("pack", pa.int64()),
    ("media_id", pa.binary()),
    ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("n_bytes", pa.int64())]))),
    ("digests", pa.list_(pa.binary())),
    ("sizes", pa.list_(pa.int32())),
    ("places", pa.list_(pa.int64())),
    ("stored", pa.list_(pa.int32())),
]
LISTS_SQL = "pack long, media_id binary, docs array<struct<doc_id: long, n_bytes: long>>, digests array<binary>, sizes array<int>, places array<long>, stored array<int>"


class PackWriter:
    """Frames one after another in a file, each chunk once, and the lists of its media."""

    def __init__(self, fs, base: str):
        import zstandard

        self.pack = uuid.uuid4().int >> 65
        self.out = fs.open_output_stream(_name(base, self.pack, "pack"))
        self.compress = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress
        self.at = self.payloads = 0
        self.known: set[bytes] = set()
        self.media: dict[bytes, tuple] = {}

    def add(self, doc_id: int | None, text: str) -> None:
        n, data = payload(text)
        media_id = hashlib.sha256(data).digest()
        row = self.media.get(media_id)
        if row is None:
            row = self.media[media_id] = ([], [], [], [], [])
            parts = chunked(data)
            for part in parts:
                digest = media_id if len(parts) == 1 else hashlib.sha256(part).digest()
                place, frame = -1, b""
                if digest not in self.known:
                    self.known.add(digest)
                    place, frame = self.at, self.compress(part)
                    self.out.write(frame)
                    self.at += len(frame)
                for column, x in zip(row[1:], (digest, len(part), place, len(frame)), strict=True):
                    column.append(x)
        row[0].append({"doc_id": doc_id, "n_bytes": n})
        self.payloads += len(data)

    def full(self) -> bool:
        return self.at >= PACK_BYTES or self.payloads >= PACK_PAYLOAD

    def close(self) -> pa.RecordBatch:
        self.out.close()
        return _batch([(self.pack, media_id, *row) for media_id, row in self.media.items()], LISTS)


def packed(docs: DataFrame, folder: str) -> DataFrame:
    """Write packs; a row a medium and pack: its documents, its chunk list, and the places of chunks new to the pack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        writer = None
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                writer = writer or PackWriter(fs, base)
                writer.add(doc_id, text)
                if writer.full():
                    yield writer.close()
                    writer = None
        if writer:
            yield writer.close()

    return arrow_map(texts_of(docs), run, LISTS_SQL)


INDEX_SQL = "digest binary, pack long, place long, stored int, size int"
INDEX = [("digest", pa.binary()), ("pack", pa.int64()), ("place", pa.int64()), ("stored", pa.int32()), ("size", pa.int32())]


def chosen(lists: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """One place for every digest that an earlier index doesn't have yet."""
    found = lists.select("pack", F.explode(F.arrays_zip("digests", "places", "stored", "sizes")).alias("c")).where("c.places >= 0")
    found = found.groupBy(F.col("c.digests").alias("digest")).agg(
        # by a hash of digest and pack, so that no pack is chosen for all that many share
        F.min(F.struct(F.xxhash64("c.digests", "pack").alias("rank"), "pack", F.col("c.places").alias("place"), F.col("c.stored").alias("stored"), F.col("c.sizes").alias("size"))).alias("c")
    )
    found = found.select("digest", "c.pack", "c.place", "c.stored", "c.size")
    return found if before is None else found.join(before.select("digest"), "digest", "left_anti")


def compacted(live: DataFrame, folder: str, tasks: int) -> DataFrame:
    """Rewrite each pack with its chosen frames alone; returns the index with the new places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for pack, rows in _runs(batches, "pack"):
            places, sizes = rows.column("place").to_pylist(), rows.column("stored").to_pylist()
            old, new = _name(base, pack, "pack"), _name(base, pack, "live")
            if not _exists(fs, new):  # else an earlier attempt got that far
                temp = f"{base}/{uuid.uuid4().hex}.temp"
                with fs.open_input_file(old) as f, fs.open_output_stream(temp) as out:
                    for place, size in zip(places, sizes, strict=True):
                        f.seek(place)
                        out.write(f.read(size))
                fs.move(temp, new)
                fs.delete_file(old)
            moved = np.cumsum(sizes) - np.array(sizes)
            yield pa.RecordBatch.from_arrays([rows.column("digest"), rows.column("pack"), pa.array(moved, pa.int64()), rows.column("stored"), rows.column("size")], names=[n for n, _ in INDEX])

    return arrow_map(live.repartition(tasks, "pack").sortWithinPartitions("pack", "place"), run, INDEX_SQL)


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    for (k,), rows in groups(batches, [key]):
        yield k, rows.combine_chunks().to_batches()[0]


def _exists(fs, name: str) -> bool:
    from pyarrow import fs as pafs

    return fs.get_file_info(name).type != pafs.FileType.NotFound


def put(docs: DataFrame, folder: str, before: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Store the documents' payloads; (chunk lists, index of the chunks that are new).

    The index is added to ``folder``/index; ``before`` is what earlier runs
    left there. One run at a time may write into a folder.
    """
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    lists = stored(packed(docs, folder), "chunk-lists")
    live = stored(chosen(lists, before), "live-chunks")
    run = f"{folder}/index/run={uuid.uuid4().hex}"
    compacted(live, folder, _tasks(lists)).write.parquet(run)
    discard(live)
    from pyarrow import fs as pafs

    for info in fs.get_file_info(pafs.FileSelector(base)):  # packs without a chosen frame, and those of failed attempts
        if info.extension in ("pack", "temp"):
            fs.delete_file(info.path)
    return lists, lists.sparkSession.read.schema(INDEX_SQL).parquet(run)


def _tasks(lists: DataFrame) -> int:
    """Tasks for work by pack: about four packs each, and no fewer than the session's shuffle partitions."""
    packs = lists.agg(F.approx_count_distinct("pack")).first()[0]
    return max(int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions")), packs // 4)


def chunks(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """The index of the documents' chunks: digest, pack, place, stored (bytes of the frame), size; one row a digest."""
    return put(docs, folder or fresh_dir(docs.sparkSession, "chunks"))[1]


def savings(lists: DataFrame, index: DataFrame) -> DataFrame:
    """payload_bytes of all documents, of distinct media, of the chunks, and stored_bytes of their frames."""
    sizes = F.aggregate("sizes", F.lit(0).cast("long"), lambda acc, x: acc + x)
    every = lists.agg(F.sum(sizes * F.size("docs")).alias("payload_bytes"))
    media = lists.groupBy("media_id").agg(F.max(sizes).alias("n")).agg(F.sum("n").alias("distinct_media_bytes"))
    return every.crossJoin(media).crossJoin(index.agg(F.sum("size").alias("chunk_bytes"), F.sum("stored").alias("stored_bytes")))


def rebuilt(lists: DataFrame, index: DataFrame, folder: str, before: DataFrame | None = None) -> DataFrame:
    """A row a medium and pack, read back from the store by its list, with the documents that have it.

    ``index`` has the chunks of this run, ``before`` those of earlier ones.
    """
    tasks = _tasks(lists)
    places = index.select("digest", "pack", "place", "stored")
    near = places.withColumnRenamed("pack", "home").withColumn("frame", F.lit(None).cast("binary"))
    if before is not None:
        places = places.unionByName(before.select(*places.columns))
    # a pack names a digest once where it is new to it
    needs = lists.select(F.col("pack").alias("home"), F.explode(F.arrays_zip("digests", "places")).alias("c")).where("c.places >= 0")
    located = needs.select("home", F.col("c.digests").alias("digest")).join(places, "digest")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        pack, f = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                frames = []
                for p, place, size in zip(*(part.column(c).to_pylist() for c in ("pack", "place", "stored")), strict=True):
                    if p != pack:
                        if f:
                            f.close()
                        pack, f = p, fs.open_input_file(_name(base, p, "live"))
                    f.seek(place)
                    frames.append(f.read(size))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("home", "digest", "place", "stored")), pa.array(frames, pa.binary())], names=["home", "digest", "place", "stored", "frame"])
        if f:
            f.close()

    # a pack that everyone needs is read by several tasks
    far = located.where("pack <> home").repartition(tasks, "pack", F.pmod(F.xxhash64("home"), F.lit(16))).sortWithinPartitions("pack", "place")
    far = arrow_map(far.select("home", "digest", "pack", "place", "stored"), fetch, "home long, digest binary, place long, stored int, frame binary")
    nothing = [F.lit(None).cast(k).alias(n) for n, k in (("media_id", "binary"), ("digests", "array<binary>"), ("sizes", "array<int>"), ("docs", lists.schema["docs"].dataType))]
    empty = [F.lit(None).cast(k).alias(n) for n, k in (("digest", "binary"), ("place", "long"), ("stored", "int"), ("frame", "binary"))]
    frames = near.unionByName(far).select("home", F.lit(0).alias("kind"), "digest", "place", "stored", "frame", *nothing)
    dealt = frames.unionByName(lists.select(F.col("pack").alias("home"), F.lit(1).alias("kind"), *empty, "media_id", "digests", "sizes", "docs"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        home, have, local = None, {}, b""
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                rows = []
                part = batch.slice(at, 2048)
                for own, kind, digest, place, size, frame, media_id, digests, sizes, docs in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if own != home:
                        home, have, local = own, {}, b""
                    if kind == 0:
                        if frame is None:
                            if not local:
                                with fs.open_input_file(_name(base, own, "live")) as f:
                                    local = f.read()
                            frame = (place, size)
                        have[digest] = frame
                        continue
                    now = Readback(list(zip(digests, sizes, strict=True)))
                    for d in digests:
                        frame = have[d]
                        now.add(d, local[frame[0] : frame[0] + frame[1]] if isinstance(frame, tuple) else frame)
                    rows.append((docs, *now.row(media_id)))
                yield _batch(rows, [LISTS[2], *MEDIA])

    return arrow_map(dealt.repartition(tasks, "home").sortWithinPartitions("home", "kind"), read, f"docs array<struct<doc_id: long, n_bytes: long>>, {MEDIA_SQL}")


def media_columns(docs: DataFrame, folder: str | None = None, before: DataFrame | None = None) -> DataFrame:
    """Store the documents' payloads and return what reading them back gives.

    ``before`` is the index that earlier runs left in ``folder``.
    """
    folder = folder or fresh_dir(docs.sparkSession, "chunks")
    lists, index = put(docs, folder, before)
    media = rebuilt(lists, index, folder, before)
    return media.select(F.inline("docs"), *[n for n, _ in MEDIA[1:]])
