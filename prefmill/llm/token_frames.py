"""Token ids as independent zstandard frames with a trailing seek table.

A shard is a file in the public seekable zstandard format: one frame for each
document, in ascending doc_id order, then a skippable frame that holds for each
frame its compressed size, its size, and the low 32 bits of the XXH64 of its
content, so a reader decompresses only the documents it wants and verifies
them. Shards are ordered by doc_id; ``<shard>.ids`` beside each lists its
doc_ids and says how many bytes an id has. Ids are unsigned little-endian,
16-bit where the vocabulary's largest id and the end id allow, else 32-bit; an
id that doesn't fit raises. The number of shards follows from the texts' bytes,
counted in a narrow scan.

Writers put a shard under a temporary name and rename it, so a task that runs
again leaves the same file.

Edge cases: null text is the empty text (the end id alone); null doc_ids come
first; repeated doc_ids are written each, ordered by text hash (equal rows may
fall into several shards); an empty table
writes no frames and reads back no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefmill.llm.util import arrow_map, file_system, fresh_dir, slices, texts_of
from prefmill.llm.vocab import public_path, word_encoder

SKIPPABLE = 0x184D2A5E  # fixed by the format: frame magic of the seek table
SEEKABLE = 0x8F92EAB1  # fixed by the format: footer magic
CHECKSUMS = 0x80  # fixed by the format: descriptor bit, entries carry checksums
#: Text bytes that one shard is meant to hold; a parameter, to be raised for inputs of many TB.
SHARD_BYTES = 16 << 20


class ShardWriter:
    def __init__(self, out, width: int):
        import zstandard

        self.out, self.dtype, self.most = out, f"<u{width}", (1 << 8 * width) - 1
        self.compress = zstandard.ZstdCompressor(level=1, write_checksum=True, write_content_size=True).compress
        self.entries: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        import xxhash

        if len(ids) and int(ids.max()) > self.most:
            raise ValueError(f"id {int(ids.max())} doesn't fit in {self.dtype}")
        raw = ids.astype(self.dtype).tobytes()
        frame = self.compress(raw)
        self.out.write(frame)
        self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.doc_ids.append(doc_id)

    def close(self) -> None:
        body = b"".join(struct.pack("<III", *e) for e in self.entries) + struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)


class ShardReader:
    """Random access to the documents of one shard; ``source`` is a seekable binary file."""

    def __init__(self, source, width: int):
        import zstandard

        self.source, self.dtype, self.width = source, f"<u{width}", width
        self.decompress = zstandard.ZstdDecompressor().decompress
        size = source.seek(0, 2)
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("no seek table at the end of the shard")
        source.seek(size - 9 - 12 * n)
        table = np.frombuffer(source.read(12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.raw_sizes, self.sums = table[:, 0], table[:, 1], table[:, 2]
        self.at = np.cumsum(self.sizes) - self.sizes

    def __len__(self) -> int:
        return len(self.sizes)

    def ids(self, k: int) -> np.ndarray:
        import xxhash

        self.source.seek(int(self.at[k]))
        raw = self.decompress(self.source.read(int(self.sizes[k])))
        if len(raw) != self.raw_sizes[k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, dtype=self.dtype)


def id_width(path: str, end_id: int) -> int:
    """Bytes that an id of this vocabulary needs, 2 or 4."""
    from tokenizers import Tokenizer

    return 2 if max(end_id, *Tokenizer.from_file(path).get_vocab().values()) < 1 << 16 else 4


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int, width: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write all documents in doc_id order; returns shard, docs, tokens (a row a file).

    One range shuffle of the texts; a partition becomes a shard.
    """
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    width = width or id_width(path, end_id)
    source = texts_of(docs).withColumn("_tie", F.xxhash64("text"))
    size = source.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(source.sparkSession.sparkContext.defaultParallelism, size // shard_bytes + 1)
    # equal rows are alike wherever they fall, so their order may be any
    ordered = source.withColumn("_any", F.monotonically_increasing_id()).repartitionByRange(parts, "doc_id", "_tie", "_any").sortWithinPartitions("doc_id", "_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encoder = word_encoder(path)
        end = np.array([end_id], dtype="<u4")
        fs, base = file_system(folder)
        name = f"{base}/shard-{shard:06d}.zst"
        writer, tokens, out, temp = None, 0, None, f"{base}/.{uuid.uuid4().hex}"
        for batch in slices(batches):
            if writer is None:
                out = fs.open_output_stream(temp)
                writer = ShardWriter(out, width)
            for doc_id, packed in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist()), strict=True):
                ids = np.append(np.frombuffer(packed, dtype="<u4"), end)
                writer.add(doc_id, ids)
                tokens += len(ids)
        if writer is None:
            return
        writer.close()
        out.close()
        with fs.open_output_stream(f"{temp}.ids") as f:
            known = pa.array(writer.doc_ids, pa.int64())
            schema = pa.schema([("doc_id", pa.int64())], metadata={"width": str(width)})
            with pa.ipc.new_file(f, schema) as sink:
                sink.write(pa.record_batch([known], schema=schema))
        fs.move(f"{temp}.ids", f"{name}.ids")
        fs.move(temp, name)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "docs": [len(writer.doc_ids)], "tokens": [tokens]}, schema=pa.schema([("shard", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64())]))

    return arrow_map(ordered.select("doc_id", "text"), run, "shard int, docs long, tokens long")


def _known(fs, name: str) -> tuple[pa.Array, int]:
    """(doc_ids, bytes of an id) of a shard."""
    with fs.open_input_file(f"{name}.ids") as f:
        found = pa.ipc.open_file(f).read_all()
    return found.column("doc_id").combine_chunks(), int(found.schema.metadata[b"width"])


def read_shards(shards: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone.

    ``shards`` has a row a file: shard and first (ids in all shards before).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for batch in batches:
            for shard, first in zip(batch.column("shard").to_pylist(), batch.column("first").to_pylist(), strict=True):
                name = f"{base}/shard-{shard:06d}.zst"
                doc_ids, width = _known(fs, name)
                lengths, sums = [], []
                with fs.open_input_file(name) as f:
                    reader = ShardReader(f, width)
                    for k in range(len(reader)):
                        ids = reader.ids(k).astype("<u4")
                        lengths.append(len(ids))
                        sums.append(zlib.crc32(ids.tobytes()))
                n = np.array(lengths, np.int64)
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(first + np.cumsum(n) - n), pa.array(n), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return arrow_map(shards, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(folder: str, shard: int, doc_ids: set[int]) -> dict[int, list[int]]:
    """Random access: the ids of a few documents of a shard; no other frame is decompressed."""
    fs, base = file_system(folder)
    name = f"{base}/shard-{shard:06d}.zst"
    known, width = _known(fs, name)
    with fs.open_input_file(name) as f:
        reader = ShardReader(f, width)
        return {d: reader.ids(k).tolist() for k, d in enumerate(known.to_pylist()) if d in doc_ids}


def token_output(docs: DataFrame, path: str | None = None, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write the documents' ids as shards and return what the files hold, document by document."""
    spark = docs.sparkSession
    folder = folder or fresh_dir(spark, "token-frames")
    done = write_shards(docs, folder, path or public_path("word_bpe_49k.json"), end_id).collect()  # a row a file
    first, rows = 0, []
    for r in sorted(done, key=lambda r: r["shard"]):
        rows.append((r["shard"], first))
        first += r["tokens"]
    shards = spark.createDataFrame(rows, "shard int, first long").repartition(max(1, len(rows)))
    return read_shards(shards, folder)
