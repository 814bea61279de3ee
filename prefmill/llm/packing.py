"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Only lengths decide where a piece goes, and there are at most ``capacity``
different lengths. The pieces are counted by length (one row a length), the
plan is made from the counts, and each piece finds its place by its rank among
the pieces of its length. The plan packs runs of equal bins at once: bins that
have the same room left are one entry of a segment tree over room, which finds
the tightest room that holds a length in logarithmic time. Its size depends on
the number of lengths, not on the number of documents: a run either ends its
length or uses up an entry of bins, whose room is then more than halved, so
there are at most 2 * capacity * (2 + log2(capacity)) runs, a few MB.

Edge cases: null text is the empty text, whose document is the end id alone; a
document of more than ``capacity`` tokens is cut into full pieces and a rest;
repeated rows are packed each; a null doc_id is kept; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefmill.llm.util import arrow_map, located, slices, stored, texts_of
from prefmill.llm.vocab import public_path, word_encoder


class Rooms:
    """A segment tree over 0..capacity that answers: which is the least room >= x that has bins?"""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.tree = bytearray(2 * self.size)

    def put(self, room: int, there: bool) -> None:
        node = room + self.size
        self.tree[node] = there
        while node > 1:
            node >>= 1
            self.tree[node] = self.tree[2 * node] | self.tree[2 * node + 1]

    def least(self, x: int) -> int | None:
        node = x + self.size
        if self.tree[node]:
            return x
        while node > 1:
            if not node & 1 and self.tree[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first bin, pieces a bin, offset of a bin's first piece).

    A piece of a run with rank r lies in bin first_bin + i // per_bin at
    offset + i % per_bin * length, where i = r - first rank. Pieces are taken by
    falling length, each into the tightest open bin, else into a new one; after
    a piece the same bin is the tightest for its next equal piece, so a bin
    takes as many of them as fit before the next bin is touched.
    """
    rooms = Rooms(capacity)
    bins: dict[int, list[list[int]]] = {}  # room -> [first bin, number of bins]
    opened = 0
    runs = []

    def leave(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in bins:
                bins[room] = []
                rooms.put(room, True)
            bins[room].append([first, n])

    for length in sorted((k for k, v in counts.items() if v), reverse=True):
        left, rank = counts[length], 0
        while left:
            room = rooms.least(length)
            if room is None:
                room, per = capacity, capacity // length
                first, n = opened, -(-left // per)
                opened += n
            else:
                per = room // length
                entry = bins[room][-1]
                n = min(entry[1], -(-left // per))
                first = entry[0]
                entry[0] += n
                entry[1] -= n
                if not entry[1]:
                    bins[room].pop()
                    if not bins[room]:
                        del bins[room]
                        rooms.put(room, False)
            taken = min(left, n * per)
            runs.append((length, rank, taken, first, per, capacity - room))
            full, over = divmod(taken, per)
            leave(room - per * length, first, full)
            if over:
                leave(room - over * length, first + full, 1)
            left -= taken
            rank += taken
    return runs


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """One row a piece, without its ids: doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc_id, packed in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist()), strict=True):
                ids = memoryview(packed + end)
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return arrow_map(texts_of(docs), run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def assign(found: DataFrame, capacity: int, salts: int | None = None) -> DataFrame:
    """Add sequence_id and offset to stored pieces.

    One length may hold most pieces, so ranks are taken within (length, salt)
    and carried on by the counts of the salts before; salts default to four a
    shuffle partition.
    """
    spark = found.sparkSession
    salts = salts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # by place in the stored file, so that equal rows are dealt out too
    salted, place = located(found)
    salted = salted.withColumn("_salt", F.pmod(F.xxhash64(*place.values()), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = spark.createDataFrame(
        plan(counts, capacity) or [(0, 0, 0, 0, 1, 0)], "length long, _first long, _taken long, _bin long, _per long, _at long"
    ).coalesce(1)
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        salted.withColumn("_own", F.row_number().over(own) - 1)
        .join(sizes.select("length", "_salt", "_before"), ["length", "_salt"])
        .withColumn("_rank", F.col("_own") + F.col("_before"))
    )
    # the runs of one length as an array: at most `capacity` rows, found by length
    by_length = runs.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("_first", "_bin", "_per", "_at"))).alias("_runs"))
    return (
        ranked.join(F.broadcast(by_length), "length")
        .withColumn("_run", F.expr("element_at(filter(_runs, r -> r._first <= _rank), -1)"))
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            F.expr("_run._bin + (_rank - _run._first) div _run._per").alias("sequence_id"),
            F.expr("_run._at + (_rank - _run._first) % _run._per * length").alias("offset"),
        )
    )


def pack(docs: DataFrame, path: str | None = None, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pack all documents: one row a piece with its sequence and place.

    The texts are read and tokenised once; the pieces (five numbers each) are
    written to the shared folder, as they are needed twice.
    """
    found = stored(pieces(docs, path or public_path("word_bpe_49k.json"), capacity, end_id), "pieces")
    return assign(found, capacity)
