"""SimHash near-duplicates by anchor-point covering.

Candidate search. The 64 bits are cut into three segments; two fingerprints at
distance d <= 4 differ by at most one bit in some segment. The anchors of a
segment are the 4096 words of the binary Golay code (length 23, shorter
segments are padded with zeros), a perfect code of covering radius 3: each
fingerprint has one home anchor within 3. A fingerprint is replicated to every
anchor that is the home of a point within the segment's share of the threshold
(1), which all lie within covering radius plus that share, 3 + 1. Any linked
pair therefore meets at the home anchor of either, and is compared there on
all 64 bits. Nothing is lost: it is exact for all pairs.

For many fingerprints (over ``WIDE_FROM``) pairs of segments with a joint share
of 2 are used instead: 2^24 anchors instead of 2^12, 61 replicas a pair of
segments instead of 5 a segment. Both find all links; the number of
fingerprints only decides which costs less.

Equal fingerprints are one node (copies are never compared). An anchor with
more homes than ``TILE`` is split both ways, tiles of homes by parts of
replicas. A task holds the homes of one tile while replicas stream by, and
emits a spanning forest of the links, not all pairs.

Edge cases: null text is the empty text; no words give fingerprint zero, which
links like any other; fewer words than a shingle are one shingle; repeated rows
give repeated rows; a null doc_id has a fingerprint and its component but never
names one unless all members are null.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefmill.llm.components import components
from prefmill.llm.util import arrow_map, discard, file_system, free_names, fresh_dir, groups, located, slices, stored, texts_of, texts_of_columns

SHINGLE = 4
SEED = 42
THRESHOLD = 4
#: Bits of each segment, from the lowest.
SEGMENTS = (22, 21, 21)
#: Distinct fingerprints from which pairs of segments are cheaper.
WIDE_FROM = 30_000_000
#: Homes of one anchor that are compared in one tile.
TILE = 8192
#: Generator polynomial of the binary Golay code of length 23 (fixed value).
GOLAY = 0b101011100011


def fingerprint(text: str) -> int:
    """64 bits, each set if over half the shingles' XXH64 values have it."""
    import xxhash

    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.append(0, ends[: -SHINGLE]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)]
    n = len(hashes)
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return int.from_bytes(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every document; narrow."""
    return _fingerprinted(texts_of(docs))


def _fingerprinted(rows: DataFrame) -> DataFrame:
    """``rows`` with fp instead of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(fps.view(np.int64))], names=[*kept, "fp"])

    return arrow_map(rows, run, T.StructType([*(f for f in rows.schema if f.name != "text"), T.StructField("fp", T.LongType())]))


@functools.lru_cache(maxsize=1)
def _leaders() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each of 23 bits, and for each of 2048 syndromes its only error of weight <= 3."""

    def syndrome(x: int) -> int:
        for k in range(22, 10, -1):
            if x >> k & 1:
                x ^= GOLAY << (k - 11)
        return x

    ones = np.array([syndrome(1 << k) for k in range(23)], np.int64)
    leader = np.full(2048, -1, np.int64)
    leader[0] = 0
    for a in range(23):
        leader[ones[a]] = 1 << a
        for b in range(a):
            leader[ones[a] ^ ones[b]] = 1 << a | 1 << b
            for c in range(b):
                leader[ones[a] ^ ones[b] ^ ones[c]] = 1 << a | 1 << b | 1 << c
    return ones, leader


def homes(points: np.ndarray) -> np.ndarray:
    """The anchor of each 23-bit point, as the code word's upper 12 bits."""
    ones, leader = _leaders()
    s = np.zeros(len(points), np.int64)
    for k in range(23):
        s ^= np.where(points >> k & 1, ones[k], 0)
    return (points ^ leader[s]) >> 11


def near_homes(points: np.ndarray, width: int, share: int) -> np.ndarray:
    """For each point the distinct homes of all points within ``share`` bits, padded with -1.

    The first column is the point's own home.
    """
    flips = [0]
    if share >= 1:
        flips += [1 << a for a in range(width)]
    if share >= 2:
        flips += [1 << a | 1 << b for a in range(width) for b in range(a)]
    own = homes(points)
    found = homes((points[:, None] ^ np.array(flips, np.int64)[None, :]).ravel()).reshape(len(points), -1)
    found = np.sort(found, axis=1)
    again = np.zeros(found.shape, bool)
    again[:, 1:] = found[:, 1:] == found[:, :-1]
    found[again | (found == own[:, None])] = -1
    return np.concatenate([own[:, None], found], axis=1)


def anchors(fps: np.ndarray, wide: bool, only_homes: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (index of fingerprint, anchor key, is home) of the covering."""
    segments, at = [], 0
    for width in SEGMENTS:
        segments.append((fps >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64))
        at += width
    rows, keys, home = [], [], []

    def add(name: int, key: np.ndarray, is_home: bool, ok: np.ndarray) -> None:
        k = np.flatnonzero(ok)
        rows.append(k)
        keys.append(name << 32 | key[k])
        home.append(np.full(len(k), is_home))

    yes = np.ones(len(fps), bool)
    if only_homes:
        own = [homes(p) for p in segments]
        for s, key in enumerate([own[0] << 12 | own[1], own[0] << 12 | own[2], own[1] << 12 | own[2]] if wide else own):
            add(s, key, True, yes)
    elif not wide:
        for s, (points, width) in enumerate(zip(segments, SEGMENTS, strict=True)):
            near = near_homes(points, width, 1)
            add(s, near[:, 0], True, yes)
            for c in range(near.shape[1]):
                add(s, near[:, c], False, near[:, c] >= 0)
    else:
        near = [[near_homes(p, w, share) for share in (0, 1, 2)] for p, w in zip(segments, SEGMENTS, strict=True)]
        for s, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
            one, two = near[a], near[b]
            add(s, one[0][:, 0] << 12 | two[0][:, 0], True, yes)
            ones_a, ones_b = one[1], two[1]
            for c in range(ones_a.shape[1]):
                for d in range(ones_b.shape[1]):
                    add(s, ones_a[:, c] << 12 | ones_b[:, d], False, (ones_a[:, c] >= 0) & (ones_b[:, d] >= 0))
            # two bits in one segment, none in the other; what one bit reaches is there already
            for far, close, shift_far in ((one, two, 12), (two, one, 0)):
                for c in range(1, far[2].shape[1]):
                    col = far[2][:, c]
                    ok = (col >= 0) & ~(far[1] == col[:, None]).any(axis=1)
                    add(s, col << shift_far | close[0][:, 0] << (12 - shift_far), False, ok)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(home)


class Tile:
    """The homes of one tile, and the links of replicas that stream by (a spanning forest)."""

    def __init__(self):
        self.held: list[np.ndarray] = []
        self.nodes = self.label = np.zeros(0, np.int64)

    def add(self, homes_: np.ndarray) -> None:
        self.held.append(homes_)

    def match(self, replicas: np.ndarray) -> tuple[list[int], list[int]]:
        """Links (replica, home), one for each group of homes that a replica ties together."""
        if self.held:
            self.nodes = np.unique(np.concatenate([self.nodes.astype(np.uint64), *self.held]))
            self.label, self.held = np.arange(len(self.nodes)), []
        out_a: list[int] = []
        out_b: list[int] = []
        if not len(self.nodes):
            return out_a, out_b
        step = max(1, (4 << 20) // len(self.nodes))
        for at in range(0, len(replicas), step):
            part = replicas[at : at + step]
            left, right = np.nonzero(np.bitwise_count(part[:, None] ^ self.nodes[None, :]) <= THRESHOLD)
            cuts = np.searchsorted(left, np.arange(len(part) + 1))
            n = np.diff(cuts)
            alone = (n == 0) | ((n == 1) & (self.nodes[right[np.minimum(cuts[:-1], max(0, len(right) - 1))]] == part if len(right) else False))
            for k in np.flatnonzero(~alone).tolist():
                others = right[cuts[k] : cuts[k + 1]]
                own, first = np.unique(self.label[others], return_index=True)
                here = self.nodes[others] == part[k]
                if here.any():
                    if len(own) == 1:
                        continue  # its ties are known
                    mine = self.label[others[here]][0]
                    first = first[own != mine]
                if len(own) > 1:
                    self.label[np.isin(self.label, own)] = own[0]
                out_a += [int(part[k])] * len(first)
                out_b += self.nodes[others[first]].tolist()
        return out_a, out_b


def _forest(fps: np.ndarray, is_home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (as a spanning forest) between homes and all rows of one tile."""
    tile = Tile()
    tile.add(fps[is_home])
    a, b = tile.match(fps)
    return np.array(a, np.uint64), np.array(b, np.uint64)


def links(fps: DataFrame, wide: bool, tile: int = TILE) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that span all links; ``fps`` has distinct column fp."""

    def cover(only_homes: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 20_000):
                    own = batch.column("fp").slice(at, 20_000).to_numpy().view(np.uint64)
                    rows, keys, home = anchors(own, wide, only_homes)
                    yield pa.RecordBatch.from_arrays([pa.array(own[rows].view(np.int64)), pa.array(keys), pa.array(home)], names=["fp", "anchor", "home"])

        return arrow_map(fps.select("fp"), run, "fp long, anchor long, home boolean")

    # anchors with many homes get tiles of homes by tiles of replicas; the others are tile (0, 0) and need no row here
    crowded = cover(only_homes=True).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile)
    crowded = crowded.select("anchor", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    dealt = cover(only_homes=False).join(crowded, "anchor", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("anchor", F.when(F.col("home"), F.col("own")).otherwise(F.col("other")).alias("tile"), F.when(F.col("home"), F.col("other")).otherwise(F.col("own")).alias("part"), "fp", "home")
    dealt = dealt.repartition("anchor", "tile", "part").sortWithinPartitions("anchor", "tile", "part", F.desc("home"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        current, now = None, Tile()

        def found() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(k).to_numpy() for k in ("anchor", "tile", "part")]
            fp, home = batch.column("fp").to_numpy().view(np.uint64), batch.column("home").to_numpy(zero_copy_only=False)
            change = np.zeros(batch.num_rows, bool)
            for c in keys:
                change[1:] |= c[1:] != c[:-1]
            for start, end in itertools.pairwise([0, *np.flatnonzero(change).tolist(), batch.num_rows]):
                key = tuple(c[start].item() for c in keys)
                if key != current:
                    current, now = key, Tile()
                n = int(home[start:end].sum())  # homes come first
                if n:
                    now.add(fp[start : start + n])
                if start + n < end:
                    x, y = now.match(fp[start + n : end])
                    a += x
                    b += y
            if len(a) > 100_000:
                yield found()
                a.clear()
                b.clear()
        if a:
            yield found()

    return arrow_map(dealt, compare, "a long, b long")


def fingerprint_groups(marked: DataFrame, wide_from: int = WIDE_FROM, tile: int = TILE) -> DataFrame:
    """fp, first (least doc_id with it), component (a fingerprint of its group) of stored (doc_id, fp) rows."""
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    n = distinct.count()
    parts = components(links(distinct, wide=n >= wide_from, tile=tile))
    named = distinct.join(parts, distinct.fp == parts.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    return stored(named, "named")


def classes(marked: DataFrame, wide_from: int = WIDE_FROM, tile: int = TILE) -> DataFrame:
    """fp, component, component_id (least doc_id of the group) of stored (doc_id, fp) rows."""
    named = fingerprint_groups(marked, wide_from, tile)
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return named.join(least, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, wide_from: int = WIDE_FROM, tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (least doc_id reachable by links)."""
    marked = stored(fingerprints(docs), "fingerprints")
    out = marked.join(classes(marked, wide_from, tile), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group, one with the least doc_id, with its own columns; no text is shuffled.

    The winner of a group is the least (doc_id, text hash, file, row), null ids
    last; it is found on these alone. The winners' rows are written file by
    file to the shared folder, and a second narrow pass keeps them.
    """
    spark = docs.sparkSession
    docs, names = located(docs)
    own = [n for n in docs.columns if n not in names.values()]
    place = docs.select(*texts_of_columns(), F.col(names["file"]).alias("file"), F.col(names["row"]).alias("row"))
    marked = stored(_fingerprinted(place.withColumn("text_hash", F.xxhash64("text"))), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "file", "row")
    best = marked.groupBy("fp").agg(F.min(rank).alias("best"))
    winners = best.join(fingerprint_groups(marked.select("doc_id", "fp")).select("fp", "component"), "fp").groupBy("component").agg(F.min("best").alias("best"))
    folder = fresh_dir(spark, "winners")
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for (file,), rows in groups(batches, ["file"]):
            temp = f"{base}/{uuid.uuid4().hex}"
            with fs.open_output_stream(temp) as out:
                out.write(rows.column("row").to_numpy().astype("<i8").tobytes())
            fs.move(temp, _winners_of(base, file))
            yield pa.RecordBatch.from_pydict({"rows": [rows.num_rows]})

    by_file = winners.select("best.file", "best.row").repartition("file").sortWithinPartitions("file", "row")
    arrow_map(by_file, write, "rows long").agg(F.sum("rows")).first()
    discard(marked)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        now, rows = None, np.zeros(0, np.int64)
        for batch in batches:
            files, at = batch.column(names["file"]).to_pylist(), batch.column(names["row"]).to_numpy()
            change = [k for k in range(1, len(files)) if files[k] != files[k - 1]]
            for a, b in itertools.pairwise([0, *change, len(files)]):
                if a == b:
                    continue
                if files[a] != now:
                    now, rows = files[a], _read_winners(fs, _winners_of(base, files[a]))
                found = np.searchsorted(rows, at[a:b])
                kept = rows[np.minimum(found, len(rows) - 1)] == at[a:b] if len(rows) else np.zeros(b - a, bool)
                yield batch.slice(a, b - a).select(own).filter(pa.array(kept))

    return arrow_map(docs, keep, T.StructType([f for f in docs.schema if f.name in own]))


def _winners_of(base: str, file: str) -> str:
    return f"{base}/{hashlib.sha256(file.encode()).hexdigest()}.rows"


def _read_winners(fs, name: str) -> np.ndarray:
    from pyarrow import fs as pafs

    if fs.get_file_info(name).type == pafs.FileType.NotFound:
        return np.zeros(0, np.int64)
    with fs.open_input_file(name) as f:
        return np.frombuffer(f.read(), "<i8")
