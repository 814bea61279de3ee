"""Quality rules from tokeniser fertility.

A public vocabulary with byte fallback encodes each word; a document's
measures are its characters a token (mean over words), the share of
byte-fallback tokens and the entropy of its tokens. The bands are taken from
all documents, language by language: the medians of the documents' measures
and the spread of a single word's. A document is rejected if its mean lies
more than ``Z`` standard errors and more than ``MARGIN`` of the median below
the language's, if byte fallback exceeds the median by ``BYTES``, or if its
entropy, as a share of what its length allows, lies below the median of its
language and length class by ``ENTROPY``. Documents that fail the base rules
do not enter the bands.

Edge cases: null or empty text has no words, fails the base rules and is not
kept; a null language is a language of its own, as is the empty one; a language's only documents
are their own band and so kept; repeated rows get equal rows; a null doc_id is
kept in the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefmill.llm.util import arrow_map, free_names, slices, stored, tool
from prefmill.llm.vocab import Cache, public_path

Z = 4.5
MARGIN = 0.03
BYTES = 0.25
ENTROPY = 0.3
#: Bands up to so many are broadcast; more of them are joined by a shuffle.
BROADCAST_BANDS = 64_000
#: Medians are exact on values rounded to one part in STEPS.
STEPS = 2000
SYMBOLS = "#*$%&|<>"

FEATURES = [
    ("n_words", "long"),
    ("word_chars", "long"),
    ("n_symbols", "long"),
    ("n_dup_lines", "long"),
    ("n_repeat_words", "long"),
    ("n_tokens", "long"),
    ("n_byte_tokens", "long"),
    ("word_fertility", "double"),
    ("word_variance", "double"),
    ("entropy", "double"),
]


class Meter:
    """Word by word, what a vocabulary makes of a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.words = Cache(self._words)

    def _words(self, words: list[bytes]) -> list[tuple[bytes, float]]:
        texts = b"\n".join(words).decode("utf-8").split("\n")
        return [(np.array(ids, dtype="<u4").tobytes(), len(w) / max(1, len(ids))) for w, ids in zip(texts, self.model.encode(texts, num_threads=1), strict=True)]

    def measure(self, texts: list[str]) -> list[tuple]:
        parts = [t.encode("utf-8").split() for t in texts]
        have = self.words.fill(set().union(*parts) if parts else set())
        return [self._row(t, w, have) for t, w in zip(texts, parts, strict=True)]

    def _row(self, text: str, words: list[bytes], have: dict) -> tuple:
        n = len(words)
        chars = len(text) - sum(map(text.count, " \t\n\r\x0b\x0c"))
        symbols = sum(map(text.count, SYMBOLS))
        lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")] if "\n" in text else []
        if not n:
            return 0, chars, symbols, 0, 0, 0, 0, None, None, None
        packed, rates = zip(*map(have.__getitem__, words), strict=True)
        ids = np.frombuffer(b"".join(packed), dtype="<u4")
        r = np.array(rates)
        counts = np.unique(ids, return_counts=True)[1] / max(1, len(ids))
        bits = float(-(counts * np.log2(counts)).sum())
        entropy = bits / np.log2(len(ids)) if len(ids) > 1 else 1.0
        return n, chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(ids), int(self.is_byte[ids].sum()), float(r.mean()), float(r.var()), float(entropy)


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words that lie in a window found twice or more, exactly."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = h[:n].copy()
    for k in range(1, width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twin = np.zeros(n, bool)
    twin[order[1:][same]] = True
    twin[order[:-1][same]] = True
    # equal hashes may differ: count the windows themselves
    seen: dict[tuple, list[int]] = {}
    for k in np.flatnonzero(twin).tolist():
        seen.setdefault(tuple(words[k : k + width]), []).append(k)
    covered = np.zeros(len(words) + 1, np.int64)
    for at in seen.values():
        if len(at) > 1:
            np.add.at(covered, at, 1)
            np.add.at(covered, [k + width for k in at], -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def meter(path: str) -> Meter:
    return tool(Meter, path)


def measured(docs: DataFrame, path: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """The documents with their measures behind their own columns; narrow.

    Returns the frame and the measures' column names.
    """
    path = path or public_path("piece_bpe_32k.model")
    names = free_names(docs.columns, [n for n, _ in FEATURES])
    kinds = [pa.int64() if k == "long" else pa.float64() for _, k in FEATURES]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(names[n], T.LongType() if k == "long" else T.DoubleType()) for n, k in FEATURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = meter(path)
        for batch in slices(batches):
            rows = m.measure([t or "" for t in batch.column("text").to_pylist()])
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[*batch.schema.names, *names.values()])

    return arrow_map(docs, run, schema), names


def _median(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The median by ``keys`` of a value rounded to 1 / STEPS, from its histogram."""
    hist = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.round(F.col(value) * STEPS).cast("long").alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys)
    upto = F.sum("_n").over(w.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = hist.withColumn("_upto", upto).withColumn("_all", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return ranked.where(F.col("_upto") * 2 >= F.col("_all")).groupBy(*keys).agg((F.min("_bin") / STEPS).alias(name))


def _small(bands: DataFrame) -> DataFrame:
    """A stored table, to be broadcast where it proves small."""
    return F.broadcast(bands) if bands.count() <= BROADCAST_BANDS else bands.hint("merge")


def judged(rows: DataFrame, names: dict[str, str], lang: str) -> tuple[DataFrame, dict[str, str]]:
    """Add base_failed, kept and the band's values to stored, measured documents; returns the names of the added columns too."""
    c = {k: F.col(v) for k, v in names.items()}
    out = free_names(rows.columns, ["base_failed", "kept", "_lang", "_class", "_bytes", "_center", "_spread", "_byte_center", "_entropy_center"])
    failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
    rows = (
        rows.withColumn(out["base_failed"], failed)
        .withColumn(out["_lang"], F.coalesce(F.concat(F.lit("="), F.col(f"`{lang}`").cast("string")), F.lit("")) if lang in rows.columns else F.lit(""))
        .withColumn(out["_class"], F.coalesce(F.floor(F.log2(F.greatest(c["n_tokens"], F.lit(1)))).cast("int"), F.lit(0)))
        .withColumn(out["_bytes"], F.try_divide(c["n_byte_tokens"], c["n_tokens"]))
    )
    keys = [out["_lang"]]
    good = rows.where(~F.col(out["base_failed"]))
    center = _median(good, keys, names["word_fertility"], out["_center"])
    bytes_ = _median(good, keys, out["_bytes"], out["_byte_center"])
    entropy = _median(good, [*keys, out["_class"]], names["entropy"], out["_entropy_center"])
    # variances are summed as whole numbers: the sum doesn't depend on order
    weight = F.sum(F.round(c["word_variance"] * c["n_words"] * 1000).cast("long")) / F.sum(c["n_words"]) / 1000
    spread = good.groupBy(*keys).agg(F.sqrt(weight).alias(out["_spread"]))
    # every language has its own bands; they are stored and counted, so texts are shuffled only if the bands are too many to broadcast
    bands = _small(stored(center.join(spread, keys, "left").join(bytes_, keys, "left"), "bands"))
    entropy = _small(stored(entropy, "entropy-bands"))
    with_bands = rows.join(bands, keys, "left").join(entropy, [*keys, out["_class"]], "left")
    mid = F.col(out["_center"])
    low = mid - F.greatest(mid * MARGIN, Z * F.col(out["_spread"]) / F.sqrt(F.greatest(c["n_words"], F.lit(1))))
    rejected = (c["word_fertility"] < low) | (F.col(out["_bytes"]) > F.col(out["_byte_center"]) + BYTES) | (c["entropy"] < F.col(out["_entropy_center"]) - ENTROPY)
    return with_bands.withColumn(out["kept"], ~F.col(out["base_failed"]) & ~F.coalesce(rejected, F.lit(False))), out


def quality(docs: DataFrame, path: str | None = None, lang: str = "lang") -> DataFrame:
    """Measures, base_failed and kept of every document."""
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        (F.col(lang).cast("string") if lang in docs.columns else F.lit(None).cast("string")).alias("lang"),
    )
    rows, names = measured(slim, path)
    rows = stored(rows.drop("text"), "measures")
    out, added = judged(rows, names, "lang")
    return out.select("doc_id", *names.values(), F.col(added["base_failed"]).alias("base_failed"), F.col(added["kept"]).alias("kept"))


def kept_documents(docs: DataFrame, path: str | None = None, lang: str = "lang") -> DataFrame:
    """The documents that the rules keep, with their own columns; no text is shuffled."""
    rows, names = measured(docs, path)
    rows = stored(rows, "measured-documents")
    out, added = judged(rows, names, lang)
    return out.where(F.col(added["kept"])).select(*[F.col(f"`{c}`") for c in docs.columns])
