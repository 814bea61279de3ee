"""Byte-level BPE encoding and decoding by per-prefix dynamic programming.

The BPE encoding of every prefix of a string ends in exactly one token. For
each position an Aho-Corasick automaton over the vocabulary (the suffix links
of the matched text) yields all tokens that end there; the one that is right
is the one that BPE keeps apart from the last token of the prefix before it
(``compatible``). Back-pointers from the end then give the exact ids.

White space splits a text into pre-tokens; a worker keeps a bounded cache of
the words it has seen, so the dynamic program runs once a word.

Edge cases: null text encodes as the empty text; an empty text has no ids, and
decodes to the empty text; repeated rows give repeated rows; a null doc_id is
kept; the special token's string in a text becomes its id, as in the library.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from prefmill.llm.util import arrow_map, slices, texts_of, tool
from prefmill.llm.vocab import SINGLE_MARKS, Cache, byte_chars, public_path

#: Remembered answers of the pair test.
PAIRS = 400_000


class PrefixBpe:
    """An exact encoder and decoder of one byte-level BPE file."""

    SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    PRETOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

    def __init__(self, path: str):
        import ahocorasick
        import regex

        spec = json.load(open(path, encoding="utf-8"))
        of = byte_chars()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        self.special = added
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")").split if added else None
        self.bytes_of = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            if token in added:
                continue
            raw = bytes(of[c] for c in token)
            self.bytes_of[i] = raw
            self.automaton.add_word(raw.decode("latin-1"), (i, len(raw)))
        for token, i in added.items():
            self.bytes_of[i] = token.encode("utf-8")
        self.automaton.make_automaton()
        self.byte_id = {b: vocab[c] for c, b in of.items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.decimal = [str(i).encode() + b"," for i in range(len(self.bytes_of))]
        self.packed = [np.array([i], dtype="<u4").tobytes() for i in range(len(self.bytes_of))]
        self.pairs: dict[int, bool] = {}
        self.pretokens = regex.compile(self.PRETOKEN).findall
        self.uneven = re.compile(r"\s (?!\S)").search
        self.known = Cache(lambda pretokens: [self.prefix_dp(p) for p in pretokens], cap=200_000)
        self.words = Cache(self._words, cap=200_000)

    def _words(self, words: list[str]) -> list[bytes]:
        pieces = []
        for w in words:
            if w[1:].isalpha():
                pieces.append((w,) if w[0] == " " or w[0].isalpha() else self.pretokens(w))
            elif w[:1] == " " and w[-1] in SINGLE_MARKS and w[1:-1].isalpha():
                pieces.append((w[:-1], w[-1]))
            else:
                pieces.append(self.pretokens(w))
        have = self.known.fill({p for x in pieces for p in x})
        return [have[x[0]] if len(x) == 1 else b"".join([have[p] for p in x]) for x in pieces]

    def merged(self, raw: bytes) -> list[int]:
        """Plain BPE by definition: the lowest-ranked, leftmost pair is merged until none is left."""
        ids = [self.byte_id[b] for b in raw]
        while len(ids) > 1:
            best = None
            for k in range(len(ids) - 1):
                m = self.merge.get((ids[k], ids[k + 1]))
                if m and (best is None or m[0] < best[0]):
                    best = (m[0], m[1], k)
            if best is None:
                break
            ids[best[2] : best[2] + 2] = [best[1]]
        return ids

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE keeps the two tokens as they are when they stand side by side."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        known = (a, b) not in self.merge and self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        self.pairs[a << 20 | b] = known
        return known

    def prefix_dp(self, pretoken: str) -> bytes:
        """The ids of one pre-token: the last token of every prefix, then the way back."""
        raw = pretoken.encode("utf-8").decode("latin-1")
        n = len(raw)
        last = [-1] * n
        width = [0] * n
        pairs = self.pairs
        for end, (token, size) in self.automaton.iter(raw):
            if last[end] >= 0:
                continue
            start = end - size
            if start >= 0:
                before = last[start]
                fits = pairs.get(before << 20 | token)
                if fits is None:
                    fits = self.compatible(before, token)
                if not fits:
                    continue
            last[end], width[end] = token, size
        if width[-1] == n:
            return self.packed[last[-1]]
        out, at = [], n - 1
        while at >= 0:
            out.append(last[at])
            at -= width[at]
        return np.array(out[::-1], dtype="<u4").tobytes()

    def _ordinary(self, text: str) -> list[str]:
        """Strings whose ids, one after another, are the text's."""
        if self.uneven(text):
            return self.pretokens(text)
        first, *rest = text.split(" ")
        return [first, *[f" {w}" for w in rest]] if first else [f" {w}" for w in rest]

    def _parts(self, text: str) -> list[str]:
        if self.special and any(s in text for s in self.special):
            return [x for p in self.cut_special(text) if p for x in ([p] if p in self.special else self._ordinary(p))]
        return self._ordinary(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        parts = [self._parts(t) for t in texts]
        words = set().union(*parts)
        special = {s: np.array([i], dtype="<u4").tobytes() for s, i in self.special.items() if s in words}
        have = self.words.fill(words.difference(special))
        get = (have | special).__getitem__ if special else have.__getitem__
        return [b"".join(map(get, p)) for p in parts]

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


def prefix_bpe(path: str) -> PrefixBpe:
    return tool(PrefixBpe, path)


def encode_documents(docs: DataFrame, path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked, the ids themselves.

    A narrow, single-pass transformation: nothing is shuffled.
    """
    path = path or public_path("byte_bpe_50k.json")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = prefix_bpe(path)
        for batch in slices(batches):
            rows = []
            for packed in bpe.encode(batch.column("text").to_pylist()):
                ids = np.frombuffer(packed, dtype="<u4").tolist()
                decimal = b"".join(map(bpe.decimal.__getitem__, ids))[:-1]
                row = (len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(bpe.decode(packed).encode("utf-8")).hexdigest())
                rows.append((*row, ids) if keep_ids else row)
            kinds = [pa.int64(), pa.string(), pa.string(), *[pa.list_(pa.int32())] * keep_ids]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids]
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=names)

    return arrow_map(texts_of(docs), run, schema)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text from a column ``ids``; null ids decode to the empty text."""
    path = path or public_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = prefix_bpe(path)
        for batch in batches:
            texts = [bpe.decode(np.array(ids or [], dtype="<u4").tobytes()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return arrow_map(encoded.select("doc_id", "ids"), run, "doc_id long, text string")
