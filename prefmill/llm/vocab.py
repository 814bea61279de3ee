"""Exact, cached encoders for the public vocabulary files.

Encoders are per-process objects: a worker builds each once and keeps it across
tasks. Their word caches hold two generations of bounded size.
"""

from __future__ import annotations

import itertools
import json
import os
from collections.abc import Iterable

import numpy as np

from prefmill.llm.util import tool

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Marks that are a token of their own behind letters.
SINGLE_MARKS = frozenset(",.;:!?")
#: Words in the younger generation of a cache before it becomes the older one.
CACHE_WORDS = 150_000


def public_path(name: str) -> str:
    """Where the public vocabulary file ``name`` lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_chars() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    out.update({chr(256 + i): b for i, b in enumerate(rest)})
    return out


class Cache:
    """word -> value in two generations; ``fill`` makes all asked words present in ``young``."""

    def __init__(self, compute, cap: int = CACHE_WORDS):
        self.compute, self.cap = compute, cap
        self.young: dict = {}
        self.old: dict = {}

    def fill(self, words: set) -> dict:
        miss = words.difference(self.young)
        if not miss:
            return self.young
        if len(self.young) + len(miss) > self.cap and self.young:
            self.old, self.young = self.young, {}
            miss = words
        young, old = self.young, self.old
        new = []
        for w in miss:
            if (v := old.get(w)) is None:
                new.append(w)
            else:
                young[w] = v
        if new:
            young.update(zip(new, self.compute(new), strict=True))
        return young


class WordEncoder:
    """Ids of a lower-casing, white-space-dropping word BPE as the library gives them.

    White space never lies inside a token, so a slice of documents is one string.
    Its pre-tokens are found by character class, each gets the end-of-word
    symbol (the byte 1), and one call of a rank encoder over the same vocabulary
    merges them all; the ids are cut at end-of-word flags. Texts beyond U+024F
    or with a special token's string go to the library itself.
    """

    END = "\x01"
    SPACE, LETTER, NUMBER, MARK = range(4)
    PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        self.special = [t["content"] for t in spec["added_tokens"]]
        added = set(self.special)
        of = byte_chars()
        suffix = spec["model"]["end_of_word_suffix"]
        ranks, self.ends = {}, np.zeros(len(spec["model"]["vocab"]) + len(added), bool)
        for token, i in spec["model"]["vocab"].items():
            if token in added:
                continue
            self.ends[i] = token.endswith(suffix)
            body = token.removesuffix(suffix) if self.ends[i] else token
            ranks[bytes(of[c] for c in body) + (self.END.encode() if self.ends[i] else b"")] = i
        self.merge = tiktoken.Encoding("word", pat_str=r"[^\x01]*+\x01", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.pretoken = regex.compile(self.PRETOKEN)
        # NFC and lower-casing leave all others alone or act on each character by itself
        self.odd = regex.compile(r"[^\t-\r\x20-\x7e\xa1-\u012f\u0131-\u024f]").search
        kind = regex.compile(r"(\s)|(\p{L})|(\p{N})|(.)", regex.DOTALL)
        self.kinds = np.array([kind.match(chr(c)).lastindex - 1 for c in range(0x250)], np.uint8)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _latin(self, texts: list[str]) -> list[bytes]:
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), dtype="<u4")
        kinds = self.kinds[codes]
        last = kinds != self.SPACE
        last[:-1] &= (kinds[1:] != kinds[:-1]) | (kinds[:-1] == self.NUMBER)
        at = np.flatnonzero(last)
        marked = np.insert(codes, at + 1, 1)
        counts = np.searchsorted(at, starts)
        return self._merged(marked[self.kinds[marked] != self.SPACE].tobytes().decode("utf-32-le"), counts)

    def _merged(self, marked: str, counts: np.ndarray) -> list[bytes]:
        ids = np.array(self.merge(marked), dtype="<u4")
        cuts = np.append(0, np.flatnonzero(self.ends[ids]) + 1)
        if len(cuts) != counts[-1] + 1 or cuts[-1] != len(ids):
            raise ValueError("the rank encoder lost a word end")
        raw = ids.tobytes()
        return [raw[a:b] for a, b in itertools.pairwise((cuts[counts] * 4).tolist())]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        texts = list(texts)
        out: list[bytes] = [b""] * len(texts)
        latin, quoted, other = [], [], []
        for k, t in enumerate(texts):
            if self.odd(t) or "<|" in t and any(s in t for s in self.special):
                other.append(k)
            elif t:
                (quoted if "'" in t else latin).append(k)
        for chosen, encode in ((latin, self._latin), (quoted, self._quoted), (other, self._library)):
            if chosen:
                for k, ids in zip(chosen, encode([texts[k].lower() if encode != self._library else texts[k] for k in chosen]), strict=True):
                    out[k] = ids
        return out

    def _quoted(self, texts: list[str]) -> list[bytes]:
        """Contractions need the pattern itself."""
        pieces = [self.pretoken.findall(t) for t in texts]
        flat = list(itertools.chain.from_iterable(pieces))
        return self._merged("".join([p + self.END for p in flat]), np.cumsum([0, *map(len, pieces)]))


def word_encoder(path: str) -> WordEncoder:
    return tool(WordEncoder, path)
