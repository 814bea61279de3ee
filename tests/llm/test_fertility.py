import math
import random
from collections import Counter

from prefmill.llm.fertility import BYTES, ENTROPY, MARGIN, STEPS, SYMBOLS, Z, kept_documents, quality, repeated_words

from .conftest import TEXTS


def base(text):
    words = (text or "").encode().split()
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    n, inside = Counter(windows), set()
    for k, w in enumerate(windows):
        if n[w] > 1:
            inside.update(range(k, k + 5))
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in SYMBOLS), len(lines) - len(set(lines)), len(inside), failed


def test_repeated_words():
    rng = random.Random(2)
    for _ in range(300):
        words = [w.encode() for w in rng.choices("abcde"[: rng.randint(1, 5)], k=rng.randint(0, 40))]
        assert repeated_words(words) == base(b" ".join(words).decode())[4]


def test_base_rules_and_edges(docs, no_docs):
    got = sorted(((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality(docs).collect()))
    assert got == sorted((str(i), *base(t)) for i, t in TEXTS)
    assert all(not r.kept for r in quality(docs).where("base_failed").collect())
    assert quality(no_docs).count() == 0
    assert kept_documents(docs).columns == docs.columns


def test_bands_reject_broken_spelling(spark, docs):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices(["the", "ing", "tion", "er", "an", "re", "st"], k=rng.randint(1, 3)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(80, 300))), "en") for i in range(200)]
    rows += [(1000 + i, " ".join(word() + "".join(rng.choices("*%#&|$", k=3)) for _ in range(200)), "en") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality(df).collect()}
    assert not any(kept[1000 + i] for i in range(10)) and sum(kept[i] for i in range(200)) >= 198
    assert sorted(r.doc_id for r in kept_documents(df).collect()) == sorted(i for i in kept if kept[i])


def slow_kept(rows):
    """The bands and verdicts row by row from the measures: {row: kept}."""
    good = [r for r in rows if not r.base_failed]

    def median(values):
        bins = sorted(round_half_up(v * STEPS) for v in values if v is not None)
        return next((b / STEPS for k, b in enumerate(bins, 1) if 2 * k >= len(bins)), None)

    out = []
    for r in rows:
        peers = [g for g in good if g.lang == r.lang]
        like = [g for g in peers if klass(g) == klass(r)]
        if r.base_failed or not peers:
            out.append(not r.base_failed)
            continue
        mid = median([g.word_fertility for g in peers])
        spread = math.sqrt(sum(round_half_up(g.word_variance * g.n_words * 1000) for g in peers) / sum(g.n_words for g in peers) / 1000)
        low = mid - max(mid * MARGIN, Z * spread / math.sqrt(r.n_words))
        bytes_ = median([g.n_byte_tokens / g.n_tokens for g in peers])
        entropy = median([g.entropy for g in like])
        out.append(not (r.word_fertility < low or r.n_byte_tokens / r.n_tokens > bytes_ + BYTES or (entropy is not None and r.entropy < entropy - ENTROPY)))
    return out


def round_half_up(x):
    return math.floor(x + 0.5)


def klass(r):
    return math.floor(math.log2(max(1, r.n_tokens)))


def test_kept_against_brute_force(spark):
    rng = random.Random(9)
    parts = ["the", "ing", "tion", "er", "an", "re", "st", "Ω", "é"]
    word = lambda odd: "".join(rng.choices(parts[:7], k=rng.randint(1, 3))) + (rng.choice("*%#&|$ΩЖ") * rng.randint(1, 3) if rng.random() < odd else "")
    rows = [(i, " ".join(word(rng.choice([0, 0, 0.1, 0.5, 0.9])) for _ in range(rng.choice([5, 15, 40, 200]))), rng.choice(["en", "de", "", None])) for i in range(300)]
    rows += [(400 + i, "aa bb " * rng.randint(1, 3) + " ".join(word(0) for _ in range(60)), "en") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(quality(df).join(df.select("doc_id", "lang"), "doc_id").collect(), key=lambda r: r.doc_id)
    want = slow_kept(got)
    assert [r.kept for r in got] == want and 20 < sum(want) < len(want) - 20


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h i j k l", "en", 3, "x", True)], "doc_id long, text string, lang string, n_words int, __kept string, base_failed boolean")
    out = kept_documents(df.withColumn("kept", df["n_words"]).withColumn("__base_failed", df["n_words"]))
    assert [r.n_words for r in out.collect()] == [3] and out.columns == [*df.columns, "kept", "__base_failed"]
