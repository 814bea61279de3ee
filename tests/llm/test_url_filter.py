import math
import random

import numpy as np
import pytest

from prefmill.llm import url_filter
from prefmill.llm.url_filter import EDGES, RULES, _with_statistics, boost, features, held_out, judge, parsed

URLS = [
    (1, "https://a.example.org/es/x?q=1&r=2"),
    (2, "HTTP://A.Example.ORG/en/12#t"),
    (3, "x://example.org"),
    (4, None),
    (5, "no scheme example.com/de/1"),
    (6, "https://shop.example.com/de/1"),
    (7, "https://shop.example.com/fr/1"),
    (8, "https://shop.example.com/en/1?a=1;b=2"),
    (9, "https://É.example.net?x/y://z"),
    (10, ""),
    (11, "https://notexample.org/es/"),
    (11, "https://notexample.org/es/"),
    (None, "https://b.example.com/de/"),
    (12, "https://h.example.net/" + "z" * 5000),
]


def expected(url):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def test_rules_and_edges(spark, docs):
    df = spark.createDataFrame([(i, u, "x") for i, u in URLS], "page_id long, url string, host string")
    got = judge(df.drop("host")).collect()
    assert len(got) == len(URLS)
    want = sorted((str(i), *expected(u)[:3]) for i, u in URLS)
    assert sorted(((str(r.page_id), r.host, r.path, r.rule) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        verdicts = {expected(u)[3] for i, u in URLS if str(i) == str(r.page_id)}
        assert r.verdict in ("allow", "block") and (None in verdicts or r.verdict in verdicts)
    assert judge(df.limit(0)).count() == 0
    assert {r.verdict for r in judge(df, rules=[]).collect()} == {"allow"}


def test_features(spark):
    df = spark.createDataFrame(URLS, "page_id long, url string")
    for r in features(parsed(df)).collect():
        u = r.url or ""
        assert r.url_length == len(u) and abs(r.digit_share - sum(c in "0123456789" for c in u) / max(1, len(u))) < 1e-12
        entropy = -sum(u.count(c) / len(u) * math.log2(u.count(c) / len(u)) for c in set(u)) if u else 0
        assert abs(r.entropy - entropy) < 1e-9
        assert r.depth == r.path.count("/")


def test_trees_learn_from_the_dealt_features(spark, docs):
    """Verdicts that follow the number of parameters are learned, and held for URLs that no rule fits."""
    rng = random.Random(4)
    rules = [("block", "bad.com", "/"), ("allow", "good.com", "/")]
    rows = []
    for i in range(600):
        bad = rng.random() < 0.4
        kind = rng.choice(["good.com", "bad.com", "other.com"])
        bad = kind == "bad.com" or kind == "other.com" and bad
        query = "?" + "&".join(f"k{j}=1" for j in range(rng.randint(4, 6) if bad else rng.randint(0, 1)))
        rows.append((i, f"https://{'s' * rng.randint(1, 5)}.{kind}/{rng.randint(1, 99)}{query}", bad))
    df = spark.createDataFrame(rows, "page_id long, url string, truth boolean")
    got = judge(df, rules).join(df, "page_id").collect()
    assert all(r.verdict == ("block" if r.truth else "allow") and 0 <= r.block_score <= 1 for r in got)
    out = {(r.verdict, r.predicted): r.rows for r in held_out(df, rules).collect()}
    assert set(out) == {("block", "block"), ("allow", "allow")}


@pytest.mark.parametrize("broadcast", [10_000, 0])
def test_suffix_statistics_leave_out_the_own_fold(spark, docs, monkeypatch, broadcast):
    monkeypatch.setattr(url_filter, "BROADCAST_KEYS", broadcast)
    rows = [("com", k % 5, "allow") for k in range(3000)] + [("rare", 1, "block"), ("rare", 1, "block"), ("rare", 2, "allow"), ("rare", 1, None), ("none", 3, None)]
    df = spark.createDataFrame(rows, "_suffix string, _fold int, _verdict string")
    got = {(r["_suffix"], r["_fold"], r["_verdict"]): r for r in _with_statistics(df).collect()}
    prior = 3 / 3005
    assert _with_statistics(df).count() == len(rows)
    assert got["rare", 1, "block"].suffix_blocked == pytest.approx(10 * prior / 11)
    assert got["rare", 2, "allow"].suffix_blocked == pytest.approx((2 + 10 * prior) / 12)
    assert got["rare", 1, None].suffix_blocked == pytest.approx((2 + 10 * prior) / 13)
    assert got["none", 3, None].suffix_blocked == pytest.approx(prior)
    assert got["rare", 1, None].suffix_share == pytest.approx(4 / 3005)


def plain_boosting(x, pos, neg, rounds, depth, rate, ridge):
    """Boosted trees row by row: the log-odds of each row."""
    odds = np.full(len(x), math.log(pos.sum() / neg.sum()))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds))
        g, h = np.round((pos * (1 - p) - neg * p) * 1e6) / 1e6, np.round((pos + neg) * p * (1 - p) * 1e6) / 1e6
        leaves = [np.arange(len(x))]
        for _ in range(depth):
            grown = []
            for own in leaves:
                gain = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + ridge)
                best = (1e-6, None)
                for f in range(x.shape[1]):
                    for cut in sorted(set(x[own, f]))[1:]:
                        low, high = own[x[own, f] < cut], own[x[own, f] >= cut]
                        better = gain(low) + gain(high) - gain(own)
                        if better > best[0] + 1e-9:
                            best = (better, (low, high))
                grown += best[1] or (own,)
            leaves = grown
        for own in leaves:
            odds[own] += rate * g[own].sum() / (h[own].sum() + ridge)
    return odds


def test_trees_against_plain_boosting(spark, docs):
    rng = np.random.default_rng(5)
    names = list(EDGES)
    x = np.unique(rng.integers(0, 4, (150, len(names))), axis=0)
    pos, neg = rng.integers(0, 9, len(x)), rng.integers(0, 9, len(x))
    pos[x[:, 2] > 2] += 20
    rows = [(k, *map(int, r), int(a), int(b)) for k, (r, a, b) in enumerate(zip(x, pos, neg, strict=True))]
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"_b_{n} int" for n in names) + ", _pos long, _neg long")
    for rounds, depth in ((1, 1), (3, 2), (4, 3)):
        got = [r.o for r in df.select("k", boost(df, rounds, depth).expression().alias("o")).orderBy("k").collect()]
        assert np.allclose(got, plain_boosting(x, pos, neg, rounds, depth, 0.4, 1.0), atol=1e-5)


def test_clashing_names(spark, docs):
    df = spark.createDataFrame([(1, "https://a.example.org/es/x", "h", "p", "v")], "page_id long, url string, host string, path string, _verdict string")
    assert [tuple(r)[:5] for r in judge(df).collect()] == [(1, "a.example.org", "/es/x", "example.org/es/", "block")]
