import numpy as np
import xxhash

from prefmill.llm.components import components
from prefmill.llm.simhash import THRESHOLD, Tile, _forest, _leaders, anchors, fingerprint, near_duplicates, one_of_each
from prefmill.llm.util import stored

from .conftest import TEXTS


def family(n=400, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, n, dtype=np.uint64) * 2 + 1
    out = [base]
    for d in range(1, 7):
        x = base[: n // 2].copy()
        for _ in range(d):
            x ^= np.uint64(1) << rng.integers(0, 64, len(x), dtype=np.uint64)
        out.append(x)
    return np.unique(np.concatenate(out))


def linked(f):
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= THRESHOLD
    return {(i, j) for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True) if i < j}


def test_code_is_perfect():
    _, leader = _leaders()
    assert (leader >= 0).all() and max(int(x).bit_count() for x in leader) == 3


def test_covering_loses_no_link():
    f = family()
    want = linked(f)
    for wide in (False, True):
        rows, keys, home = anchors(f, wide)
        homes, all_ = {}, {}
        for r, k, h in zip(rows.tolist(), keys.tolist(), home.tolist(), strict=True):
            (homes if h else all_).setdefault(k, set()).add(r)
        got = {(min(i, j), max(i, j)) for k, hs in homes.items() for i in hs for j in all_[k] if i != j}
        assert want <= got


def roots(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(x) for x in range(n)]


def test_forest_spans_dense_groups():
    rng = np.random.default_rng(2)
    f = np.unique(np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)))
    a, b = _forest(f, np.ones(len(f), bool))
    place = {int(x): k for k, x in enumerate(f)}
    assert len(a) < len(f)
    assert roots(len(f), [(place[int(x)], place[int(y)]) for x, y in zip(a, b, strict=True)]) == roots(len(f), linked(f))


def test_components(spark, docs):
    rng = np.random.default_rng(4)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(k, k + 1) for k in range(300, 360)] + [(500, k) for k in range(501, 600)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots(600, pairs)
    assert all(want[n] == c for n, c in got.items())
    assert set(got) == {x for p in pairs if p[0] != p[1] for x in p}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark, docs, no_docs):
    texts = [t or "" for _, t in TEXTS]
    assert [fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]
    base = " ".join(f"w{k}" for k in range(400))
    more = [(100 + k, base.replace("w7 ", f"v{k} ")) for k in range(60)]
    rows = TEXTS + more
    df = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    f = np.array([slow_fingerprint(t or "") for _, t in rows], dtype=np.uint64)
    label = roots(len(rows), linked_rows(f))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[label[k]] = min(least.get(label[k], 10**9), i)
    want = sorted(((str(i), f"{int(f[k]):016x}", str(least.get(label[k]))) for k, (i, _) in enumerate(rows)))
    for tile in (8192, 5):
        got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in near_duplicates(df, tile=tile).collect())
        assert got == want
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in near_duplicates(df, wide_from=1).collect()) == want
    assert near_duplicates(no_docs).count() == 0


def linked_rows(f):
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= THRESHOLD
    return [(i, j) for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True) if i < j]


def test_one_of_each(docs, no_docs):
    out = one_of_each(docs)
    assert out.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    f = np.array([slow_fingerprint(t or "") for _, t in TEXTS], dtype=np.uint64)
    groups = len(set(roots(len(TEXTS), linked_rows(f))))
    assert len(kept) == groups and (1, TEXTS[0][1]) in kept and (2, None) in kept
    assert one_of_each(no_docs).count() == 0


def test_one_of_each_keeps_columns_rows_and_files(spark, docs):
    base = " ".join(f"w{k}" for k in range(300))
    rows = [(k, base + (" x" if k % 3 else ""), f"f{k}", k, "h") for k in range(60)] + [(5, base + " x", "f5", 5, "h")] * 3 + [(70, "another text of its own", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, file string, row int, text_hash string").repartition(7)
    stored_docs = stored(df, "test-docs")
    f = np.array([slow_fingerprint(t) for _, t, *_ in rows], dtype=np.uint64)
    n = len(set(roots(len(rows), linked_rows(f))))
    for source in (df, stored_docs, stored_docs.where("doc_id >= 0"), stored_docs.union(stored_docs)):
        out = one_of_each(source)
        assert out.schema == df.schema
        got = sorted((tuple(r) for r in out.collect()), key=lambda r: r[0])
        assert len(got) == n and got[0] == rows[0] and got[-1] == rows[-1]


def test_replicas_stream_in_parts(spark, docs):
    f = family(200, 3)
    want = roots(len(f), linked(f))
    at = {int(x): k for k, x in enumerate(f)}
    for step in (1, 7, 1000):
        tile, pairs = Tile(), []
        tile.add(f)
        for k in range(0, len(f), step):
            a, b = tile.match(f[k : k + step])
            pairs += [(at[x], at[y]) for x, y in zip(a, b, strict=True)]
        assert len(pairs) < len(f) and roots(len(f), pairs) == want
    stray = Tile()
    stray.add(f[:100])
    a, b = stray.match(f)
    pairs = [(at[x], at[y]) for x, y in zip(a, b, strict=True)]
    assert roots(len(f), pairs) == roots(len(f), [(i, j) for i, j in linked(f) if i < 100 or j < 100])
