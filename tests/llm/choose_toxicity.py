"""Choose the toxicity model's NEAR, SHARED and DECAY by cross-validation on training labels alone.

    python -m tests.llm.choose_toxicity /root/testdata/sf0.1

Rows that op3_toxicity holds out are dropped before anything else is done. The
rest is dealt into four folds by text; F1 at a score of a half over all four
decides, and log loss where that is equal. Not a test: a few minutes of all cores.
"""

from __future__ import annotations

import os

for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
    os.environ[name] = "1"

import sys
import zlib
from collections import Counter
from multiprocessing import Pool

import duckdb
import numpy as np

from prefmill.llm import toxicity as t

FOLDS = 4
FORMS_OF = {"none": (0, ()), "near 0": (0, (4, 6)), "near 3": (3, (4, 6)), "near 10": (10, (4, 6)), "near 30": (30, (4, 6))}
DECAYS = (1e-5, 5e-5, 2e-4)


def rows(sf: str) -> list[tuple[str, int]]:
    """Text and label of the training rows; copies once, as the fit has them."""
    sql = f"SELECT d.doc_id, coalesce(text, ''), max(toxic) FROM '{sf}/documents.parquet' d JOIN '{sf}/labels.parquet' l USING (doc_id) WHERE toxic IS NOT NULL GROUP BY ALL"
    return sorted({(text, toxic) for i, text, toxic in duckdb.sql(sql).fetchall() if zlib.crc32(str(i).encode()) % 5})


def one(job: tuple[str, str, int]) -> list[tuple[str, float, int, np.ndarray, np.ndarray]]:
    sf, name, fold = job
    t.NEAR, t.SHARED = FORMS_OF[name]
    data = rows(sf)
    of = lambda text: zlib.crc32(text.encode()) % FOLDS
    train, rest = [r for r in data if of(r[0]) != fold], [r for r in data if of(r[0]) == fold]
    bags = [[tuple(sorted(b)) for b in t.bag(text.lower(), t._any)] for text, _ in train]
    seen = {y: Counter(f for b, (_, y2) in zip(bags, train, strict=True) if y2 == y for f in set().union(*b)) for y in (0, 1)}
    share = sum(y for _, y in train) / len(train)
    gains = []
    for f, k in seen[1].items():
        c = seen[0][f]
        n = k + c
        if n >= t.MIN_DOCS and k > n * share:
            gains.append((-(k * np.log(k / (n * share)) + (c * np.log(c / (n * (1 - share))) if c else 0.0)), f))
    index = {f: j for j, (_, f) in enumerate(sorted(gains)[: t.FORMS])}
    got = []
    for b, (_, y) in zip(bags, train, strict=True):
        alike = Counter(tuple(sorted(index[f] for f in s if f in index)) for s in b)
        empty = alike.pop((), 0)
        got.append({"toxic": y, "empty": empty, "found": [x for own, n in sorted(alike.items()) for x in (*own, -n)]})
    out = []
    for decay in DECAYS:
        t.DECAY = decay
        bias, weights = t._noisy_or(got, len(index))
        strong = np.abs(weights) >= t.LEAST_WEIGHT
        if strong.any() and not strong.all():
            bias, weights = t._noisy_or(got, len(index), strong)
        model = t.Model(bias, {f: float(weights[j]) for f, j in index.items() if weights[j]})
        out.append((name, decay, fold, np.array([model.score(text) for text, _ in rest]), np.array([y for _, y in rest])))
    return out


def main(sf: str) -> None:
    with Pool(os.cpu_count()) as pool:
        got = [r for rs in pool.imap_unordered(one, [(sf, name, k) for name in FORMS_OF for k in range(FOLDS)]) for r in rs]
    table = []
    for name in FORMS_OF:
        for decay in DECAYS:
            score = np.concatenate([r[3] for r in got if r[:2] == (name, decay)])
            y = np.concatenate([r[4] for r in got if r[:2] == (name, decay)])
            hit, said = int(((score >= 0.5) & (y > 0)).sum()), int((score >= 0.5).sum())
            p = np.clip(score, 1e-6, 1 - 1e-6)
            loss = float(-np.mean(np.where(y > 0, np.log(p), np.log(1 - p))))
            table.append((2 * hit / max(1, said + int(y.sum())), -loss, name, decay, hit, int(y.sum()), said))
    for f1, loss, name, decay, hit, toxic, said in sorted(table, reverse=True):
        print(f"{name:8} decay {decay:g}: F1 {f1:.4f}, log loss {-loss:.4f}, {hit} of {toxic} found, {said} said")


if __name__ == "__main__":
    main(sys.argv[1])
