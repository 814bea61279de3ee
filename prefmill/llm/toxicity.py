"""Toxicity by multiple-instance learning: noisy-or over sentence scores.

A document is a bag of sentences. A sentence's probability is a logistic
function of the word forms in it (whole lower-cased words and their beginnings
of four to six characters, which count once more where another word of the
sentence or of the NEAR before it has the same one); a document's is the noisy-or of its sentences',
1 - prod(1 - p). Weights are fitted from document labels alone and then point
at the sentences that offend.

Fitting. The forms are chosen by log-likelihood ratio and the weights fitted on
at most ``TRAIN_DOCS`` labelled documents (a hash sample, whole texts; copies
count once, and of several texts of one doc_id the least is taken). Only the
counts of the best ``FORMS`` forms and, for each document, which of them its
sentences have (alike ones once, with their number) come to the driver. Scoring
is a narrow pass over all documents with the weights in the closure. All
capitals below are documented parameters of the fit.

Edge cases: null text is the empty text; a text without words has no sentence
and gets the score of one empty sentence; with no labelled rows, or with one
class only, all scores are the (smoothed) share of the class; labels that are
null are not used, of several labels of a document the largest counts; repeated
rows are scored each.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefmill.llm.util import arrow_map, slices, stored, texts_of

#: Labelled documents that a model is fitted on at most.
TRAIN_DOCS = 20_000
#: Forms that get a weight at most.
FORMS = 4_000
#: Documents of the sample that a form must be in.
MIN_DOCS = 4
#: Lengths of the beginnings.
STEMS = (4, 5, 6)
#: Lengths of the beginnings that count anew where words near each other share them.
SHARED = (4, 6)
#: Sentences before a sentence that are near it.
NEAR = 10
#: Pull of the weights towards zero, which makes forms share what they explain.
DECAY = 5e-5
#: Weights below this are dropped, and the rest fitted again.
LEAST_WEIGHT = 0.5
#: Forms that a task counts before it passes its counts on.
COUNTED = 300_000

SENTENCE = re.compile(r"[^.!?\n\r]+[.!?]*").findall
WORD = re.compile(r"\w+").findall


def forms(word: str) -> list[str]:
    """A lower-cased word and its beginnings, marked as such."""
    return [word, *(f"{word[:k]}*" for k in STEMS if len(word) > k)]


def held_out(doc_id_col: str = "doc_id"):
    """Whether crc32 of the id as text leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(F.col(doc_id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def bag(low: str, weighted: Callable[[str], bool]) -> Iterator[set[str]]:
    """The forms of each sentence of a lower-cased text, of weighted words alone; at least one sentence."""
    near: deque[set[str]] = deque(maxlen=NEAR)
    for s in SENTENCE(low) or [""]:
        own = {w for w in WORD(s) if weighted(w)}
        found = {f for w in own for f in forms(w)}
        starts: Counter = Counter(w[:k] for w in own for k in SHARED if len(w) > k)
        found.update(f"{x}**" for x, n in starts.items() if n > 1 or any(x in b for b in near))
        near.append(set(starts))
        yield found


class Model:
    """Weights by form; ``weighted`` tells whether any of a word's forms has one."""

    def __init__(self, bias: float, weights: dict[str, float]):
        self.bias, self.weights = bias, weights
        self.words: dict[str, bool] = {}

    def __getstate__(self):
        return self.bias, self.weights

    def __setstate__(self, state):
        self.__init__(*state)

    def weighted(self, word: str) -> bool:
        got = self.words.get(word)
        if got is None:
            if len(self.words) > 150_000:
                self.words.clear()
            get = self.weights.get
            got = self.words[word] = any(map(get, forms(word))) or any(get(f"{word[:k]}**") for k in SHARED if len(word) > k)
        return got

    def sentences(self, text: str) -> list[tuple[str, float]]:
        """Each sentence with its probability; a form counts once a sentence."""
        bags = bag(text.lower(), self.weighted)
        return [(s, _sigmoid(self.bias + self._sum(b))) for s, b in zip(SENTENCE(text) or [""], bags, strict=True)]

    def _sum(self, found: set[str]) -> float:
        return sum(self.weights.get(f, 0.0) for f in sorted(found)) if found else 0.0

    def score(self, text: str) -> float:
        """The document's noisy-or. Sentences without a weighted word share one term."""
        plain = float(np.log1p(np.exp(self.bias)))  # -log(1 - sigmoid(bias))
        low = text.lower()
        if not any(map(self.weighted, set(WORD(low)))):
            return float(-np.expm1(-plain * len(SENTENCE(low) or [""])))
        total = 0.0
        for found in bag(low, self.weighted):
            z = self._sum(found)
            total += float(np.log1p(np.exp(min(60.0, self.bias + z)))) if z else plain
        return float(-np.expm1(-total))


def _any(word: str) -> bool:
    return True


def _sigmoid(z: float) -> float:
    return float(1 / (1 + np.exp(-max(-60.0, min(60.0, z)))))


def _sample(docs: DataFrame, labels: DataFrame, train_docs: int) -> DataFrame:
    """doc_id, text, toxic of the training documents; held-out rows never enter."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()
    )
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    share = min(1.0, train_docs / max(1, n))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # about train_docs rows of two numbers, whatever the input
    return texts_of(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _counted(sample: DataFrame, n_forms: int) -> list[str]:
    """The forms that tell most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic_docs: Counter = Counter()
        clean_docs: Counter = Counter()

        def counted() -> pa.RecordBatch:
            keys = list(toxic_docs.keys() | clean_docs.keys())
            cols = [pa.array(keys, pa.string()), pa.array([toxic_docs[k] for k in keys], pa.int64()), pa.array([clean_docs[k] for k in keys], pa.int64())]
            return pa.RecordBatch.from_arrays(cols, names=["form", "toxic", "clean"])

        for batch in slices(batches):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                (toxic_docs if toxic > 0 else clean_docs).update(set().union(*bag(text.lower(), _any)))
            if len(toxic_docs) + len(clean_docs) > COUNTED:
                yield counted()
                toxic_docs.clear()
                clean_docs.clear()
        yield counted()

    total = sample.agg(F.count(F.when(F.col("toxic") > 0, 1)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    t_all, n_all = float(total["t"]), float(total["n"])
    counted = arrow_map(sample.select("text", "toxic"), run, "form string, toxic long, clean long").groupBy("form").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n = F.col("toxic") + F.col("clean")
    share = t_all / max(1.0, n_all)
    gain = F.lit(0.0)
    for seen, expected in ((F.col("toxic"), n * share), (F.col("clean"), n * (1 - share))):
        gain = gain + F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    # only forms that speak for toxicity: the rest is the bias's part
    best = counted.where((n >= MIN_DOCS) & (F.col("toxic") > n * share)).withColumn("gain", gain).orderBy(F.desc("gain"), "form").limit(n_forms)
    return [r["form"] for r in best.collect()]


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, n_forms: int = FORMS) -> Model:
    """A model from the labelled rows that are not held out."""
    sample = stored(_sample(docs, labels, train_docs).withColumn("_text", F.xxhash64("text")).dropDuplicates(["_text", "toxic"]).drop("_text"), "toxicity-sample")
    chosen = _counted(sample, n_forms)
    index = {f: k for k, f in enumerate(chosen)}

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                alike = Counter(tuple(sorted(index[f] for f in found if f in index)) for found in bag(text.lower(), _any))
                empty = alike.pop((), 0)
                rows.append((int(toxic > 0), empty, [x for own, n in sorted(alike.items()) for x in (*own, -n)]))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.list_(pa.int32())), strict=True)], names=["toxic", "empty", "found"])

    got = arrow_map(sample.select("text", "toxic"), bags, "toxic int, empty long, found array<int>").collect()
    got.sort(key=lambda r: (r["toxic"], r["empty"], r["found"]))  # the sum below doesn't depend on task order
    bias, weights = _noisy_or(got, len(chosen))
    strong = np.abs(weights) >= LEAST_WEIGHT
    if strong.any() and not strong.all():
        bias, weights = _noisy_or(got, len(chosen), strong)
    return Model(bias, {f: float(weights[k]) for f, k in index.items() if weights[k]})


def _noisy_or(bags: list, n_forms: int, used: np.ndarray | None = None, steps: int = 500, rate: float = 0.1) -> tuple[float, np.ndarray]:
    """Full-batch Adam on the noisy-or likelihood with an L1 pull on the weights."""
    y = np.array([r["toxic"] for r in bags], float)
    empty = np.array([r["empty"] for r in bags], float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return float(np.log(share / (1 - share))), np.zeros(n_forms)
    doc, sent, form, times = [], [], [], []
    for d, r in enumerate(bags):
        for f in r["found"]:
            if f < 0:  # ends a sentence that the document has -f times
                doc.append(d)
                times.append(-f)
            else:
                sent.append(len(doc))
                form.append(f)
    n_sent = len(doc)
    doc, sent, form, times = (np.array(x, np.int64) for x in (doc, sent, form, times))
    weights, bias = np.zeros(n_forms + 1), -6.0
    m = v = np.zeros(n_forms + 1)
    for step in range(1, steps + 1):
        bias = weights[-1] - 6.0
        z = bias + np.bincount(sent, weights[form], n_sent)
        soft = np.logaddexp(0, z)  # -log(1 - p of a sentence)
        total = np.bincount(doc, soft * times, len(y)) + empty * np.logaddexp(0, bias) + 1e-9
        # d loss / d total: for a clean document 1, for a toxic one -(1-q)/q
        g = np.where(y > 0, -np.exp(-total) / -np.expm1(-total), 1.0) / len(y)
        p = 1 / (1 + np.exp(-z))
        gs = g[doc] * p * times
        grad = np.append(np.bincount(form, gs[sent], n_forms), gs.sum() + (g * empty).sum() / (1 + np.exp(-bias)))
        grad[:-1] += DECAY * np.sign(weights[:-1])
        if used is not None:
            grad[:-1][~used] = 0.0
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        weights = weights - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return float(weights[-1] - 6.0), weights[:-1]


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, worst_sentence (index from 0; null if not toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores, worst = [], []
            for text in batch.column("text").to_pylist():
                scores.append(model.score(text))
                worst.append(int(np.argmax([p for _, p in model.sentences(text)])) if scores[-1] >= threshold else None)
            predicted = [int(s >= threshold) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(predicted, pa.int32()), pa.array(worst, pa.int32())],
                names=["doc_id", "score", "predicted", "worst_sentence"],
            )

    out = arrow_map(texts_of(docs), run, "doc_id long, score double, predicted int, worst_sentence int")
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted", "worst_sentence")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled rows and score every document."""
    return score_documents(docs, fit(docs, labels))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below the threshold, with their own columns; no text is shuffled."""
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([model.score(t or "") < threshold for t in batch.column("text").to_pylist()], pa.bool_()))

    return arrow_map(docs, run, docs.schema)
