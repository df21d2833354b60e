"""Toxicity by a classifier chain.

The categories are predicted one after the other by linear models; each model also sees the
probabilities of the categories before it. In training those are out-of-fold predictions, so that a
later model learns from probabilities as good as the ones it will get. The models are fitted on the driver
from a bounded sample of labelled rows; all documents are scored where they are read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Batches, numbered, text_of
from tidemark.session import settle

SAMPLE = 5000  # labelled rows of either kind (any category, none) that the models are fitted on
FOLDS = 5
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    """The distinct lower-case words and, marked by a star, the beginnings of longer ones."""
    words = set(_WORD.findall(text.lower()))
    return words.union([w[:k] + "*" for w in words for k in (4, 5) if len(w) > k])


@dataclass
class Rows:
    """Binary rows: ``columns`` of all rows one after the other, ``starts`` of each (and the end)."""

    columns: np.ndarray
    starts: np.ndarray

    def times(self, weights: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(weights[self.columns])))
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def transposed_times(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.columns, np.repeat(values, np.diff(self.starts)), width)

    def take(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.starts)[rows]
        starts = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.starts[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return Rows(self.columns[at], starts)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass
class Model:
    weights: np.ndarray
    chained: np.ndarray
    bias: float

    def predict(self, rows: Rows, before: np.ndarray) -> np.ndarray:
        return sigmoid(rows.times(self.weights) + before @ self.chained + self.bias)


def telling(rows: Rows, label: np.ndarray, width: int, least: float = 20.0) -> np.ndarray:
    """Numbers of the features that go with the label: chi-square of at least ``least``, on the label's side."""
    n, positive = len(label), label.sum()
    having = rows.transposed_times(np.ones(n), width)
    both = rows.transposed_times(label, width)
    apart = n * both - having * positive
    spread = having * (n - having) * positive * (n - positive)
    return np.flatnonzero((apart > 0) & (n * apart**2 >= least * np.maximum(spread, 1)))


def fit(rows: Rows, before: np.ndarray, label: np.ndarray, width: int, penalty: float = 1e-4, steps: int = 200) -> Model:
    """Logistic regression by Adagrad over the features that tell; both classes weigh the same."""
    chosen = telling(rows, label, width)
    place = np.full(width, -1)
    place[chosen] = np.arange(len(chosen))
    held = place[rows.columns] >= 0
    starts = np.concatenate(([0], np.cumsum(held)))[rows.starts]
    rows, small = Rows(place[rows.columns[held]], starts), len(chosen)
    positive = max(label.sum(), 1)
    weight = np.where(label > 0, 0.5 / positive, 0.5 / max(len(label) - label.sum(), 1))
    w, v, b = np.zeros(small), np.zeros(before.shape[1]), 0.0
    past = [np.full(small, 1e-10), np.full(before.shape[1], 1e-10), 1e-10]
    for _ in range(steps):
        error = weight * (sigmoid(rows.times(w) + before @ v + b) - label)
        slopes = [rows.transposed_times(error, small) + penalty * w, before.T @ error + penalty * v, error.sum()]
        past = [p + s * s for p, s in zip(past, slopes)]
        w, v, b = (x - 0.3 * s / np.sqrt(p) for x, s, p in zip((w, v, b), slopes, past))
    weights = np.zeros(width)
    weights[chosen] = w
    return Model(weights, v, float(b))


@dataclass
class Chain:
    """Models of the categories in their order, the feature numbers, and the cutoff of each category."""

    categories: list[str]
    vocabulary: dict[str, int]
    models: list[Model]
    cutoffs: list[float]

    def rows(self, texts: Sequence[set[str]]) -> Rows:
        # sorted: one order of summing, whatever the order of the set
        return as_rows([sorted(self.vocabulary[f] for f in found if f in self.vocabulary) for found in texts])

    def predict(self, texts: Sequence[set[str]]) -> np.ndarray:
        rows = self.rows(texts)
        found = np.zeros((len(texts), 0))
        for model in self.models:
            found = np.column_stack([found, model.predict(rows, found)])
        return found


def best_cutoff(probability: np.ndarray, label: np.ndarray) -> float:
    """The cutoff of the best F1 between 0.3 and 0.95, of equal ones the nearest to one half; 1 if nothing
    is positive."""
    if not label.any():
        return 1.0
    ladder = np.arange(30, 96) / 100

    def f1(cutoff: float) -> float:
        flagged = probability > cutoff
        return 2 * (flagged & (label > 0)).sum() / max(flagged.sum() + label.sum(), 1)

    return float(max(ladder, key=lambda c: (f1(c), -abs(c - 0.5))))


def as_rows(known: Sequence[Sequence[int]]) -> Rows:
    starts = np.concatenate(([0], np.cumsum([len(k) for k in known]))).astype(np.int64)
    return Rows(np.array([c for k in known for c in k], np.int64), starts)


def train(samples: Sequence[tuple[int, Sequence[int], tuple[int, ...]]], vocabulary: Sequence[str],
          categories: Sequence[str]) -> Chain:
    """A chain from (identifier, numbers of the features, labels)."""
    samples = sorted(samples, key=lambda s: s[0])
    chain = Chain(list(categories), {}, [], [])
    rows = as_rows([sorted(s[1]) for s in samples])
    fold = np.array([(s[0] * 2654435761 >> 7) % FOLDS for s in samples], np.int64)
    before = np.zeros((len(samples), 0))
    for k in range(len(categories)):
        label = np.array([s[2][k] for s in samples], float)
        out_of_fold = np.zeros(len(samples))
        for f in range(FOLDS):
            inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if len(inside) and len(outside):
                model = fit(rows.take(inside), before[inside], label[inside], len(vocabulary))
                out_of_fold[outside] = model.predict(rows.take(outside), before[outside])
        chain.models.append(fit(rows, before, label, len(vocabulary)))
        chain.cutoffs.append(best_cutoff(out_of_fold, label))
        before = np.column_stack([before, out_of_fold])
    # scoring looks up only what some model weighs
    used = np.flatnonzero(np.any([m.weights != 0 for m in chain.models], axis=0))
    for model in chain.models:
        model.weights = model.weights[used]
    chain.vocabulary = {vocabulary[k]: place for place, k in enumerate(used)}
    return chain


_FOUND = pa.schema([("doc_id", pa.int64()), ("found", pa.list_(pa.string()))])


def _extract(batches: Batches) -> Batches:
    for batch in batches:
        found = [sorted(features(t)) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _FOUND.field(1).type)], schema=_FOUND)


def _numbers(vocabulary):
    schema = pa.schema([("doc_id", pa.int64()), ("numbers", pa.list_(pa.int32()))])

    def run(batches: Batches) -> Batches:
        known = {f: k for k, f in enumerate(vocabulary.value)}
        for batch in batches:
            numbers = [[known[f] for f in found if f in known] for found in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(numbers, schema.field(1).type)], schema=schema)

    return run


def train_on(docs: DataFrame, labels: DataFrame, categories: Sequence[str], text: str = "text",
             doc_id: str = "doc_id", sample: int = SAMPLE, least: int = 5) -> Chain:
    """Fits the chain on at most ``sample`` rows with some category and ``sample`` with none.

    ``labels`` has doc_id and a 0/1 column per category. The rows are those whose identifiers hash
    lowest, so they are spread over all sources; a label without identifier or value is left out, of
    repeated labels the highest counts, of repeated documents any one text. Without usable labels the
    chain predicts one half and flags nothing. Features in fewer than ``least`` rows or in more than half
    are left out; the numbers of the others come to the driver, which is bounded by the sample.
    """
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.max(F.col(c).cast("int")).alias(c) for c in categories]).dropna()
    marked = F.greatest(F.lit(0), *[F.col(c) for c in categories]) > 0
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where(marked).orderBy(*order).limit(sample).union(known.where(~marked).orderBy(*order).limit(sample))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("body"))
    found = rows.join(F.broadcast(picked.select("doc_id")), "doc_id", "left_semi").mapInArrow(
        _extract, "doc_id long, found array<string>")
    label = {r["doc_id"]: tuple(r[c] for c in categories) for r in picked.collect()}
    # a bounded table: its frequent features are numbered before its rows come to the driver
    found = settle(found.groupBy("doc_id").agg(F.min("found").alias("found")))
    counts = found.select(F.explode("found").alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = [r["feature"] for r in counts.where(
        (F.col("n") >= least) & (F.col("n") <= 0.5 * len(label))).orderBy("feature").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    numbers = found.mapInArrow(_numbers(shared), "doc_id long, numbers array<int>").toLocalIterator()
    return train([(r["doc_id"], np.array(r["numbers"], np.int32), label[r["doc_id"]]) for r in numbers],
                 vocabulary, categories)


def _score(chain):
    schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("scores", pa.list_(pa.float64()))])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                scores = chain.value.predict([features(t) for t in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(list(scores), pa.list_(pa.float64()))], schema=schema)

    return run


def toxicity(docs: DataFrame, chain: Chain, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: uid, doc_id, ``p_<category>`` and ``is_<category>`` of every category.

    NULL and empty texts get the models' bias. Whole texts are read, whatever their length; repeated
    rows score alike; only the two named columns are read; an empty table gives an empty result.
    """
    rows = numbered(docs, {"doc_id": F.col(f"`{doc_id}`").cast("long"), "body": text_of(text)})
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    scored = rows.mapInArrow(_score(shared), "uid long, doc_id long, scores array<double>")
    return scored.select(
        "uid", "doc_id",
        *[F.round(F.col("scores")[k], 6).alias(f"p_{c}") for k, c in enumerate(chain.categories)],
        *[(F.col("scores")[k] > F.lit(chain.cutoffs[k])).alias(f"is_{c}") for k, c in enumerate(chain.categories)])
