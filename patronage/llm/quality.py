"""Quality: a classifier trained by follow-the-regularised-leader, and calibrated quality rules.

Both are logistic regressions over hashed n-grams, fitted on the driver on a bounded
sample of labelled rows (SAMPLE_PER_CLASS of each label, those with the least id hash) and
applied to every whole text in Arrow batches.  The odds are shifted back from the sample's
shares of labels to those of all labelled rows.

Defined cases: null texts are empty texts and are scored too; labels other than 0 and 1
and labels of unknown documents are ignored; a document with several label rows counts
with each; without rows of both labels every score is 0.5; repeated rows are scored
alike; an empty table gives no rows; a clashing input column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from patronage.llm.features import DIM, Rows, add_columns, base_counts, fold, ngram_rows
from patronage.llm.words import slices

SAMPLE_PER_CLASS = 2000


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Ftrl:
    """Logistic regression by follow-the-regularised-leader with a rate per coordinate."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.5

    def fit(self, rows: Rows, labels: np.ndarray, passes: int = 4, seed: int = 5) -> tuple[np.ndarray, float]:
        z, n = np.zeros(DIM + 1), np.zeros(DIM + 1)
        order = np.random.default_rng(seed)
        for _ in range(passes):
            for i in order.permutation(len(labels)):
                index = np.append(rows.index[rows.first[i] : rows.first[i + 1]], DIM)
                value = np.append(rows.value[rows.first[i] : rows.first[i + 1]], 1.0)
                w = self._weights(z[index], n[index])
                g = (sigmoid(w @ value) - labels[i]) * value
                more = n[index] + g * g
                z[index] += g - (np.sqrt(more) - np.sqrt(n[index])) / self.alpha * w
                n[index] = more
        w = self._weights(z, n)
        return w[:DIM].astype(np.float32), float(w[DIM])

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return -np.sign(z) * np.maximum(np.abs(z) - self.l1, 0) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)


def fit_logistic(rows: Rows, labels: np.ndarray, passes: int = 4, rate: float = 0.5, seed: int = 6) -> tuple[np.ndarray, float]:
    """Logistic regression by adaptive gradient steps."""
    w, seen = np.zeros(DIM + 1), np.full(DIM + 1, 1e-6)
    order = np.random.default_rng(seed)
    for _ in range(passes):
        for i in order.permutation(len(labels)):
            index = np.append(rows.index[rows.first[i] : rows.first[i + 1]], DIM)
            value = np.append(rows.value[rows.first[i] : rows.first[i + 1]], 1.0)
            g = (sigmoid(w[index] @ value) - labels[i]) * value + 1e-5 * w[index]
            seen[index] += g * g
            w[index] -= rate * g / np.sqrt(seen[index])
    return w[:DIM].astype(np.float32), float(w[DIM])


def calibration(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities, by Newton steps on smoothed labels."""
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.stack([margins, np.ones_like(margins)], 1)
    at = np.array([1.0, 0.0])
    for _ in range(30):
        p = sigmoid(x @ at)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        at = at - np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (at - [1.0, 0.0]))
    return float(at[0]), float(at[1])


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    chars: bool
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        margin = ngram_rows(data, starts, self.chars).dot(self.weights) + self.bias
        return sigmoid(self.slope * margin + self.offset)


def labelled_rows(docs: DataFrame, labels: DataFrame, use: Column, chars: bool) -> tuple[Rows, np.ndarray, float]:
    """Features and labels of the bounded sample, and the log odds of label 1 among all labelled rows of `use`."""
    known = labels.where(use).select("doc_id", F.col("quality").cast("int").alias("label")).where("label IN (0, 1)")
    shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.where("label = 0").orderBy(*order).limit(SAMPLE_PER_CLASS).unionByName(known.where("label = 1").orderBy(*order).limit(SAMPLE_PER_CLASS))
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # 2 * SAMPLE_PER_CLASS rows at most

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, to, data, starts in slices(batch["text"]):
                rows = ngram_rows(data, starts, chars)
                bounds = list(zip(rows.first[:-1].tolist(), rows.first[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, to - lo),
                        batch["label"].slice(lo, to - lo),
                        pa.array([rows.index[a:b].tobytes() for a, b in bounds], pa.binary()),
                        pa.array([rows.value[a:b].astype(np.float16).tobytes() for a, b in bounds], pa.binary()),
                    ],
                    ["doc_id", "label", "index", "value"],
                )

    got = texts.select(F.col("doc_id").cast("bigint"), "label", "text").mapInArrow(extract, "doc_id bigint, label int, index binary, value binary").collect()
    got.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], r["label"], r["index"]))
    each = [np.frombuffer(r["index"], np.int32) for r in got]
    first = np.append(0, np.cumsum([len(a) for a in each])).astype(np.int64)
    none = np.zeros(0, np.int32)
    value = [np.frombuffer(r["value"], np.float16).astype(np.float32) for r in got]
    rows = Rows(first, np.concatenate([none, *each]), np.concatenate([none.astype(np.float32), *value]))
    odds = float(np.log(shares[1] / shares[0])) if len(shares) == 2 else 0.0
    return rows, np.array([r["label"] for r in got], np.int64), odds


def part(rows: Rows, take: np.ndarray) -> Rows:
    lengths = np.diff(rows.first)[take]
    ends = np.cumsum(lengths)
    at = np.repeat(rows.first[:-1][take] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
    return Rows(np.append(0, ends), rows.index[at], rows.value[at])


def _no_model(chars: bool) -> Model:
    return Model(np.zeros(DIM, np.float32), 0.0, chars)


def train_classifier(docs: DataFrame, labels: DataFrame, use: Column) -> Model:
    """Word n-grams, follow-the-regularised-leader."""
    rows, y, odds = labelled_rows(docs, labels, use, chars=False)
    if len(set(y.tolist())) < 2:
        return _no_model(False)
    weights, bias = Ftrl().fit(rows, y)
    return Model(weights, bias, False, offset=odds - float(np.log(y.sum() / (len(y) - y.sum()))))


def train_rules(docs: DataFrame, labels: DataFrame) -> Model:
    """Word and character n-grams, calibrated on a quarter of the sample that the weights haven't seen."""
    rows, y, odds = labelled_rows(docs, labels, F.lit(True), chars=True)
    if len(set(y.tolist())) < 2:
        return _no_model(True)
    held = np.arange(len(y)) % 4 == 0
    learn, check = np.flatnonzero(~held), np.flatnonzero(held)
    if len(set(y[learn].tolist())) < 2 or len(set(y[check].tolist())) < 2:
        learn = check = np.arange(len(y))
    weights, bias = fit_logistic(part(rows, learn), y[learn])
    slope, offset = calibration(part(rows, check).dot(weights) + bias, y[check])
    share = y[check].mean()
    return Model(weights, bias, True, slope, offset + odds - float(np.log(share / (1 - share))))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with `score`, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM weights, whatever the input

    def start():
        m = shared.value
        return lambda data, starts: [pa.array(m.probability(data, starts))]

    return add_columns(docs, start, "score double")


# Fixed thresholds of the rules.
LEAST_WORDS, MOST_REPEATED_PERCENT, LEAST_PROBABILITY = 10, 20, 0.3
RULE_COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, probability double, kept boolean"
)


def apply_rules(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with the base counts, the calibrated probability and the verdict."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM weights, whatever the input

    def start():
        m = shared.value

        def work(data, starts):
            c = base_counts(data, starts)
            failed = (c.n_words < LEAST_WORDS) | (100 * c.n_repeat_words > MOST_REPEATED_PERCENT * c.n_words)
            p = m.probability(data, starts)
            counts = (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words)
            return [*(pa.array(a, pa.int64()) for a in counts), pa.array(failed), pa.array(p), pa.array(~failed & (p >= LEAST_PROBABILITY))]

        return work

    return add_columns(docs, start, RULE_COLUMNS)


def train_fold(doc_id: Column) -> Column:
    """Rows the classifier may learn from."""
    return fold(doc_id, 5) != 0
