"""Quality classifier: a linear SVM over n-gram indicators scaled by class log-count ratios.

Features are indicators of byte n-grams (orders 2 to 4), words and word pairs,
hashed to 2**18 buckets; a word followed by itself is one pair of its own, as
repetition is what it tells. Each indicator is scaled by the naive Bayes
log-count ratio of its bucket and each document is scaled to unit length. A
hinge-loss linear model is fitted by dual coordinate descent, and a logistic
curve fitted on rows the descent has not seen turns its margin into a score.

The fit uses a bounded sample of labelled rows (``sample_rows``, 8000 by
default: about 100 MB of bucket numbers) inside one task, and sends the model,
2 MB, to the driver. Scoring reads every whole text; a task holds one Arrow batch
and a flag per bucket.

Defined cases: null and empty texts have no features and get the score of the
bias alone; without labels of both classes all rows get the smoothed share of
label 1; repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapstats.llm.common import SLICE, gives_back, parts_of, text_or_empty
from lapstats.llm.hashing import mark_byte_ngrams, mix, words
from lapstats.llm.labels import labelled_sample

BITS, ORDERS = 18, (2, 3, 4)
_REPEAT = 1


class Indicators:
    """Buckets of a text's n-grams, each once; reuses one flag array."""

    def __init__(self) -> None:
        self.flags = np.zeros(1 << BITS, bool)

    def __call__(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        for order in ORDERS:
            mark_byte_ngrams(data, order, self.flags)
        h, shift = words(data), np.uint64(64 - BITS)
        self.flags[h >> shift] = True
        if len(h) > 1:
            pair = mix(h[:-1] * np.uint64(3) + h[1:])
            pair[h[:-1] == h[1:]] = _REPEAT
            self.flags[pair >> shift] = True
        found = np.flatnonzero(self.flags)
        self.flags[found] = False
        return found.astype(np.int32)


@dataclass
class Model:
    """Per bucket: weight times ratio, and squared ratio; then bias and the logistic curve."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, found: np.ndarray) -> float:
        length = float(np.sqrt(self.square[found].sum(dtype=np.float64)))
        margin = float(self.weight[found].sum(dtype=np.float64)) / length if length > 0 else 0.0
        return float(1 / (1 + np.exp(-np.clip(self.slope * (margin + self.bias) + self.shift, -60, 60))))


def _length(ratio: np.ndarray, found: np.ndarray) -> float:
    return float(np.sqrt(ratio[found] @ ratio[found]))


def log_count_ratios(docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    count = {True: np.ones(1 << BITS), False: np.ones(1 << BITS)}
    for found, label in zip(docs, y, strict=True):
        count[label > 0][found] += 1
    return np.log(count[True] / count[True].sum()) - np.log(count[False] / count[False].sum())


def dual_coordinate_descent(docs: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: float = 4.0,
                            epochs: int = 15, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss linear SVM; the bias is a constant feature.

    A document's values, its ratios at unit length, are looked up at each visit,
    so that only bucket numbers are held.
    """
    w, bias, alpha = np.zeros(1 << BITS, np.float32), 0.0, np.zeros(len(docs))
    scale = np.array([1 / max(_length(ratio, d), 1e-12) for d in docs], np.float32)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in order.permutation(len(docs)):
            value = ratio[docs[i]] * scale[i]
            gradient = y[i] * (float(w[docs[i]] @ value) + bias) - 1
            new = min(max(alpha[i] - gradient / (float(value @ value) + 1), 0.0), cost)
            if step := new - alpha[i]:
                w[docs[i]] += np.float32(step * y[i]) * value
                bias, alpha[i], most = bias + step * y[i], new, max(most, abs(step))
        if most < 1e-3:
            break
    return w, bias


def logistic_curve(margin: np.ndarray, y: np.ndarray, steps: int = 50, count: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and shift of P(label 1 | margin), by Newton's method on smoothed targets; ``count`` rows share a margin and label."""
    count = np.ones(len(y)) if count is None else count
    pos, neg = int(count[y > 0].sum()), int(count[y < 0].sum())
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, p = np.stack([margin, np.ones_like(margin)], 1), np.array([1.0, 0.0])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        step = np.linalg.solve((x * (count * q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(2), x.T @ (count * (q - target)) + 1e-4 * p)
        p = p - np.clip(step, -2, 2)
    return float(p[0]), float(p[1])


def train(docs: list[np.ndarray], y: np.ndarray) -> Model:
    """Fit on 4 of 5 rows, calibrate on the fifth."""
    pos, n = int((y > 0).sum()), len(y)
    if pos in (0, n):
        share = (pos + 1) / (n + 2)
        zero = np.zeros(1 << BITS, np.float32)
        return Model(zero, zero, 0.0, 0.0, float(np.log(share / (1 - share))))
    aside = np.arange(n) % 5 == 4 if n >= 50 else np.zeros(n, bool)
    fit = np.flatnonzero(~aside)
    # The rows set aside are new to the ratios too, else their margins would be too sure.
    ratio = log_count_ratios([docs[i] for i in fit], y[fit]).astype(np.float32)
    w, bias = dual_coordinate_descent([docs[i] for i in fit], ratio, y[fit])
    held = np.flatnonzero(aside) if 0 < (y[aside] > 0).sum() < aside.sum() else np.arange(n)
    margin = np.array([float(w[docs[i]] @ ratio[docs[i]]) / max(_length(ratio, docs[i]), 1e-12) + bias for i in held])
    return Model(w * ratio, ratio * ratio, bias, *logistic_curve(margin, y[held]))


def fit(docs: DataFrame, labels: DataFrame, label: str, keep: Column, sample_rows: int = 8000) -> Model:
    """Train on at most ``sample_rows`` labelled documents of which ``keep`` (over labels) holds.

    The bounded sample ends in one task as it is; that task also trains, so that
    only the model reaches the driver.
    """
    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, ids, y, seen = Indicators(), [], [], []
        for b in batches:
            ids += b.column(0).to_pylist()
            y += b.column(1).to_pylist()
            seen += [found(t) for t in b.column(2).to_pylist()]
        # An order that does not depend on how the rows arrive.
        order = np.argsort(np.array(ids, np.int64), kind="stable")
        m = train([seen[i] for i in order], np.where(np.array(y, np.int64)[order] > 0, 1, -1))
        yield pa.RecordBatch.from_pydict({"weight": [m.weight.tobytes()], "square": [m.square.tobytes()],
                                          "bias": [float(m.bias)], "slope": [m.slope], "shift": [m.shift]})

    sample = labelled_sample(docs, labels, label, keep, sample_rows).withColumn("__id", F.xxhash64("__id"))
    rows = sample.coalesce(1).mapInArrow(
        gives_back(trained), "weight binary, square binary, bias double, slope double, shift double").collect()
    if not rows:  # an empty sample may have no task at all
        return train([], np.zeros(0, np.int64))
    m = rows[0]
    return Model(np.frombuffer(m["weight"], np.float32), np.frombuffer(m["square"], np.float32),
                 m["bias"], m["slope"], m["shift"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, m = Indicators(), shared.value
        for b in batches:
            of = [m.score(found(t)) for p in parts_of(b, 1, SLICE) for t in p.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(of, pa.float64())], names=["doc_id", "score"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("__text"))
    out = T.StructType([T.StructField("doc_id", narrow.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())])
    return narrow.mapInArrow(gives_back(scores), out)


def keep_good(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns.

    Only texts go to Python, and only a flag comes back; the rows stay where they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def flags(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found, m = Indicators(), shared.value
        for texts in series:
            yield pd.Series([m.score(found(t)) >= threshold for t in texts], dtype=bool)

    def good(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from gives_back(flags)(series)

    return docs.filter(F.pandas_udf(good, "boolean")(text_or_empty(F.col(text_col))))
