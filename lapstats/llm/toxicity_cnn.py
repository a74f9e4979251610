"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Each word has two hashed embeddings, one of the word and one of its stem (its
first five bytes), set side by side: inflected and compound forms share a stem,
and a word that shares a bucket with another in one table differs in the other. Filters of one, two and three words run over the whole text, each
keeps its largest activation, and a logistic layer turns these into a score.
Gradients reach the words at which a filter was largest, so a step touches few
rows of the tables. A logistic curve fitted on rows that training left out
calibrates the score; per language, the threshold that gives the best F1 on
those rows is kept beside the common one. Language is never an input of a score.

The fit uses every labelled row, whole. Rows are dealt to tasks of at most ``TASK_ROWS``
rows and ``TASK_BYTES`` bytes of text; in each of ``ROUNDS`` rounds all tasks start from one network and
train it on their own rows, and Spark averages what each of them changed. The rows set aside are
counted by label, language and activation in steps of 1/``STEPS``, which is all that calibration and
thresholds need; so only the model and these counts reach the driver. Scoring reads every whole
text in pieces of bounded size that overlap by the widest filter.

Defined cases: null texts and texts without words get the score of no activation;
without labels of both classes all rows get the smoothed share of label 1; a
language without enough labels has the common threshold; repeated rows are
scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapstats.llm.common import text_or_empty
from lapstats.llm.hashing import words
from lapstats.llm.labels import labelled_rows
from lapstats.llm.quality_nbsvm import logistic_curve
from lapstats.session import materialize

BITS, DIM, WIDTHS, FILTERS, STEM = 17, 6, (1, 2, 3), 6, 5
#: Words that are convolved at a time.
PIECE = 1 << 17
#: Labelled rows of both classes that a language needs for a threshold of its own.
LEAST_BY_LANGUAGE = 20
#: Rounds of training, and passes of a task over its rows in each.
ROUNDS, EPOCHS = 2, 4
#: Rows, and bytes of text, of one training task.
TASK_ROWS, TASK_BYTES = 30_000, 100_000_000
#: Activations of the rows set aside are counted in steps of 1/STEPS from -LIMIT to LIMIT.
STEPS, LIMIT = 64, 60


def buckets(text: str) -> np.ndarray:
    """Rows of the word and the stem table for each word, as one (words, 2) array."""
    h = words(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), STEM)
    return (h >> np.uint64(64 - BITS)).astype(np.int32) + np.array([0, 1 << BITS], np.int32)


@dataclass
class Model:
    table: np.ndarray
    filters: list[np.ndarray]
    offsets: list[np.ndarray]
    out: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    threshold: dict[str, float] = field(default_factory=dict)

    def maxima(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest activation of every filter over a text, and the word where it begins (-1: none)."""
        top = np.zeros(len(self.out), np.float32)
        place = np.full(len(self.out), -1, np.int64)
        reach = max(WIDTHS) - 1
        for at in range(0, len(found), PIECE):
            e = self.table[found[at:at + PIECE + reach]].reshape(-1, 2 * DIM)
            for k, (f, b) in enumerate(zip(self.filters, self.offsets, strict=True)):
                n = min(len(e) - WIDTHS[k] + 1, PIECE)
                if n <= 0:
                    continue
                a = e[:n] @ f[0]
                for i in range(1, WIDTHS[k]):
                    a += e[i:n + i] @ f[i]
                where = a.argmax(0)
                best = a[where, np.arange(FILTERS)] + b
                s = slice(k * FILTERS, (k + 1) * FILTERS)
                better = best > top[s]
                top[s][better], place[s][better] = best[better], where[better] + at
        return top, place

    def logit(self, found: np.ndarray) -> float:
        return float(self.maxima(found)[0] @ self.out) + self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.logit(found) + self.shift, -60, 60))))


class _Adagrad:
    def __init__(self, rate: float, seen: dict[str, np.ndarray] | None = None) -> None:
        self.rate, self.seen = rate, seen or {}

    def step(self, name: str, value: np.ndarray, gradient: np.ndarray, rows=slice(None)) -> None:
        seen = self.seen.setdefault(name, np.full(value.shape, 1e-3, np.float32))
        seen[rows] += gradient * gradient
        value[rows] -= self.rate * gradient / np.sqrt(seen[rows])


def untrained(seed: int = 11) -> Model:
    order = np.random.default_rng(seed)
    width = len(WIDTHS) * FILTERS
    return Model(order.normal(0, 0.1, (2 << BITS, DIM)).astype(np.float32),
                 [order.normal(0, 0.4, (w, 2 * DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                 [np.full(FILTERS, 0.1, np.float32) for _ in WIDTHS],
                 (np.abs(order.normal(0.3, 0.1, width)) * np.where(np.arange(width) % 3 == 2, -1, 1)).astype(np.float32))


def train(docs: list[np.ndarray], y: np.ndarray, model: Model, weights: tuple[float, float], epochs: int = EPOCHS,
          seen: dict[str, np.ndarray] | None = None, batch: int = 32, rate: float = 0.08,
          seed: int = 11) -> dict[str, np.ndarray]:
    """Train ``model`` in place on word rows and labels 0/1, which weigh ``weights``; returns the sums of squared gradients."""
    order = np.random.default_rng(seed)
    width = len(WIDTHS) * FILTERS
    weight = np.where(y > 0, weights[1], weights[0])
    adagrad, bias = _Adagrad(rate, seen), np.array([model.bias], np.float32)
    for _ in range(epochs):
        dealt = order.permutation(len(docs))
        for at in range(0, len(dealt), batch):
            grad_out, grad_bias = np.zeros(width, np.float32), 0.0
            grad_f = [np.zeros_like(f) for f in model.filters]
            grad_b = [np.zeros_like(b) for b in model.offsets]
            rows, steps = [], []
            chosen = dealt[at:at + batch]
            for d in chosen:
                top, place = model.maxima(docs[d])
                p = 1 / (1 + np.exp(-np.clip(float(top @ model.out) + float(bias[0]), -30, 30)))
                g = np.float32((p - y[d]) * weight[d] / len(chosen))
                grad_out += g * top
                grad_bias += float(g)
                back = g * model.out
                for c in np.flatnonzero((place >= 0) & (top > 0)):
                    k, j = divmod(int(c), FILTERS)
                    grad_b[k][j] += back[c]
                    for i in range(WIDTHS[k]):
                        row = docs[d][place[c] + i]
                        grad_f[k][i, :, j] += back[c] * model.table[row].reshape(-1)
                        rows.append(row)
                        steps.append((back[c] * model.filters[k][i, :, j]).reshape(2, DIM))
            adagrad.step("out", model.out, grad_out)
            adagrad.step("bias", bias, np.array([grad_bias], np.float32))
            for k in range(len(WIDTHS)):
                adagrad.step(f"f{k}", model.filters[k], grad_f[k])
                adagrad.step(f"b{k}", model.offsets[k], grad_b[k])
            if rows:
                touched, where = np.unique(np.concatenate(rows), return_inverse=True)
                total = np.zeros((len(touched), DIM), np.float32)
                np.add.at(total, where, np.concatenate(steps))
                adagrad.step("table", model.table, total, touched)
    model.bias = float(bias[0])
    return adagrad.seen


def _best_threshold(score: np.ndarray, y: np.ndarray, count: np.ndarray) -> float:
    """The score from which on F1 is largest; the higher one of ties. ``count`` rows share a score and label."""
    order = np.argsort(-score, kind="stable")
    hit = np.cumsum((y * count)[order])
    f1 = 2 * hit / (np.cumsum(count[order]) + (y * count).sum())
    ends = np.append(score[order][1:] != score[order][:-1], True)
    return float(score[order][np.flatnonzero(ends)[f1[ends].argmax()]])


def _flat(model: Model, seen: dict[str, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """All weights as rows of ``DIM``, the table's first, and their sums of squared gradients."""
    parts = {"table": model.table, "out": model.out, "bias": np.array([model.bias], np.float32)}
    for k, (f, b) in enumerate(zip(model.filters, model.offsets, strict=True)):
        parts |= {f"f{k}": f, f"b{k}": b}
    rows = lambda of: np.concatenate([np.resize(np.append(x.ravel(), np.zeros(-x.size % DIM, np.float32)), (-(-x.size // DIM), DIM))
                                      for x in of]).astype(np.float32)
    first = {name: np.full(x.shape, 1e-3, np.float32) for name, x in parts.items()}
    return rows(parts.values()), rows((first | (seen or {}))[name] for name in parts)


def _unflat(values: np.ndarray, squares: np.ndarray) -> tuple[Model, dict[str, np.ndarray]]:
    shape = {"table": (2 << BITS, DIM), "out": (len(WIDTHS) * FILTERS,), "bias": (1,)}
    for k, w in enumerate(WIDTHS):
        shape |= {f"f{k}": (w, 2 * DIM, FILTERS), f"b{k}": (FILTERS,)}
    at, value, seen = 0, {}, {}
    for name, size in shape.items():
        n = int(np.prod(size))
        end = at + -(-n // DIM)
        value[name], seen[name] = (a[at:end].ravel()[:n].reshape(size).copy() for a in (values, squares))
        at = end
    return Model(value["table"], [value[f"f{k}"] for k in range(len(WIDTHS))], [value[f"b{k}"] for k in range(len(WIDTHS))],
                 value["out"], float(value["bias"][0])), seen


def _round(rows: DataFrame, model: Model, seen: dict[str, np.ndarray] | None, weights: tuple[float, float],
           number: int) -> tuple[Model, dict[str, np.ndarray]]:
    """One round: every task (``__part``) trains on its rows from the same network; what changed is averaged over
    the tasks that changed it, by row of ``_flat``."""
    start = _flat(model, seen)
    shared = rows.sparkSession.sparkContext.broadcast(start)
    names = [f"v{i}" for i in range(DIM)] + [f"s{i}" for i in range(DIM)]

    def trained(t: pa.Table) -> pa.Table:
        t = t.sort_by([("__hash", "ascending"), ("__order", "ascending")])
        own, squares = _unflat(*shared.value)
        found = [buckets(x) for x in t.column("__text").to_pylist()]
        y = (t.column("__y").to_numpy() > 0).astype(np.float32)
        squares = train(found, y, own, weights, EPOCHS, squares, seed=11 + number)
        values = _flat(own, squares)
        change = np.concatenate([a - b for a, b in zip(values, shared.value, strict=True)], 1)
        at = np.flatnonzero(change.any(1))
        return pa.table({"__row": pa.array(at.astype(np.int32)), **{c: pa.array(change[at, i]) for i, c in enumerate(names)}})

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            table = [b.column(i).to_numpy() for i in range(b.num_columns)]
            yield pa.RecordBatch.from_pydict({"__rows": pa.array([table[0].astype(np.int32).tobytes()], pa.binary()),
                                              "__means": pa.array([np.stack(table[1:], 1).astype(np.float32).tobytes()], pa.binary())})

    changes = rows.groupBy("__part").applyInArrow(trained, "__row int, " + ", ".join(f"{c} float" for c in names))
    means = changes.groupBy("__row").agg(*[F.avg(c).cast("float").alias(c) for c in names])
    values, squares = (a.copy() for a in start)
    for r in means.mapInArrow(packed, "__rows binary, __means binary").collect():
        at, mean = np.frombuffer(r["__rows"], np.int32), np.frombuffer(r["__means"], np.float32).reshape(-1, 2 * DIM)
        values[at] += mean[:, :DIM]
        squares[at] += mean[:, DIM:]
    shared.unpersist()
    return _unflat(values, squares)


def _activations(rows: DataFrame, model: Model) -> list:
    """Number of ``rows`` per label, language and activation in steps of 1/``STEPS``: __y, __lang, __step, __n."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([shared.value.logit(buckets(t)) for t in b.column(2).to_pylist()], float)
            step = np.rint(np.clip(x, -LIMIT, LIMIT) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(step)], names=["__y", "__lang", "__step"])

    return (rows.select((F.col("__y") > 0).cast("int").alias("__y"), F.coalesce("__lang", F.lit("")).alias("__lang"), "__text")
            .mapInArrow(steps, "__y int, __lang string, __step int").groupBy("__y", "__lang", "__step")
            .agg(F.count("*").alias("__n")).orderBy("__lang", "__step", "__y").collect())


def fit(docs: DataFrame, labels: DataFrame, label: str, keep: Column, common_threshold: float = 0.7) -> Model:
    """Train on all labelled documents of which ``keep`` (over labels) holds: on 4 of 5, and calibrate and choose
    thresholds on the fifth (with fewer than 50 rows, on all)."""
    lang = (docs["lang"] if "lang" in docs.columns else F.lit(None)).cast("string").alias("__lang")
    rows = labelled_rows(docs, labels, label, keep, lang)
    rows = materialize(rows.withColumn("__hash", F.xxhash64("__id")).withColumn("__order", F.xxhash64("__text")).withColumn(
        "__fifth", F.pmod(F.xxhash64(F.lit(3), "__id"), F.lit(5)).cast("int")), "labelled")
    size = {r["__aside"]: r for r in rows.groupBy((F.col("__fifth") == 4).alias("__aside")).agg(
        F.count("*").alias("n"), F.count_if(F.col("__y") > 0).alias("pos"), F.sum(F.octet_length("__text")).alias("bytes")).collect()}
    n, pos = (sum(r[c] for r in size.values()) for c in ("n", "pos"))
    if pos in (0, n):
        none = untrained()
        none.out[:] = 0
        none.shift = float(np.log((pos + 1) / (n - pos + 1)))
        return none
    mixed = lambda r: r is not None and 0 < r["pos"] < r["n"]
    apart = n >= 50 and mixed(size.get(False))
    used = [size[False]] if apart else list(size.values())
    n_used, pos_used, n_bytes = (sum(r[c] for r in used) for c in ("n", "pos", "bytes"))
    tasks = max(-(-n_used // TASK_ROWS), -(-n_bytes // TASK_BYTES), 1)
    weights = n_used / (2 * max(n_used - pos_used, 1)), n_used / (2 * max(pos_used, 1))
    learned = (rows.where("__fifth < 4") if apart else rows).withColumn("__part", F.pmod(F.xxhash64(F.lit(5), "__id"), F.lit(tasks)))
    model, seen = untrained(), None
    for number in range(ROUNDS):
        model, seen = _round(learned.select("__part", "__hash", "__order", "__text", "__y"), model, seen, weights, number)
    held = _activations(rows.where("__fifth = 4") if apart and mixed(size.get(True)) else rows, model)
    y, logit, count = (np.array([r[c] for r in held]) for c in ("__y", "__step", "__n"))
    logit, langs = logit / STEPS, np.array([r["__lang"] for r in held], dtype=object)
    model.slope, model.shift = logistic_curve(logit, np.where(y > 0, 1, -1), count=count)
    score = 1 / (1 + np.exp(-np.clip(model.slope * logit + model.shift, -60, 60)))
    model.threshold = {"": common_threshold}
    for name in sorted(set(langs) - {""}):
        of = langs == name
        if min(count[of & (y > 0)].sum(), count[of & (y == 0)].sum()) >= LEAST_BY_LANGUAGE:
            model.threshold[str(name)] = _best_threshold(score[of], y[of], count[of])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """doc_id, score, and toxic: whether the score reaches the threshold of the row's language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = [m.score(buckets(t)) for t in b.column(1).to_pylist()]
            least = [m.threshold.get(x or "", m.threshold.get("", 0.5)) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s, pa.float64()), pa.array([x >= t for x, t in zip(s, least, strict=True)], pa.bool_())],
                names=["doc_id", "score", "toxic"])

    lang = (F.col(lang_col) if lang_col in docs.columns else F.lit(None)).cast("string").alias("__lang")
    narrow = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("__text"), lang)
    return narrow.mapInArrow(scores, T.StructType([T.StructField("doc_id", narrow.schema["doc_id"].dataType),
                                                   T.StructField("score", T.DoubleType()), T.StructField("toxic", T.BooleanType())]))
