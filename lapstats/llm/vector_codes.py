"""Vector code compression: one small codebook entry number per part of a vector.

A vector's components become integers, floor(scale * x), and are cut into equal
parts. Each part position has a codebook of a few entries, fitted by rounds of
assigning every part to its nearest entry and moving each entry to the floored
mean of its parts.

Nearest entry, by slice and intersect: a codebook keeps, for each dimension, its
entries' coordinates in order with the mask of the entries before each place. A
radius selects one range of places per dimension, whose entries are the
difference of two masks; the AND over the dimensions leaves the entries inside
the cube around the part. Only these are measured. An entry outside the cube is
further away than the radius in some dimension, so a candidate nearer than that
is the answer; else the cube grows to the distance of the best candidate, or to
twice its size when it was empty.

A round reads the integer vectors once; each task sends one row of sums per
entry and dimension, so what is shuffled and collected depends on the codebooks'
size alone. Sums are integers, so results don't depend on the order of rows.

Defined cases: a vector that is null or holds null or non-finite components is
dropped; shorter vectors count as ending in zeros, up to the longest length
rounded up to whole parts; the rows that start the codebooks are those of the
smallest ids (null ids last, then by components); rows that repeat an id or a
vector are rows of their own; with fewer rows than entries the codebooks are
smaller; null labels form one group; an empty table gives an empty result; other
columns are ignored. Components must stay below 2**28 in size, so that squared
distances fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapstats.llm import vectors
from lapstats.llm.common import small_or_shuffled
from lapstats.session import materialize

_FAR = np.iinfo(np.int64).max
#: Rows measured against all entries to choose the initial radius of a batch.
_PROBE = 64


class Codebook:
    """Entries of one part position, with their prefix masks per dimension."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        m, dims = entries.shape
        self.words = max(-(-m // 64), 1)
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, 0).T.copy()
        self.prefix = np.zeros((dims, m + 1, self.words), np.uint64)
        for d in range(dims):
            for place, e in enumerate(order[:, d]):
                self.prefix[d, place + 1] = self.prefix[d, place]
                self.prefix[d, place + 1, e // 64] |= np.uint64(1) << np.uint64(e % 64)

    def inside(self, rows: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries of which no coordinate is further than ``radius`` from the row's."""
        mask = np.repeat(self.everything()[None], len(rows), 0)
        for d in range(rows.shape[1]):
            low = np.searchsorted(self.sorted[d], rows[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[d], rows[:, d] + radius, "right")
            mask &= self.prefix[d, high] ^ self.prefix[d, low]
        return mask

    def everything(self) -> np.ndarray:
        m = len(self.entries)
        return np.array([(1 << min(64, m - 64 * w)) - 1 for w in range(self.words)], np.uint64)

    def nearest(self, rows: np.ndarray, radius: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Entry number (lowest on ties) and squared distance of each row."""
        best, chosen = np.full(len(rows), _FAR), np.zeros(len(rows), np.int64)
        if not len(rows):
            return chosen, best
        if radius is None:
            probe = rows[::max(len(rows) // _PROBE, 1)]
            least = ((probe[:, None] - self.entries) ** 2).sum(2).min(1)
            radius = int(np.sqrt(np.quantile(least, 0.9)))
        todo, reach = np.arange(len(rows)), np.full(len(rows), radius, np.int64)
        while len(todo):
            mask = self.inside(rows[todo], reach[todo])
            for e in range(len(self.entries)):
                at = todo[(mask[:, e // 64] >> np.uint64(e % 64)) & np.uint64(1) == 1]
                distance = ((rows[at] - self.entries[e]) ** 2).sum(1)
                nearer = (distance < best[at]) | ((distance == best[at]) & (e < chosen[at]))
                at, distance = at[nearer], distance[nearer]
                best[at], chosen[at] = distance, e
            found = best[todo] < _FAR
            # Whole numbers: outside the cube some difference is reach + 1 at least.
            open_ = np.where(found, best[todo], 0) >= (reach[todo] + 1) ** 2
            reach[todo] = np.where(found, np.ceil(np.sqrt(best[todo])).astype(np.int64) + 1, 2 * reach[todo] + 1)
            todo = todo[open_ | ~found]
        return chosen, best


@dataclass
class Codebooks:
    """Entries by part position: an array of parts x entries x dimensions."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        """Of all entries' components as decimal integers joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers and squared distances, rows x parts."""
        parts, _, dims = self.entries.shape
        found = [Codebook(self.entries[p]).nearest(rows[:, p * dims:(p + 1) * dims]) for p in range(parts)]
        return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def integers(df: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> DataFrame:
    """vec_id, label and the integer vector of every usable row, written once for the rounds."""
    vector = F.col(vector_col)
    return materialize(df.filter(vectors.usable(vector)).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), vectors.scaled(vector, scale).alias("v")), "vectors")


def _moved(rows: DataFrame, books: Codebooks, total: int) -> Codebooks:
    """One round: entries at the floored mean of their parts; unused ones stay."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    parts, m, dims = books.entries.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, m, dims), np.int64), np.zeros((parts, m), np.int64)
        for b in batches:
            x = vectors.matrix(b.column(0), total)
            chosen, _ = shared.value.assign(x)
            for p in range(parts):
                np.add.at(sums[p], chosen[:, p], x[:, p * dims:(p + 1) * dims])
                counts[p] += np.bincount(chosen[:, p], minlength=m)
        p, e, d = np.indices((parts, m, dims)).reshape(3, -1)
        used = counts[p, e] > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[used].astype(np.int64)) for x in (p, e, d, sums.ravel(), counts[p, e])], names=["p", "e", "d", "s", "n"])

    entries = books.entries.copy()
    # A row per entry and dimension: bounded by the codebooks, whatever the table holds.
    for r in (rows.select("v").mapInArrow(summed, "p long, e long, d long, s long, n long")
              .groupBy("p", "e", "d").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()):
        entries[r.p, r.e, r.d] = r.s // r.n
    return Codebooks(entries)


def fit(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> Codebooks:
    """Codebooks fitted on all rows of ``integers``, starting at the rows of the smallest ids."""
    dims = -(-vectors.width(rows, "v") // parts)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = np.zeros((len(first), parts * dims), np.int64)
    for i, r in enumerate(first):
        start[i, :len(r.v)] = r.v
    books = Codebooks(start.reshape(len(first), parts, dims).transpose(1, 0, 2).copy())
    for _ in range(rounds if first else 0):
        books = _moved(rows, books, parts * dims)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (squared distances added up) of every row."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    parts, m, dims = books.entries.shape
    digits = -(-max(m - 1, 255).bit_length() // 4)
    text = np.array([f"{e:0{digits}x}" for e in range(max(m, 1))])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chosen, distance = shared.value.assign(vectors.matrix(b.column(2), parts * dims))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(["".join(r) for r in text[chosen].tolist()], pa.string()),
                 pa.array(distance.sum(1, dtype=np.int64))], names=["vec_id", "label", "code", "error"])

    out = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.StringType()),
                        T.StructField("error", T.LongType())])
    return rows.select("vec_id", "label", "v").mapInArrow(coded, out)


def decode(codes: list[str], books: Codebooks) -> np.ndarray:
    """The integer vectors that codes stand for, a row each."""
    parts, m, dims = books.entries.shape
    if not codes:
        return np.zeros((0, parts * dims), np.int64)
    digits = len(codes[0]) // parts
    chosen = np.array([[int(c[p * digits:(p + 1) * digits], 16) for p in range(parts)] for c in codes], np.int64)
    return books.entries[np.arange(parts), chosen].reshape(len(codes), parts * dims)


def compress(df: DataFrame, scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks]:
    """Every usable row's vec_id, label, code, error and label_error (errors added up over equal labels), and the codebooks."""
    rows = integers(df, scale, id_col, vector_col, label_col)
    books = fit(rows, parts, entries, rounds)
    coded = materialize(encode(rows, books), "vector-codes")
    of_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    of_label = small_or_shuffled(materialize(of_label, "label-errors"))
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("__label"))).drop("__label"), books
