"""Exact top-k search by inner product with a vector-approximation file.

Components become integers, floor(scale * x). Equal vectors are searched once:
of each distinct vector only its k + 1 smallest ids can enter a result.

1. Approximation file: per dimension, the range of all vectors is cut into 256
   equal cells, and a vector is the byte string of its cell numbers. It is packed
   into blocks of ``ROWS`` vectors, the distinct query vectors into blocks of
   ``QUERIES``.
2. Scan: every block of queries meets every block of cells. A cell bounds the
   inner product from above and below; a block keeps, of each query, the vectors
   whose upper bound reaches the (k+1)-th largest lower bound. Then the same
   holds over all blocks.
3. Exact vectors are read in the order of their bounds: first those with the
   best upper bounds, which gives a score that the result has to reach, then all
   others whose upper bound still reaches it. Nothing else can enter the result.

The number of pairs of blocks grows with the square of the table, as an exact
search of a fixed share of its rows must; a task holds one pair of blocks at a
time, bounded whatever the table's size, and the bounds are a matrix product.

Defined cases: a row with a null id, or a vector that is null or holds null or
non-finite components, takes no part; shorter vectors count as ending in zeros;
rows equal in id and vector are one row; an id with several vectors is a query
with each of them, against the rows of all other ids; with fewer than k rows all
are returned; ties go to the smaller id; an empty table gives an empty result;
other columns are ignored. Scores must stay below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapstats.llm import vectors
from lapstats.session import materialize

CELLS = 256
#: Vectors of a block of the approximation file, and query vectors of a block of queries (expected sizes).
ROWS, QUERIES = 16_384, 1_024
#: Queries of a block that are bounded at a time: their bounds take CHUNK * ROWS doubles.
CHUNK = 128


def distinct_vectors(df: DataFrame, scale: int, keep: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vid (a number of its own), v, and the ``keep`` smallest ids of every distinct vector.

    Ranks are cut in each task before the shuffle, so copies of a vector don't meet in one task.
    """
    vector = F.col(vector_col)
    rows = df.filter(F.col(id_col).isNotNull() & vectors.usable(vector)).select(
        F.col(id_col).alias("id"), vectors.scaled(vector, scale).alias("v")).distinct()
    by_id = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("__n", F.row_number().over(by_id)).filter(F.col("__n") <= keep)
    return materialize(few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
                       .select(F.monotonically_increasing_id().alias("vid"), "v", "ids"), "topk-vectors")


def _spread(df: DataFrame, columns: int) -> np.ndarray:
    """Least and largest value per dimension, 2 x columns; one row per task and dimension is shuffled."""
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(columns, np.iinfo(np.int64).max), np.full(columns, np.iinfo(np.int64).min)
        some = False
        for b in batches:
            if b.num_rows:
                x = vectors.matrix(b.column(0), columns)
                low, high, some = np.minimum(low, x.min(0)), np.maximum(high, x.max(0)), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(columns)), pa.array(low), pa.array(high)], names=["d", "low", "high"])

    out = np.zeros((2, columns), np.int64)
    for r in (df.select("v").mapInArrow(ranges, "d long, low long, high long").groupBy("d")
              .agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()):
        out[:, r.d] = r.low, r.high
    return out


def _packed(df: DataFrame, columns: int, per_block: int, total: int, spread: np.ndarray | None) -> DataFrame:
    """block, ids and vectors of about ``per_block`` rows each; with ``spread``, cell numbers in place of the components."""
    blocks = max(-(-total // per_block), 1)

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("vid").combine_chunks()
        x = vectors.matrix(t.column("v").chunk(0), columns)
        if spread is None:
            data = x.astype("<i8")
        else:
            low, step = _cells(spread)
            data = ((x - low) // step).astype(np.uint8)
        return pa.table({"block": t.column("block").slice(0, 1), "vids": [t.column("vid").to_numpy().astype("<i8").tobytes()],
                         "data": [data.tobytes()]})

    dealt = df.select("vid", "v", F.pmod(F.xxhash64("vid"), F.lit(blocks)).cast("int").alias("block"))
    return dealt.groupBy("block").applyInArrow(pack, "block int, vids binary, data binary")


def _cells(spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of the first cell and width of the cells, per dimension."""
    return spread[0], (spread[1] - spread[0]) // CELLS + 1


def upper_bounds(queries: np.ndarray, cells: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest inner product of each query with each cell, and by how much the least is below it."""
    low, step = _cells(spread)
    start = cells.astype(np.float64) * step + low
    up = queries.astype(np.float64) @ start.T + (np.maximum(queries, 0) * (step - 1)).sum(1)[:, None]
    return up, (np.abs(queries) * (step - 1)).sum(1)


def _candidates(pairs: DataFrame, columns: int, spread: np.ndarray, k: int) -> DataFrame:
    """query, vid, up and down (bounds of the score) of what may be among the first k of its block."""
    shared = pairs.sparkSession.sparkContext.broadcast(spread)

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                qids, qdata, vids, cells = (b.column(c)[row].as_py() for c in range(4))
                qids, vids = np.frombuffer(qids, "<i8"), np.frombuffer(vids, "<i8")
                queries = np.frombuffer(qdata, "<i8").reshape(len(qids), columns)
                cells = np.frombuffer(cells, np.uint8).reshape(len(vids), columns)
                for at in range(0, len(qids), CHUNK):
                    up, wide = upper_bounds(queries[at:at + CHUNK], cells, shared.value)
                    if len(vids) > k:
                        least = np.partition(up, len(vids) - k, axis=1)[:, len(vids) - k] - wide
                    else:
                        least = np.full(len(up), -np.inf)
                    q, v = np.nonzero(up >= least[:, None])
                    top = up[q, v].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(qids[at + q]), pa.array(vids[v]), pa.array(top), pa.array(top - wide[q])],
                        names=["query", "vid", "up", "down"])

    return pairs.mapInArrow(bounded, "query long, vid long, up long, down long")


def _kth(df: DataFrame, value: str, k: int, name: str) -> DataFrame:
    """Per query the k-th largest ``value``; least of all where there are fewer than k, so that nothing is cut."""
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc(value)))).filter(F.col("__n") <= k)
    return ranked.groupBy("query").agg(F.when(F.count(F.lit(1)) == k, F.min(value)).alias(name))


def _exact(pairs: DataFrame, distinct: DataFrame) -> DataFrame:
    """query, vid and score of pairs, from the exact vectors."""
    of = lambda name, vector: distinct.select(F.col("vid").alias(name), F.col("v").alias(vector))
    product = F.aggregate(F.zip_with("a", "b", lambda x, y: F.coalesce(x, F.lit(0)) * F.coalesce(y, F.lit(0))),
                          F.lit(0).cast("long"), lambda total, x: total + x)
    return pairs.select("query", "vid").join(of("query", "a"), "query").join(of("vid", "b"), "vid").select(
        "query", "vid", product.alias("score"))


def search(df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: for each row of which ``is_query`` (over ``id_col``) holds, the k best other rows."""
    keep = k + 1  # a query's own row may be among the first
    distinct = distinct_vectors(df, scale, keep, id_col, vector_col)
    asked = df.filter(is_query & F.col(id_col).isNotNull() & vectors.usable(F.col(vector_col))).select(
        F.col(id_col).alias("query_id"), vectors.scaled(F.col(vector_col), scale).alias("v")).distinct()
    asked = materialize(asked.join(distinct.select("vid", "v"), "v").select("query_id", F.col("vid").alias("query")), "topk-asked")
    queries = materialize(asked.select(F.col("query").alias("vid")).distinct().join(distinct.select("vid", "v"), "vid"), "topk-queries")

    columns, total, count = vectors.width(distinct, "v"), distinct.count(), queries.count()
    spread = _spread(distinct, columns)
    rows = materialize(_packed(distinct, columns, ROWS, total, spread), "topk-cells")
    ask = materialize(_packed(queries, columns, QUERIES, count, None), "topk-query-blocks")
    # Blocks of queries go to every block of rows: an equality join on the number of the row block.
    blocks = max(-(-total // ROWS), 1)
    ask = ask.select(F.col("vids").alias("qids"), F.col("data").alias("qdata"),
                     F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    pairs = ask.join(rows, "block").select("qids", "qdata", "vids", "data")
    found = materialize(_candidates(pairs, columns, spread, keep), "topk-candidates")

    # Vectors stand for one id at least, so keep of them fill the result.
    reach = _kth(found, "down", keep, "reach")
    left = materialize(found.join(reach, "query").filter(F.col("reach").isNull() | (F.col("up") >= F.col("reach")))
                       .withColumn("__n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("up"), "vid"))),
                       "topk-left")
    first = materialize(_exact(left.filter(F.col("__n") <= 2 * keep), distinct), "topk-first")
    enough = _kth(first, "score", keep, "enough")
    rest = left.filter(F.col("__n") > 2 * keep).join(enough, "query").filter(F.col("up") >= F.col("enough"))
    scored = first.unionByName(_exact(rest, distinct))

    # Expand to ids: of each query vector the first k + 1, then each query leaves its own out.
    ids = scored.join(distinct.select("vid", F.explode("ids").alias("id")), "vid")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    top = ids.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= keep).groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct("__n", "id", "score"))).alias("top"))
    others = F.slice(F.filter("top", lambda t: t["id"] != F.col("query_id")), 1, k)
    return (asked.join(top, "query").select("query_id", F.posexplode(others).alias("at", "t"))
            .select(F.col("query_id"), (F.col("at") + 1).alias("rank"), F.col("t.id").alias("vec_id"), F.col("t.score").alias("score")))
