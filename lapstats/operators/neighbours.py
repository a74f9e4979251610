"""Exact nearest neighbours per key with k-d cells and box bounds (M9).

1. Cells: a k-d tree of median splits is fitted per key on a bounded sample of
   its training rows (``SAMPLE``); it is a value, descended inside the row. Where
   the splits lie decides only how much is pruned, never the result.
2. Every training row falls into a cell. A cell's box is the range of its own
   rows in every dimension; neighbouring cells form a group with a box of its own.
3. A query's k-th distance within its home cell bounds the true one. Groups,
   then cells, whose box is further away cannot hold a neighbour; the rows of
   all others are measured. That is the certificate: nothing else can be nearer,
   or as near with a smaller id.

A query meets a cell as one row: the rows of the cell are measured in numpy, and
only the k nearest of them leave the task, so what is shuffled grows with queries
and cells met, not with the rows measured. A cell with many queries is dealt to
several tasks. Of training rows with the same features the k with the smallest ids
are kept, for no other can be among the k nearest; so a cell stays bounded.

The bound of a box adds up the same terms in the same order as the distance, so
rounding never puts a box beyond a row in it. Work per query is the groups of
its key, the cells of the groups left and the rows of the cells left; no window
or task holds a key. In many dimensions bounds prune little, and the search
reads up to all cells; it stays exact.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapstats.functions.aggregates import checked_broadcast
from lapstats.operators.treevalue import descend
from lapstats.session import materialize

#: Training rows per key on which the splits are fitted (expected number), and rows of a cell.
SAMPLE, CELL_ROWS = 16_384, 32
#: Rows of a cell that is measured in numpy, up to FEW_FEATURES features and beyond: with more, bounds prune less.
BLOCK_ROWS, FEW_FEATURES, WIDE_BLOCK_ROWS = 1_024, 8, 16_384
#: Queries that meet a cell in one task, and distances that are held at a time.
TASK_QUERIES, HELD = 20_000, 1 << 18
#: One query in so many is counted to see how many tasks a cell needs. A wrong guess changes the tasks, not the rows.
COUNTED = 16
_NODES = "array<struct<feature:int,threshold:double,left:int,right:int,cell:int,grp:int>>"


def _split(x: np.ndarray, least: int) -> tuple[list[tuple], int]:
    """Nodes of a k-d tree whose leaves hold ``least`` to about 2 * ``least`` rows, and its depth."""
    nodes: list[list] = []
    todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(x)), -1, 0)]
    leaves, deepest = 0, 0
    while todo:
        rows, parent, depth = todo.pop()
        at = len(nodes)
        if parent >= 0:
            nodes[parent][2 if nodes[parent][2] is None else 3] = at
        deepest = max(deepest, depth)
        spread = np.ptp(x[rows], axis=0) if len(rows) else np.zeros(x.shape[1])
        f = int(spread.argmax()) if len(rows) >= 2 * least and spread.max() > 0 else -1
        left = None
        if f >= 0:
            threshold = float(np.partition(x[rows, f], (len(rows) - 1) // 2)[(len(rows) - 1) // 2])
            left = x[rows, f] <= threshold
            if left.all():  # more than half share the largest value
                threshold = float(x[rows, f][x[rows, f] < x[rows, f].max()].max())
                left = x[rows, f] <= threshold
        if left is None:
            nodes.append([None, None, None, None, leaves, None])
            leaves += 1
            continue
        nodes.append([f, threshold, None, None, None, None])
        todo += [(rows[~left], at, depth + 1), (rows[left], at, depth + 1)]  # the left one is next
    # Cells were numbered from left to right, so neighbours in number are neighbours in space.
    per_group = max(int(np.sqrt(leaves)), 1)
    for n in nodes:
        if n[4] is not None:
            n[5] = n[4] // per_group
    return [tuple(n) for n in nodes], deepest


def _alike(train: DataFrame, query: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``train`` and ``query`` with key columns of one type each, as a union would give them.

    Groups of two tables meet in one task only if their keys hash alike, and equal
    numbers of two types do not.
    """
    both = train.select(*key).limit(0).union(query.select(*key).limit(0)).schema
    cast = lambda df: df.withColumns({k: F.col(k).cast(both[k].dataType) for k in key
                                      if df.schema[k].dataType != both[k].dataType})
    return cast(train), cast(query)


def kd_trees(train: DataFrame, key: Sequence[str], features: Sequence[str], ident: str, least: int) -> DataFrame:
    """key, ``_nodes`` (a k-d tree as a value) and ``_depth``, fitted on about ``SAMPLE`` rows of each key."""
    key, feats = list(key), list(features)
    n = checked_broadcast(train.groupBy(*key).agg(F.count("*").alias("_nt")))
    sample = (train.join(n, key).where(F.pmod(F.xxhash64(F.lit(7), ident), F.col("_nt")) < SAMPLE)
              .select(*key, *[F.col(f).cast("double").alias(f) for f in feats], "_nt"))
    kinds = ", ".join(f"{k} {t}" for k, t in train.select(*key).dtypes)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        share = min(1.0, SAMPLE / float(pdf["_nt"].iloc[0]))
        nodes, depth = _split(pdf[feats].to_numpy(float), max(int(least * share), 2))
        names = ("feature", "threshold", "left", "right", "cell", "grp")
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in key}, "_nodes": [dict(zip(names, x)) for x in nodes], "_depth": depth}])

    return sample.groupBy(*key).applyInPandas(fit, f"{kinds}, _nodes {_NODES}, _depth int")


def distance(features: Sequence[str], metric: str, gap) -> Column:
    """Euclidean or Manhattan length of the gaps of all features."""
    if metric == "manhattan":
        return sum((gap(f) for f in features), F.lit(0.0))
    return F.sqrt(sum((gap(f) * gap(f) for f in features), F.lit(0.0)))


def _placed(train: DataFrame, query: DataFrame, key: list[str], feats: list[str], ident: str, least: int):
    """Training rows with their cell and group, and queries with their home cell, both written."""
    values = F.array(*[F.col(f).cast("double") for f in feats])
    trees = materialize(kd_trees(train, key, feats, ident, least), "kd_trees")
    depth = trees.agg(F.max("_depth")).first()[0] or 0
    trees = checked_broadcast(trees.drop("_depth"), 500)
    placed = lambda df: df.join(trees, key).withColumn("_leaf", F.get("_nodes", descend(F.col("_nodes"), values, depth)))
    t = placed(train.select(*key, F.col(ident).alias("_tid"), F.col("label").alias("_y"), *feats))
    t = materialize(t.select(*key, "_tid", "_y", *feats, F.col("_leaf.cell").alias("_cell"), F.col("_leaf.grp").alias("_grp")), "kd_train")
    q = placed(query.select(*key, F.col(ident).alias("_qid"), *feats))
    q = materialize(q.select(*key, "_qid", F.col("_leaf.cell").alias("_cell"),
                             *[F.col(f).cast("double").alias(f"_q_{f}") for f in feats]), "kd_query")
    return t, q


def _met(t: DataFrame, q: DataFrame, key: list[str], feats: list[str], metric: str) -> DataFrame:
    """Every query (``q`` with ``_reach``, its bound) once per cell whose box is no further away: with ``_met``, the cell."""
    def box(*by: str) -> DataFrame:
        return t.groupBy(*key, *by).agg(*[c for f in feats for c in (F.min(f).alias(f"_lo_{f}"), F.max(f).alias(f"_hi_{f}"))])

    outside = distance(feats, metric, lambda f: F.greatest(F.col(f"_lo_{f}") - F.col(f"_q_{f}"),
                                                           F.col(f"_q_{f}") - F.col(f"_hi_{f}"), F.lit(0.0)))
    cells = materialize(box("_grp", "_cell").withColumnRenamed("_cell", "_met"), "kd_cells")
    groups = cells.groupBy(*key, "_grp").agg(
        *[c for f in feats for c in (F.min(f"_lo_{f}").alias(f"_lo_{f}"), F.max(f"_hi_{f}").alias(f"_hi_{f}"))])
    q_columns = [*key, "_qid", "_cell", "_reach", *[f"_q_{f}" for f in feats]]
    near = q.join(checked_broadcast(groups), key).where(outside <= F.col("_reach")).select(*q_columns, "_grp")
    return near.join(checked_broadcast(cells), key + ["_grp"]).where(outside <= F.col("_reach")).select(*q_columns, "_met")


def candidates(train: DataFrame, query: DataFrame, key: Sequence[str], features: Sequence[str], k: int = 5,
               metric: str = "euclidean", ident: str = "driver") -> DataFrame:
    """Key, query id ``_qid``, training id ``_tid``, its label ``_y`` and distance ``_d`` of every row within reach by its
    box, with cells of ``CELL_ROWS``: the pairs themselves, one row each."""
    key, feats = list(key), list(features)
    t, q = _placed(train, query, key, feats, ident, max(CELL_ROWS, 2 * k) // 2)
    measured = distance(feats, metric, lambda f: F.abs(F.col(f"_q_{f}") - F.col(f)))
    nearest = Window.partitionBy(*key, "_qid").orderBy("_d")
    home = q.join(t.drop("_grp"), key + ["_cell"]).select(*key, "_qid", measured.alias("_d"))
    reach = (home.withColumn("_r", F.row_number().over(nearest)).where(F.col("_r") <= k).groupBy(*key, "_qid")
             .agg(F.when(F.count("*") == k, F.max("_d")).alias("_reach")))
    q = materialize(q.join(reach, key + ["_qid"], "left")
                    .withColumn("_reach", F.coalesce("_reach", F.lit(float("inf")))), "kd_reach")
    near = _met(t, q, key, feats, metric).drop("_cell").withColumnRenamed("_met", "_cell")
    return near.join(t.drop("_grp"), key + ["_cell"]).withColumn("_d", measured).select(*key, "_qid", "_tid", "_y", "_d")


def _nearest(q: np.ndarray, t: np.ndarray, reach: np.ndarray, k: int, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and distance of the ``k`` nearest rows of ``t`` within ``reach`` of each query, ties to the lower row.

    Queries come out ascending, each with its rows by distance. Euclidean distances are first
    bounded by one matrix product; the rows that it cannot rule out are measured feature by feature.
    """
    def measure(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]))
        for f in range(q.shape[1]):
            gap = np.abs(a[..., f] - b[..., f])
            total += gap if metric == "manhattan" else gap * gap
        return total if metric == "manhattan" else np.sqrt(total)

    parts = []
    step = max(HELD // max(len(t), 1), 1)
    t2 = (t * t).sum(1)
    for at in range(0, len(q) if len(t) else 0, step):
        x, r = q[at:at + step], reach[at:at + step]
        if metric == "manhattan":
            d = measure(x[:, None, :], t[None, :, :])
            least = np.minimum(r, np.partition(d, k - 1, axis=1)[:, k - 1]) if len(t) > k else r
            i, j = np.nonzero(d <= least[:, None])
            d = d[i, j]
        else:
            x2 = (x * x).sum(1)
            near = x2[:, None] + t2[None, :] - 2.0 * (x @ t.T)
            slack = 1e-14 * (q.shape[1] + 4) * (x2 + t2.max())
            with np.errstate(over="ignore"):
                least = r * r * (1 + 1e-12) + slack
            if len(t) > k and not np.isfinite(r).all():
                least = np.minimum(least, np.partition(near, k - 1, axis=1)[:, k - 1] + 2 * slack)
            i, j = np.nonzero(near <= least[:, None])
            d = measure(x[i], t[j])
        ok = d <= r[i]
        i, j, d = i[ok], j[ok], d[ok]
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        place = np.arange(len(i)) - np.searchsorted(i, i, side="left")
        ok = place < k
        parts.append((i[ok] + at, j[ok], d[ok]))
    if not parts:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _search(q: DataFrame, t: DataFrame, key: list[str], feats: list[str], k: int, metric: str, kept: list[str]) -> DataFrame:
    """The columns ``kept`` of each query and ``_near``: the k nearest rows of the cell ``_cell`` that it meets."""
    by = key + ["_cell"]
    # Counted on a share of the queries by their hash: which cells a query meets is not worked out twice for all of them.
    some = q.where(F.pmod(F.xxhash64(F.lit(11), "_qid"), COUNTED) == 0)
    dealt = some.groupBy(*by).agg(F.ceil(F.count("*") * COUNTED / TASK_QUERIES).cast("int").alias("_parts")).where("_parts > 1")
    dealt = checked_broadcast(dealt)
    parts = F.coalesce("_parts", F.lit(1))
    q = q.join(dealt, by, "left").withColumn("_part", F.pmod(F.xxhash64("_qid"), parts)).drop("_parts")
    t = t.select(*by, "_tid", "_y", *feats).join(dealt, by, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1))).drop("_parts")
    kinds = dict(t.dtypes)
    item = f"array<struct<_d:double,_tid:{kinds['_tid']},_y:{kinds['_y']}>>"
    schema = ", ".join(f"`{c}` {x}" for c, x in q.select(*kept).dtypes) + f", _near {item}"

    def meet(queries: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_tid")
        matrix = lambda table, names: np.column_stack([table.column(c).to_numpy().astype(float) for c in names])
        reach = queries.column("_reach").to_numpy()
        i, j, d = _nearest(matrix(queries, [f"_q_{f}" for f in feats]), matrix(rows, feats), reach, k, metric)
        found = rows.take(pa.array(j))
        one = lambda name: found.column(name).combine_chunks()
        structs = pa.StructArray.from_arrays([pa.array(d), one("_tid"), one("_y")], names=["_d", "_tid", "_y"])
        starts = np.searchsorted(i, np.arange(queries.num_rows + 1)).astype(np.int32)
        out = queries.select(kept).append_column("_near", pa.ListArray.from_arrays(pa.array(starts), structs))
        return out

    return (q.groupBy(*by, "_part").cogroup(t.groupBy(*by, "_part")).applyInArrow(meet, schema))


def knn_lists(train: DataFrame, query: DataFrame, key: Sequence[str], features: Sequence[str], k: int = 5,
              metric: str = "euclidean", ident: str = "driver") -> DataFrame:
    """Exact k nearest training rows of every query row within its key, one row per query: key, ``_qid`` and
    ``_near``, the (``_d``, ``_tid``, ``_y``) by distance, ties by id. Queries of a key without training rows are left out."""
    key, feats = list(key), list(features)
    train, query = _alike(train, query, key)
    same = Window.partitionBy(*key, *feats).orderBy(ident)
    first = (train.select(*key, ident, "label", *[F.col(f).cast("double").alias(f) for f in feats])
             .withColumn("_same", F.row_number().over(same)).where(F.col("_same") <= k).drop("_same"))
    rows = BLOCK_ROWS if len(feats) <= FEW_FEATURES else WIDE_BLOCK_ROWS
    t, q = _placed(materialize(first, "kd_rows"), query, key, feats, ident, max(rows, 4 * k) // 2)
    columns = [*key, "_qid", "_cell", *[f"_q_{f}" for f in feats]]
    home = _search(q.withColumn("_reach", F.lit(float("inf"))), t, key, feats, k, metric, columns)
    home = materialize(home.withColumn("_reach", F.when(F.size("_near") == k, F.element_at("_near", -1)["_d"])
                                       .otherwise(F.lit(float("inf")))), "kd_reach")
    others = (_met(t, home, key, feats, metric).where(F.col("_met") != F.col("_cell")).drop("_cell")
              .withColumnRenamed("_met", "_cell"))
    more = _search(others, t, key, feats, k, metric, [*key, "_qid"]).where(F.size("_near") > 0)
    both = home.select(*key, "_qid", "_near").unionByName(more)
    lists = both.groupBy(*key, "_qid").agg(F.slice(F.array_sort(F.flatten(F.collect_list("_near"))), 1, k).alias("_near"))
    return materialize(lists, "knn")


def knn(train: DataFrame, query: DataFrame, key: Sequence[str], features: Sequence[str], k: int = 5,
        metric: str = "euclidean", ident: str = "driver") -> DataFrame:
    """Exact k nearest training rows of every query row within its key.

    Returns key, query id (``_qid``), neighbour id (``_tid``), its label (``_y``), distance ``_d`` and rank ``_r``
    (1..k, ties by neighbour id); fewer where the key has fewer training rows.
    """
    key = list(key)
    lists = knn_lists(train, query, key, features, k, metric, ident)
    return (lists.select(*key, "_qid", F.posexplode("_near").alias("_r", "_n"))
            .select(*key, "_qid", "_n._tid", "_n._y", "_n._d", (F.col("_r") + 1).alias("_r")))
