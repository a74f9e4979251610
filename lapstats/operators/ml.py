"""Per-key machine learning on the driver matrix (M1-M12), as DataFrame jobs.

Every model is trained for all races at once: the race key (plus the CV fold
when cross-validating) is a grouping column, never a driver-side loop.

* Folds (M7/M11/M12): stratified by label in a deterministic md5 order.
* kNN (M9): exact, without an all-pairs join, by k-d cells and box bounds
  (``neighbours``).
* Decision tree (M8): level-wise CART. Per (key, node, feature) the distinct
  values are ordered and cumulative class counts give every split's Gini; the
  best split per node is an arg-min aggregate. Nodes of many rows are summed by
  ordered pieces, so no task sorts a whole race; below a node of few rows
  (``TASK_ROWS``) one task grows the rest of the tree. Trees that differ in depth or in
  the rows a split needs are one full tree, cut off per configuration.
* K-Means (M1/M2): distance-weighted starts in a few passes, then Lloyd
  iterations of all starts (and of all k of a sweep) together; centres are sent
  to the tasks, which add up their own points in numpy, so a step is one small
  job and shuffles partial sums only. Silhouette (M4) uses the squared-Euclidean decomposition of
  Spark's ClusteringEvaluator (per-cluster sums), so it is O(n k), not O(n^2).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapstats.functions.aggregates import checked_broadcast
from lapstats.functions.ranking import hash_piece, row_numbers, running_sums
from lapstats.operators import neighbours, treevalue
from lapstats.operators.clean import standardize
from lapstats.schema import MODEL_FEATURES, SEED
from lapstats.session import materialize

#: Levels of a deep tree that rows descend in one plan; then they are written.
STEPS_PER_PLAN = 10
#: Rows of a tree node up to which its values of a feature are sorted by one window.
WINDOW_MAX_ROWS = 1_000_000
#: Rows of a tree node up to which one task grows everything below it.
TASK_ROWS = 100_000


def model_input(matrix: DataFrame, key: Sequence[str], features: Sequence[str] = MODEL_FEATURES,
                label: str = "strong_performance") -> DataFrame:
    """Standardised features (population sigma per key, constant -> 0) + label."""
    key = list(key)
    z = standardize(matrix.select(*key, "driver", label, *features), features, key, suffix="_z")
    return z.select(*key, "driver", F.col(label).alias("label"),
                    *[F.col(f"{f}_z").alias(f) for f in features])


def hash_order(key: Sequence[str], ident: str = "driver", seed: int = SEED) -> Column:
    """Deterministic pseudo-random order shared with the SQL oracle (md5, not rand())."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key], F.col(ident)))


def assign_folds(df: DataFrame, key: Sequence[str], n_splits: int = 5, label: str = "label",
                 seed: int = SEED) -> DataFrame:
    """M11 + M12: k = max(2, min(n_splits, smallest class)); stratified round-robin folds."""
    key = list(key)
    cls = df.groupBy(*key, label).agg(F.count("*").alias("_c"))
    k = cls.groupBy(*key).agg(F.greatest(F.lit(2), F.least(F.lit(n_splits), F.min("_c"))).alias("n_folds"))
    order = hash_order(key, seed=seed)
    ranked = row_numbers(df.join(k, key), key + [label], [order, F.col("driver")], "_rn", hash_piece(order))
    return ranked.withColumn("fold", ((F.col("_rn") - 1) % F.col("n_folds")).cast("int")).drop("_rn")


def fold_sets(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(train, test) for all folds at once, keyed by key + ['cv_fold'].

    Each row is a test row of its own fold and a training row of every other
    fold of its key (k-1 copies, k <= 5).
    """
    key = list(key)
    test = df.withColumn("cv_fold", F.col("fold"))
    # Of the type of ``fold``: equal numbers of two types are dealt to different tasks.
    last = (F.col("n_folds") - 1).cast(df.schema["fold"].dataType)
    train = (df.withColumn("cv_fold", F.explode(F.sequence(last * 0, last)))
             .where(F.col("cv_fold") != F.col("fold")))
    return train, test


# ---------------------------------------------------------------- kNN (M9)

knn_neighbors = neighbours.knn


def knn_vote(neigh: DataFrame, key: Sequence[str], k: int, weights: str = "uniform") -> DataFrame:
    """Majority (or 1/d weighted) vote of the first k neighbours; ties -> lowest class.

    With distance weights, neighbours at distance 0 take all the weight (as
    in scikit-learn). Returns key, _qid, pred, proba (weight share of class 1).
    """
    key = list(key)
    n = neigh.where(F.col("_r") <= k)
    if weights == "distance":
        has_zero = F.max((F.col("_d") == 0).cast("int")).over(Window.partitionBy(*key, "_qid"))
        n = n.withColumn("_w", F.when(has_zero == 1, (F.col("_d") == 0).cast("double"))
                         .otherwise(1.0 / F.col("_d")))
    else:
        n = n.withColumn("_w", F.lit(1.0))
    per = n.groupBy(*key, "_qid", "_y").agg(F.sum("_w").alias("_s"))
    tot = per.groupBy(*key, "_qid").agg(
        F.max_by("_y", F.struct("_s", F.negative("_y"))).alias("pred"),
        (F.sum(F.when(F.col("_y") == 1, F.col("_s")).otherwise(0.0)) / F.sum("_s")).alias("proba"))
    return tot


def list_vote(near: Column, k: int, weights: str = "uniform") -> Column:
    """The vote of ``knn_vote`` over a list of ``neighbours.knn_lists``, inside the row: a struct of pred and proba."""
    n = F.slice(near, 1, k)
    if weights == "distance":
        zero = F.exists(n, lambda x: x["_d"] == 0)
        weight = lambda x: F.when(zero, (x["_d"] == 0).cast("double")).otherwise(1.0 / x["_d"])
    else:
        weight = lambda x: F.lit(1.0)
    total = lambda cond: F.aggregate(n, F.lit(0.0), lambda a, x: a + F.when(cond(x), weight(x)).otherwise(0.0))
    classes = F.array_distinct(F.transform(n, lambda x: x["_y"]))
    most = F.array_max(F.transform(classes, lambda c: F.struct(
        total(lambda x: x["_y"] == c).alias("s"), F.negative(c).alias("y"))))
    share = total(lambda x: x["_y"] == 1) / total(lambda x: F.lit(True))
    return F.struct(F.negative(most["y"]).alias("pred"), share.alias("proba"))


def knn_classify(train: DataFrame, query: DataFrame, key: Sequence[str], features: Sequence[str], k: int = 5,
                 metric: str = "euclidean", weights: str = "uniform", ident: str = "driver") -> DataFrame:
    """key, ident, pred and proba of every query by the vote of its k nearest training rows."""
    key = list(key)
    lists = neighbours.knn_lists(train, query, key, features, k, metric, ident)
    return lists.select(*key, F.col("_qid").alias(ident), list_vote(F.col("_near"), k, weights).alias("_v")).select(
        *key, ident, "_v.pred", "_v.proba")


# ------------------------------------------------------- decision tree (M8)

def _gini(counts: Sequence[Column], total: Column) -> Column:
    return F.lit(1.0) - sum(((c / total) * (c / total) for c in counts), F.lit(0.0))


def _impurities(counts: list[np.ndarray], total: np.ndarray, criterion: str) -> np.ndarray:
    """``_gini`` or the entropy of arrays of class counts, added up in the same order as the columns are."""
    out = np.zeros(np.shape(total))
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in counts:
            p = c / total
            out = out + (np.where(c > 0, p * (np.log(p) / np.log(2.0)), 0.0) if criterion == "entropy" else p * p)
    return -out if criterion == "entropy" else 1.0 - out


def _grow(x: np.ndarray, y: np.ndarray, name: str, max_depth: int | None, min_split: int, min_leaf: int,
          criterion: str, classes: Sequence[int]) -> list[tuple]:
    """The nodes at and below ``name`` of a tree over the rows ``x`` with labels ``y``: (node, feature, threshold, pred, proba, n)."""
    nodes, todo = [], [(name, np.arange(len(y)))]
    hit = np.stack([y == c for c in classes], 1)
    while todo:
        at, rows = todo.pop()
        n, counts = len(rows), hit[rows].sum(0)
        cut = None
        if counts.max() < n and n >= min_split and (max_depth is None or len(at) - 1 < max_depth):
            order = x[rows].argsort(0, kind="stable")
            v = np.take_along_axis(x[rows], order, 0)
            left = [np.cumsum(hit[rows, i][order], 0) for i in range(len(classes))]
            nl = sum(left)
            nt = counts.sum()
            nr = nt - nl
            last = np.append(v[1:] != v[:-1], np.zeros((1, x.shape[1]), bool), 0)  # the last row of a value, if another follows
            ok = last & (nr > 0) & (nl >= min_leaf) & (nr >= min_leaf)
            f, i = np.nonzero(ok.T)  # by feature, then by value
            if len(f):
                l = [c[i, f] for c in left]
                a, b = nl[i, f], nr[i, f]
                imp = (a * _impurities(l, a, criterion) + b * _impurities(
                    [t - c for t, c in zip(counts, l, strict=True)], b, criterion)) / nt
                best = int(imp.argmin())  # the first of equals
                f, i = int(f[best]), int(i[best])
                low, high = float(v[i, f]), float(v[i + 1, f])
                mid = (low + high) / 2.0
                cut = f, mid if mid < high else low
        nodes.append((at, *(cut or (None, None)), classes[int(counts.argmax())], counts[-1] / n, n))
        if cut:
            goes_left = x[rows, cut[0]] <= cut[1]
            todo += [(at + "0", rows[goes_left]), (at + "1", rows[~goes_left])]
    return nodes


def _grow_rest(rows: DataFrame, key: list[str], feats: list[str], classes: Sequence[int]) -> DataFrame:
    """Node table of the subtrees below each (key, ``_node``) of ``rows``, which carry the parameters of their tree."""
    kinds = dict(rows.dtypes)

    def grow(t: pa.Table) -> pa.Table:
        first = {c: t.column(c)[0].as_py() for c in (*key, "_node", "_md", "_mss", "_msl", "_crit")}
        x = np.column_stack([t.column(f).to_numpy() for f in feats])
        found = _grow(x, t.column("label").to_numpy(), first["_node"], first["_md"], first["_mss"], first["_msl"],
                      first["_crit"], classes)
        node, feature, threshold, pred, proba, n = zip(*found, strict=True)
        columns = {c: pa.array([first[c]] * len(found), t.schema.field(c).type) for c in key}
        return pa.table({**columns, "node": pa.array(node), "depth": pa.array([len(a) - 1 for a in node], pa.int32()),
                         "feature": pa.array(feature, pa.int32()), "threshold": pa.array(threshold, pa.float64()),
                         "is_leaf": pa.array([f is None for f in feature]), "pred": pa.array(pred, pa.int32()),
                         "proba": pa.array(proba, pa.float64()), "n": pa.array(n, pa.int64())})

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in key)
    return rows.groupBy(*key, "_node").applyInArrow(
        grow, f"{schema}, node string, depth int, feature int, threshold double, is_leaf boolean, pred int, proba double, n long")


def tree_fit(train: DataFrame, key: Sequence[str], features: Sequence[str], max_depth: int = 5,
             min_samples_split: int = 2, min_samples_leaf: int = 1, criterion: str = "gini",
             classes: Sequence[int] = (0, 1), params: DataFrame | None = None) -> DataFrame:
    """Fit one CART tree per key. Returns the node table:
    key, node, depth, feature, threshold, is_leaf, pred, proba, n.

    ``max_depth`` None is unlimited: levels are added until no node splits. A
    node is named by its path, ``1`` for the root, then 0 (left) or 1 (right)
    for each level, so that names never run out.

    ``params`` (optional, one row per key) overrides the hyper-parameters per
    key with columns max_depth (NULL = unlimited), min_samples_split,
    min_samples_leaf and criterion, so a whole grid trains in one job.
    """
    key = list(key)
    feats = list(features)
    rows = materialize(train.select(*key, "label", *feats).withColumn("_node", F.lit("1")), "tree_rows")
    if params is None:
        params = rows.select(*key).distinct().select(
            *key, F.lit(max_depth).cast("int").alias("max_depth"), F.lit(min_samples_split).alias("min_samples_split"),
            F.lit(min_samples_leaf).alias("min_samples_leaf"), F.lit(criterion).alias("criterion"))
    prm = checked_broadcast(params.select(
        *key, F.col("max_depth").alias("_md"),
        F.col("min_samples_split").alias("_mss"), F.col("min_samples_leaf").alias("_msl"),
        F.col("criterion").alias("_crit")))
    nodes = []
    most = rows.groupBy(*key).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0

    def impurity(counts, total):
        ent = -sum((F.coalesce(F.when(c > 0, (c / total) * F.log2(c / total)), F.lit(0.0)) for c in counts),
                   F.lit(0.0))
        return F.when(F.col("_crit") == "entropy", ent).otherwise(_gini(counts, total))

    for depth in itertools.count():
        stats = rows.groupBy(*key, "_node").agg(
            F.count("*").alias("n"), *[F.count_if(F.col("label") == c).alias(f"_n{c}") for c in classes])
        pred = F.lit(None).cast("int")
        for c in reversed(classes):  # lowest class wins ties
            best = F.greatest(*[F.col(f"_n{x}") for x in classes]) if len(classes) > 1 else F.col(f"_n{c}")
            pred = F.when(F.col(f"_n{c}") == best, F.lit(c)).otherwise(pred)
        stats = (stats.join(prm, key).withColumn("pred", pred)
                 .withColumn("proba", F.col(f"_n{classes[-1]}") / F.col("n"))
                 .withColumn("_pure", F.greatest(*[F.col(f"_n{c}") for c in classes]) == F.col("n")))
        can_split = ((~F.col("_pure")) & (F.col("n") >= F.col("_mss"))
                     & (F.col("_md").isNull() | (F.lit(depth) < F.col("_md"))))
        stats = materialize(stats.withColumn("_rest", can_split & (F.col("n") <= TASK_ROWS)), "tree_stats")
        rest = rows.join(stats.where("_rest").select(*key, "_node", "_md", "_mss", "_msl", "_crit"), key + ["_node"])
        nodes.append(materialize(_grow_rest(rest.select(*key, "_node", "label", *[F.col(f).cast("double").alias(f) for f in feats],
                                                        "_md", "_mss", "_msl", "_crit"), key, feats, classes), "tree_rest"))
        stats = stats.where(~F.col("_rest")).drop("_rest")
        if stats.where(can_split).limit(1).count() == 0:  # only leaves are left
            nodes.append(stats.select(*key, F.col("_node").alias("node"), F.lit(depth).alias("depth"),
                                      F.lit(None).cast("int").alias("feature"), F.lit(None).cast("double").alias("threshold"),
                                      F.lit(True).alias("is_leaf"), "pred", "proba", "n"))
            break
        long = rows.join(stats.where(can_split).select(*key, "_node"), key + ["_node"], "left_semi").select(
            *key, "_node", "label",
            F.explode(F.array(*[F.struct(F.lit(i).alias("_f"), F.col(f).alias("_v")) for i, f in enumerate(feats)]))
            .alias("_e")).select(*key, "_node", "label", "_e._f", "_e._v")
        per_v = long.groupBy(*key, "_node", "_f", "_v").agg(
            *[F.count_if(F.col("label") == c).alias(f"_c{c}") for c in classes])
        by = key + ["_node", "_f"]
        if most <= WINDOW_MAX_ROWS:
            wv = Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
            wall = Window.partitionBy(*by)
            cum = per_v.select(*by, "_v", *[F.sum(f"_c{c}").over(wv).alias(f"_l{c}") for c in classes],
                               *[F.sum(f"_c{c}").over(wall).alias(f"_t{c}") for c in classes])
        else:  # a node may hold too many values to sort in one task: they are summed by ordered pieces
            per_v = materialize(per_v, "tree_values")
            cum = running_sums(per_v, by, [F.col("_v")], {f"_l{c}": f"_c{c}" for c in classes},
                               totals={f"_t{c}": f"_c{c}" for c in classes})
        cum = cum.join(prm, key)
        nl = sum((F.col(f"_l{c}") for c in classes), F.lit(0))
        nt = sum((F.col(f"_t{c}") for c in classes), F.lit(0))
        nr = nt - nl
        imp = (nl * impurity([F.col(f"_l{c}") for c in classes], nl)
               + nr * impurity([F.col(f"_t{c}") - F.col(f"_l{c}") for c in classes], nr)) / nt
        cands = cum.where((nr > 0) & (nl >= F.col("_msl")) & (nr >= F.col("_msl"))).select(
            *by, "_v", imp.alias("_imp"))
        cut = cands.groupBy(*key, "_node").agg(F.min_by(F.struct("_f", "_v"), F.struct("_imp", "_f", "_v")).alias("_b"))
        # The threshold lies halfway to the next value of the feature in the node.
        cut = cut.select(*key, "_node", F.col("_b._f").alias("_f"), F.col("_b._v").alias("_at"))
        after = per_v.join(cut, by).where(F.col("_v") > F.col("_at")).groupBy(*by, "_at").agg(F.min("_v").alias("_next"))
        # Between neighbouring floats the midpoint rounds to one of them; the lower one still splits.
        mid = (F.col("_at") + F.col("_next")) / 2.0
        best = after.select(*key, "_node", F.struct("_f", F.when(mid < F.col("_next"), mid).otherwise(F.col("_at")).alias(
            "_thr")).alias("_b"))
        level = (stats.join(best, key + ["_node"], "left")
                 .select(*key, F.col("_node").alias("node"), F.lit(depth).alias("depth"),
                         F.col("_b._f").alias("feature"), F.col("_b._thr").alias("threshold"),
                         F.col("_b").isNull().alias("is_leaf"), "pred", "proba", "n"))
        level = materialize(level, "tree_level")
        nodes.append(level)
        splits = level.where(~F.col("is_leaf")).select(*key, F.col("node").alias("_node"), "feature", "threshold")
        most = level.where(~F.col("is_leaf")).agg(F.max("n")).first()[0]
        if most is None:
            break
        fv = F.element_at(F.array(*[F.col(f).cast("double") for f in feats]), F.col("feature") + 1)
        rows = materialize(rows.join(splits, key + ["_node"]).withColumn(
            "_node", F.concat("_node", F.when(fv <= F.col("threshold"), "0").otherwise("1")))
            .drop("feature", "threshold"), "tree_rows")
    out = nodes[0]
    for n in nodes[1:]:
        out = out.unionByName(n)
    return materialize(out, "tree")


def tree_predict(tree: DataFrame, rows: DataFrame, key: Sequence[str], features: Sequence[str],
                 ident: str = "driver") -> DataFrame:
    """Route rows down their key's tree; returns key, ident, pred, proba.

    A tree is one value per key that the row descends by itself; only trees too
    large for that are routed with a join per level.
    """
    key = list(key)
    feats = list(features)
    size = tree.groupBy(*key).agg(F.count("*").alias("_n"), F.max("depth").alias("_d")).agg(
        F.max("_n"), F.max("_d"), F.sum("_n")).first()
    max_depth = size[1] or 0
    if (size[0] or 0) <= treevalue.MOST_NODES:
        return treevalue.predict(tree, rows, key, feats, ident, max_depth, size[2] or 0)
    cur = rows.select(*key, ident, *feats).withColumn("_node", F.lit("1"))
    fv = F.element_at(F.array(*[F.col(f).cast("double") for f in feats]), F.col("feature") + 1)
    for depth in range(int(max_depth)):
        if depth and depth % STEPS_PER_PLAN == 0:
            cur = materialize(cur, "tree_routed")
        cur = (cur.join(tree.select(*key, F.col("node").alias("_node"), "feature", "threshold", "is_leaf"),
                        key + ["_node"], "left")
               .withColumn("_node", F.when(F.col("is_leaf") | F.col("feature").isNull(), F.col("_node"))
                           .otherwise(F.concat("_node", F.when(fv <= F.col("threshold"), "0").otherwise("1"))))
               .drop("feature", "threshold", "is_leaf"))
    return (cur.join(tree.select(*key, F.col("node").alias("_node"), "pred", "proba"), key + ["_node"], "left")
            .select(*key, ident, "pred", "proba"))


def tree_paths(tree: DataFrame, rows: DataFrame, key: Sequence[str], features: Sequence[str]) -> DataFrame:
    """``rows`` with ``_path``: the nodes a row passes in its key's tree, the root first, as an array of (n, pred).

    A tree stopped earlier, by its depth or by the rows that a split needs, is
    this tree cut off there: its answer is the node at which the path is cut
    (``pruned_prediction``), so one full tree answers for all of them.
    """
    key, feats = list(key), list(features)
    size = tree.groupBy(*key).agg(F.count("*").alias("_n"), F.max("depth").alias("_d")).agg(
        F.max("_n"), F.max("_d"), F.sum("_n")).first()
    max_depth, values = int(size[1] or 0), F.array(*[F.col(f).cast("double") for f in feats])
    if (size[0] or 0) <= treevalue.MOST_NODES:
        folded = treevalue.fold_trees(tree, key)
        folded = checked_broadcast(folded) if (size[2] or 0) <= 200_000 else folded
        return rows.join(folded, key, "left").withColumn(
            "_path", treevalue.walk(F.col("_nodes"), values, max_depth)).drop("_nodes")
    nodes = tree.select(*key, F.col("node").alias("_node"), F.col("feature").alias("_f"), F.col("threshold").alias("_thr"),
                        F.col("is_leaf").alias("_leaf"), F.struct("n", "pred").alias("_here"))
    cur = rows.withColumn("_node", F.lit("1")).withColumn("_path", F.array().cast("array<struct<n:bigint,pred:int>>"))
    for depth in range(max_depth + 1):
        if depth and depth % STEPS_PER_PLAN == 0:
            cur = materialize(cur, "tree_paths")
        side = F.when(F.get(values, F.col("_f")) <= F.col("_thr"), "0").otherwise("1")
        # A row that is at its leaf has no node any more: it meets nothing.
        cur = (cur.join(nodes, key + ["_node"], "left")
               .withColumn("_path", F.when(F.col("_here").isNull(), F.col("_path")).otherwise(
                   F.concat("_path", F.array("_here"))))
               .withColumn("_node", F.when(~F.col("_leaf"), F.concat("_node", side)))
               .drop("_f", "_thr", "_leaf", "_here"))
    return cur.drop("_node")


def pruned_prediction(path: Column, max_depth: Column, min_samples_split: Column) -> Column:
    """The class at the end of ``path`` in the tree that splits no node at ``max_depth`` (NULL: unlimited) or with
    fewer rows than ``min_samples_split``."""
    stops = F.filter(path, lambda x, i: F.coalesce(i >= max_depth, F.lit(False)) | (x["n"] < min_samples_split))
    return F.coalesce(F.get(stops, F.lit(0)), F.element_at(path, -1))["pred"]


def tree_importance(tree: DataFrame, key: Sequence[str], features: Sequence[str],
                    criterion: str = "gini") -> DataFrame:
    """Impurity importance per feature, normalised to sum 1 per key (5 dp)."""
    key = list(key)
    feats = list(features)
    # node impurity from its leaf-class share (binary labels)
    p = F.col("proba")
    imp = (F.lit(1.0) - p * p - (1 - p) * (1 - p)) if criterion == "gini" else \
        -(F.coalesce(F.when(p > 0, p * F.log2(p)), F.lit(0.0)) + F.coalesce(F.when(p < 1, (1 - p) * F.log2(1 - p)),
                                                                         F.lit(0.0)))
    t = tree.withColumn("_imp", imp)
    par = t.where(~F.col("is_leaf")).alias("p")
    # A node's name without its last step is its parent's: an equality join.
    ch = t.withColumn("_parent", F.expr("left(node, length(node) - 1)")).alias("c")
    j = par.join(ch, [F.col(f"p.{k}") == F.col(f"c.{k}") for k in key] + [F.col("c._parent") == F.col("p.node")])
    gain = j.groupBy(*[F.col(f"p.{k}").alias(k) for k in key], F.col("p.node"), F.col("p.feature").alias("feature"),
                     F.col("p.n").alias("_n"), F.col("p._imp").alias("_pi")).agg(
        F.sum(F.col("c.n") * F.col("c._imp")).alias("_child"))
    gain = gain.withColumn("_g", F.col("_n") * F.col("_pi") - F.col("_child"))
    per = gain.groupBy(*key, "feature").agg(F.sum("_g").alias("_g"))
    tot = per.groupBy(*key).agg(F.sum("_g").alias("_tot"))
    names = F.element_at(F.array(*[F.lit(f) for f in feats]), F.col("feature") + 1)
    return (per.join(tot, key).select(*key, names.alias("feature"), F.round(F.try_divide(
        F.col("_g"), F.col("_tot")), 5).alias("importance")))


# ------------------------------------------------------------- K-Means (M1)

#: Sampling rounds of the distance-weighted start, and candidates expected from a round, times k.
START_ROUNDS = 5
OVERSAMPLING = 2
#: Sets of centres times centres times features that may be sent to every task (8 bytes each).
BROADCAST_MAX_COORDINATES = 2_000_000
#: Rows of partial sums that a step may send back; beyond, they are added up by Spark first.
PARTIAL_ROWS = 500_000
#: Points between two centres that a step of all tasks may send back, so that the steps after it need no tasks.
LOOSE_ROWS = 400_000


def _coin(*parts: Column) -> Column:
    """A number between 0 and 1 that is fixed by ``parts``."""
    head = F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 13)
    return (F.conv(head, 16, 10).cast("double") + 0.5) / float(16 ** 13)


def _sets(cent: DataFrame, by: list[str], feats: list[str]) -> DataFrame:
    """Each set of centres as one array."""
    return cent.groupBy(*by).agg(F.collect_list(F.struct("cluster", *feats)).alias("_cent"))


def _sqdist(a, b, feats: list[str]) -> Column:
    return sum((F.pow(a[f] - b[f], 2) for f in feats), F.lit(0.0))


def _square_gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each centre, features added in their order."""
    out = np.zeros((len(x), len(centres)))
    for f in range(x.shape[1]):
        gap = x[:, f, None] - centres[None, :, f]
        out += gap * gap
    return out


def _to_nearest(pts: DataFrame, sets: DataFrame, key: list[str], by: list[str], feats: list[str]) -> DataFrame:
    """Every point with its nearest centre (lowest number on ties), once per set of centres ``by``.

    Centres are sent to the tasks, which measure their points in numpy; more than ``BROADCAST_MAX_COORDINATES``
    are joined. No row per (point, centre) is made either way.
    """
    size = (sets.agg(F.sum(F.size("_cent"))).first()[0] or 0) * len(feats)
    if size > BROADCAST_MAX_COORDINATES:
        return _joined_to_nearest(pts, sets, key, by, feats)
    held = [r for r in sets.collect() if all(r[k] is not None for k in key)]
    kinds = {f.name: f for f in sets.schema.fields}
    spark = pts.sparkSession
    races = {r: i for i, r in enumerate(dict.fromkeys(tuple(row[k] for k in key) for row in held))}
    ids = spark.createDataFrame([(*r, i) for r, i in races.items()], T.StructType(
        [kinds[k] for k in key] + [T.StructField("_race", T.IntegerType())]))
    order = [sorted(r["_cent"], key=lambda c: (c["cluster"] is not None, c["cluster"])) for r in held]
    cluster = kinds["_cent"].dataType.elementType["cluster"].dataType
    names = spark.createDataFrame(
        [(i, *[r[c] for c in by], [c["cluster"] for c in cs]) for i, (r, cs) in enumerate(zip(held, order, strict=True))],
        T.StructType([T.StructField("_set", T.IntegerType()), *[kinds[c] for c in by],
                      T.StructField("_names", T.ArrayType(cluster))]))
    sent: dict = {}
    for i, (r, cs) in enumerate(zip(held, order, strict=True)):
        values = [[c[f] for f in feats] for c in cs]
        sent.setdefault(races[tuple(r[k] for k in key)], []).append(
            (i, np.array(values, float), np.array([None in v for v in values])))
    shared = spark.sparkContext.broadcast(sent)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            race = batch.column("_race").to_numpy()
            x = np.column_stack([batch.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in feats])
            void = np.logical_or.reduce([batch.column(f).is_null().to_numpy(zero_copy_only=False) for f in feats])
            many = np.array([len(shared.value.get(int(r), ())) for r in race], np.int32)
            starts = np.append(0, np.cumsum(many)).astype(np.int32)
            number, at, sq, none = (np.zeros(starts[-1], t) for t in (np.int32, np.int32, float, bool))
            for r in np.unique(race):
                mine = np.flatnonzero(race == r)
                for i, (n, centres, lost) in enumerate(shared.value.get(int(r), ())):
                    dist = _square_gaps(x[mine], centres)
                    # As Spark orders them: an unknown distance comes first, NaN last.
                    unknown = void[mine][:, None] | lost[None, :]
                    near = np.where(unknown, -np.inf, np.where(np.isnan(dist), np.inf, dist)).argmin(1)  # the lowest of equals
                    put, rows = starts[mine] + i, np.arange(len(mine))
                    number[put], at[put], sq[put], none[put] = n, near, dist[rows, near], unknown[rows, near]
            found = pa.StructArray.from_arrays([pa.array(number), pa.array(at), pa.array(sq, mask=none)],
                                               names=["_set", "_at", "sqdist"])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.ListArray.from_arrays(pa.array(starts), found)],
                                             names=[*batch.schema.names[1:], "_near"])

    rows = pts.join(F.broadcast(ids), key).select("_race", "driver", *feats)
    near = rows.mapInArrow(measure, T.StructType([*rows.schema.fields[1:], T.StructField("_near", T.ArrayType(T.StructType([
        T.StructField("_set", T.IntegerType()), T.StructField("_at", T.IntegerType()), T.StructField("sqdist", T.DoubleType())])))]))
    return (near.select("driver", *feats, F.explode("_near").alias("_n")).select("driver", *feats, "_n.*")
            .join(F.broadcast(names), "_set").select(*by, "driver", *feats, F.get("_names", F.col("_at")).alias("cluster"), "sqdist"))


def _joined_to_nearest(pts: DataFrame, sets: DataFrame, key: list[str], by: list[str], feats: list[str]) -> DataFrame:
    """``_to_nearest`` by a join: a set of centres is one array, so the arg-min is an expression on the row."""
    here = {f: F.col(f) for f in feats}
    near = F.array_min(F.transform("_cent", lambda c: F.struct(
        _sqdist(here, c, feats).alias("d2"), c["cluster"].alias("cluster"))))
    return (pts.join(sets, key).withColumn("_near", near)
            .select(*by, "driver", *feats, F.col("_near.cluster").alias("cluster"), F.col("_near.d2").alias("sqdist")))


def _distance_starts(pts: DataFrame, key: list[str], by: list[str], feats: list[str], wanted: DataFrame, starts: int,
                     seed: int) -> DataFrame:
    """Distance-weighted starts in a few passes (k-means||), for all keys, starts and runs at once.

    ``wanted`` names the runs of each key: ``_run``, ``_k`` (its k') and ``_ask`` (its k). A round takes each
    point with a chance of OVERSAMPLING * k times its share
    of the squared distance to the candidates so far, and at least one point;
    the coin is a hash of the row, so a repeated task picks the same rows.
    Rounds go on past START_ROUNDS only where a set has too few distinct
    candidates and points are left. Candidates, weighted by the points nearest
    to them, are then reduced to k' by weighted draws (k-means++): their number
    depends on k, not on the rows of a key.
    """
    wanted = checked_broadcast(wanted)
    runs = key + ["_run"]
    all_by = by + ["_run"]
    first = (pts.withColumn("_start", F.explode(F.sequence(F.lit(0), F.lit(starts - 1)))).groupBy(*by)
             .agg(F.min_by(F.struct(F.col("driver").alias("cluster"), *feats),
                           F.struct(hash_order(by, seed=seed), "driver")).alias("_f")))
    cand = materialize(first.join(wanted, key).select(*all_by, "_f.*"), "kmeans_candidates")
    size = cand.count()
    short = None  # after the common rounds: the sets that still have too few distinct candidates
    for r in itertools.count(1):
        coin = _coin(F.lit(seed), F.lit(r), *[F.col(c) for c in by], F.col("driver"))
        sets = _sets(cand, all_by, feats)
        far = _to_nearest(pts, sets if short is None else sets.join(short, all_by, "left_semi"), key, all_by, feats).where(
            F.col("sqdist") > 0).withColumn("_u", coin)
        total = checked_broadcast(far.groupBy(*all_by).agg(
            F.sum("sqdist").alias("_sum"),
            F.min_by("driver", F.struct(-F.ln("_u") / F.col("sqdist"), "driver")).alias("_drawn")))
        picked = far.join(total, all_by).join(wanted, runs).where((F.col("driver") == F.col("_drawn")) | (
            F.col("_u") * F.col("_sum") < OVERSAMPLING * F.col("_ask") * F.col("sqdist")))
        cand = materialize(cand.unionByName(picked.select(*all_by, F.col("driver").alias("cluster"), *feats)),
                           "kmeans_candidates")
        before, size = size, cand.count()
        if size == before:
            break
        if r >= START_ROUNDS:
            short = checked_broadcast(
                cand.groupBy(*all_by).agg(F.count_distinct(F.struct(*feats)).alias("_c")).join(wanted, runs)
                .where(F.col("_c") < F.col("_k")).select(*all_by))
            if short.limit(1).count() == 0:
                break

    weight = _to_nearest(pts, _sets(cand, all_by, feats), key, all_by, feats).groupBy(*all_by, "cluster").agg(
        F.count("*").alias("_w"))
    lists = (cand.join(weight, all_by + ["cluster"]).groupBy(*all_by)
             .agg(F.collect_list(F.struct("_w", "cluster", *feats)).alias("_c")).join(wanted, runs))

    def draw(i: Column, chosen: Column | None) -> Column:
        def score(c):
            luck = -F.ln(_coin(F.lit(seed), F.lit("draw"), i, *[F.col(x) for x in by], c["cluster"])) / c["_w"]
            if chosen is None:
                return luck
            d2 = F.array_min(F.transform(chosen, lambda o: _sqdist(c, o, feats)))
            return F.when(d2 > 0, luck / d2).otherwise(F.lit(float("inf")))
        return F.array(F.array_min(F.transform("_c", lambda c: F.struct(
            score(c).alias("score"), c["cluster"].alias("cluster"), *[c[f].alias(f) for f in feats]))))

    more = F.when(F.col("_k") > 1, F.sequence(F.lit(1), F.col("_k").cast("int") - 1)).otherwise(
        F.array().cast("array<int>"))
    drawn = lists.withColumn("_first", draw(F.lit(0), None)).select(*all_by, F.posexplode(F.aggregate(
        more, F.col("_first"), lambda acc, i: F.concat(acc, draw(i, acc)))).alias("_i", "_d"))
    return drawn.select(*all_by, F.col("_i").alias("cluster"), *[F.col(f"_d.{f}").alias(f) for f in feats])


def _lloyd_step(pts: DataFrame, state: DataFrame, key: list[str], by: list[str], feats: list[str], tol: float,
                small: bool) -> DataFrame:
    """One step of the sets that still move: partial means shuffled by centre, then one row per set."""
    live = state.where("_live").select(*by, "_cent")
    means = (_joined_to_nearest(pts, F.broadcast(live) if small else live, key, by, feats)
             .groupBy(*by, "cluster").agg(*[F.avg(f).alias(f) for f in feats])
             .groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("cluster", F.struct(*feats)))).alias("_mean")))
    # A centre that lost all its points stays where it was.
    new = F.transform("_cent", lambda c: F.struct(c["cluster"].alias("cluster"), *[
        F.coalesce(F.try_element_at(F.col("_mean"), c["cluster"])[f], c[f]).alias(f) for f in feats]))
    moved = F.exists(F.zip_with("_cent", "_new", lambda o, n: _sqdist(o, n, feats) > tol * tol), lambda m: m)
    return (state.join(means, by, "left").withColumn("_new", F.when(F.col("_mean").isNotNull(), new)
                                                     .otherwise(F.col("_cent")))
            .select(*by, F.col("_new").alias("_cent"), (F.col("_live") & moved).alias("_live")))


def _units(x: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """One, whole ``unit`` of each feature and 2**-31 of it, as integers: their sums do not depend on how rows are dealt to tasks."""
    high = np.rint(x / unit)
    return np.column_stack([np.ones(len(x)), high, np.rint((x / unit - high) * 2.0 ** 31)])


def _added(near: np.ndarray, units: np.ndarray, k: int) -> np.ndarray:
    return np.stack([np.bincount(near, column, k) for column in units.T], 1)


def _partial_sums(batches: Iterator[pa.RecordBatch], sets: dict, unit: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Sums (``_units``) of the points nearest to each centre, for every set of centres of a point's race, of one partition.

    ``sets``: race -> the number of each set and its centres as an array (centre, feature). For each set the
    ``most`` points that lie closest to the border between two centres are left out of the sums and given as they are
    (``_loose``); ``_still`` is how far all centres may move before any other point changes its centre.
    """
    d = len(unit)
    found: dict = {}
    for batch in batches:
        race = batch.column(0).to_numpy()
        x = np.column_stack([batch.column(1 + i).to_numpy(zero_copy_only=False) for i in range(d)])
        for r in np.unique(race):
            mine = x[race == r]
            units = _units(mine, unit)
            for number, centres in sets.get(int(r), ()):
                k = len(centres)
                dist = np.sqrt(_square_gaps(mine, centres))
                near = dist.argmin(1)  # the lowest of equals
                rows = np.arange(len(mine))
                own = dist[rows, near]
                dist[rows, near] = np.inf
                free = (dist.min(1) - own) / 2
                free[np.isnan(free)] = np.inf  # such a point has the lowest centre, wherever the others are
                sums, still, margins, points, at = found.get(number) or (
                    np.zeros((k, 2 * d + 1)), np.inf, np.zeros(0), np.zeros((0, d)), np.zeros(0, int))
                sums = sums + _added(near, units, k)
                if most:
                    # Points of this batch join those kept so far; the furthest from a border go.
                    close = np.flatnonzero(free < still)
                    if len(close) > most:
                        close = close[np.argpartition(free[close], most - 1)[:most]]
                    rest = np.ones(len(mine), bool)
                    rest[close] = False
                    still = min(still, free[rest].min(initial=np.inf))
                    margins, points, at = (np.concatenate(p) for p in (
                        (margins, free[close]), (points, mine[close]), (at, near[close])))
                    if len(margins) > most:
                        keep = np.argpartition(margins, most - 1)
                        still = min(still, margins[keep[most:]].min())
                        margins, points, at = (p[keep[:most]] for p in (margins, points, at))
                found[number] = sums, still, margins, points, at
    if found:
        numbers = list(found)
        parts = [found[n] for n in numbers]
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()),
             pa.array([(s - _added(at, _units(p, unit), len(s))).tobytes() for s, _, _, p, at in parts], pa.binary()),
             pa.array([float(still) for _, still, _, _, _ in parts]), pa.array([p.tobytes() for _, _, _, p, _ in parts], pa.binary())],
            names=["_set", "_sums", "_still", "_loose"])


def _rest(points: DataFrame, key: list[str], feats: list[str], states: list[DataFrame], tol: float,
          max_iter: int) -> list[DataFrame]:
    """The ``states`` (by, ``_cent``, ``_live``) after Lloyd's steps: all sets step together until they rest.

    Centres are few (``BROADCAST_MAX_COORDINATES``): they are sent to the tasks, which send back sums by
    centre and a bounded number of points between two centres (``LOOSE_ROWS`` in all); no point is
    shuffled. While centres move less than would change the centre of any other point, further steps
    need these sums and points only; then the tasks go over all points again.
    """
    spark, d = points.sparkSession, len(feats)
    held = [(i, r) for i, s in enumerate(states) for r in s.collect()]
    races = {r: i for i, r in enumerate(dict.fromkeys(tuple(row[k] for k in key) for _, row in held))}
    if not races:
        return states
    kinds = {f.name: f for f in points.schema.fields}
    ids = spark.createDataFrame([(*r, i) for r, i in races.items()], T.StructType(
        [T.StructField(k, kinds[k].dataType) for k in key] + [T.StructField("_race", T.IntegerType())]))
    rows = materialize(points.join(F.broadcast(ids), key).select("_race", *[F.col(f).cast("double") for f in feats])
                       .sortWithinPartitions("_race"), "kmeans_rows")
    order = [sorted(r["_cent"], key=lambda c: c["cluster"]) for _, r in held]
    centres = [np.array([[c[f] for f in feats] for c in cs], float) for cs in order]
    of = [races[tuple(r[k] for k in key)] for _, r in held]
    live = set(range(len(held)))
    left = [max_iter] * len(held)
    top = np.array([t or 1.0 for t in rows.agg(*[F.max(F.abs(f)) for f in feats]).first()])
    unit = 2.0 ** (np.frexp(top)[1] - 30)  # a power of two: dividing by it is exact
    slack = 1e-9 * float(np.sqrt((top * top).sum()))  # far more than rounding moves a distance
    parts = rows.rdd.getNumPartitions()
    while live and max_iter > 0:
        sent = {}
        for n in sorted(live):
            sent.setdefault(of[n], []).append((n, centres[n]))
        shared = spark.sparkContext.broadcast(sent)
        schema = "_set int, _sums binary, _still double, _loose binary"
        few = parts * sum(len(centres[n]) for n in live) <= PARTIAL_ROWS
        most = max(LOOSE_ROWS // (parts * len(live)), 1) if few else 0
        found = rows.mapInArrow(lambda batches: _partial_sums(batches, shared.value, unit, most), schema)
        total = {n: np.zeros((len(centres[n]), 2 * d + 1)) for n in live}
        still = dict.fromkeys(live, np.inf if few else 0.0)
        loose: dict = {n: [] for n in live}
        if few:
            for r in found.collect():
                total[r[0]] += np.frombuffer(r[1]).reshape(-1, 2 * d + 1)
                still[r[0]] = min(still[r[0]], r[2])
                loose[r[0]].append(np.frombuffer(r[3]).reshape(-1, d))
        else:
            def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in _partial_sums(batches, shared.value, unit, 0):
                    sums = [np.frombuffer(v.as_py()).reshape(-1, 2 * d + 1) for v in b.column("_sums")]
                    at = [(n, c) for n, s in zip(b.column("_set").to_pylist(), sums, strict=True) for c in range(len(s))]
                    values = np.concatenate(sums)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n for n, _ in at], pa.int32()), pa.array([c for _, c in at], pa.int32()),
                         *[pa.array(values[:, i]) for i in range(2 * d + 1)]], names=["_set", "_at", *[f"_s{i}" for i in range(2 * d + 1)]])

            names = [f"_s{i}" for i in range(2 * d + 1)]
            added = rows.mapInArrow(spread, "_set int, _at int, " + ", ".join(f"{c} double" for c in names))
            for r in added.groupBy("_set", "_at").agg(*[F.sum(c).alias(c) for c in names]).collect():
                total[r[0]][r[1]] = r[2:]
        shared.unpersist()
        for n in sorted(live):
            begun, x = centres[n], np.concatenate(loose[n]) if loose[n] else np.zeros((0, d))
            units = _units(x, unit)
            while True:
                near = _square_gaps(x, centres[n]).argmin(1)
                t = total[n] + _added(near, units, len(begun))
                own = t[:, 0] > 0
                # A centre that lost all its points stays where it was.
                new = centres[n].copy()
                new[own] = (t[own, 1:d + 1] + t[own, d + 1:] / 2.0 ** 31) / t[own, :1] * unit
                moved = (((new - centres[n]) ** 2).sum(1) > tol * tol).any()
                centres[n] = new
                left[n] -= 1
                if not moved or not left[n]:
                    live.discard(n)
                    break
                if not np.sqrt(((new - begun) ** 2).sum(1)).max() + slack < still[n]:
                    break
    out = []
    for i, s in enumerate(states):
        by = [c for c in s.columns if c not in ("_cent", "_live")]
        done = [(*[r[c] for c in by], [(c["cluster"], *map(float, x)) for c, x in zip(cs, xs, strict=True)], False)
                for (j, r), cs, xs in zip(held, order, centres, strict=True) if j == i]
        out.append(spark.createDataFrame(done, s.schema))
    return out


def kmeans(points: DataFrame, key: Sequence[str], features: Sequence[str], k: int = 3, max_iter: int = 300,
           tol: float = 1e-4, seed: int = SEED, init: str = "distance",
           starts: int = 10) -> tuple[DataFrame, DataFrame]:
    """Lloyd's K-Means per key with k' = min(k, n-1) centres: the best of ``starts`` runs by inertia.

    Initial centres of a start: drawn by squared distance (``init='distance'``,
    see ``_distance_starts``), the first k' rows of the key in an md5 order of
    its own (``'hash'``), or farthest-first from the first of them
    (``'spread'``). All starts of all keys step together; those whose
    centres no longer move rest. Returns (assignments: key, driver, cluster,
    sqdist; centres: key, cluster, f...).
    """
    return kmeans_runs(points, key, features, [(k, init)], max_iter, tol, seed, starts)[0]


def kmeans_runs(points: DataFrame, key: Sequence[str], features: Sequence[str], runs: Sequence[tuple[int, str]],
                max_iter: int = 300, tol: float = 1e-4, seed: int = SEED, starts: int = 10,
                more_rows: bool = False) -> list[tuple[DataFrame, DataFrame]]:
    """``kmeans`` for each (k, init) of ``runs``, all stepping together; with ``more_rows``, keys of k rows or fewer are left out."""
    key = list(key)
    feats = list(features)
    by = key + ["_start"]
    n = materialize(points.groupBy(*key).agg(F.count("*").alias("_n")), "kmeans_sizes")
    all_pts = materialize(points.select(*key, "driver", *feats), "kmeans_points")

    def centres_of(k: int) -> DataFrame:
        return (n.where(F.col("_n") > k) if more_rows else n).select(
            *key, F.least(F.lit(k), F.col("_n") - 1).alias("_k")).where(F.col("_k") >= 1)

    drawn = None
    for i, (k, init) in enumerate(runs):
        if init == "distance":
            one = centres_of(k).withColumn("_run", F.lit(i)).withColumn("_ask", F.lit(k))
            drawn = one if drawn is None else drawn.unionByName(one)
    if drawn is not None:
        drawn = materialize(_distance_starts(all_pts, key, by, feats, drawn, starts, seed), "kmeans_starts")
    begun = []
    for i, (k, init) in enumerate(runs):
        pts = all_pts.join(centres_of(k), key)
        if init == "distance":
            cent = drawn.where(F.col("_run") == i).drop("_run")
        else:
            w = Window.partitionBy(*by).orderBy(hash_order(by, seed=seed), "driver")
            # The literal bound lets each task keep only its first k rows before the shuffle.
            ranked = (pts.withColumn("_start", F.explode(F.sequence(F.lit(0), F.lit(starts - 1))))
                      .withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= (1 if init == "spread" else k))
                      .where(F.col("_i") <= F.col("_k")))
            cent = ranked.select(*by, (F.col("_i") - 1).alias("cluster"), *feats)
            for c in range(1, k if init == "spread" else 1):
                cent = materialize(cent, "kmeans_centres")
                far = _to_nearest(pts.where(F.col("_k") > c), _sets(cent, by, feats), key, by, feats).groupBy(*by).agg(
                    F.max_by(F.struct(*feats), F.struct("sqdist", "driver")).alias("_f"))
                cent = cent.unionByName(far.select(*by, F.lit(c).alias("cluster"), "_f.*"))
        state = materialize(_sets(cent, by, feats).withColumn("_live", F.lit(True)), "kmeans_centres")
        begun.append((pts, state, state.count() * k * len(feats)))

    if sum(size for _, _, size in begun) <= BROADCAST_MAX_COORDINATES:
        states = _rest(points, key, feats, [state for _, state, _ in begun], tol, max_iter)
    else:
        states = []
        for pts, state, size in begun:
            small = size <= BROADCAST_MAX_COORDINATES
            for _ in range(max_iter):
                # Each step starts from written centres: a step reads them twice, so chained plans would double each time.
                state = materialize(_lloyd_step(pts, state, key, by, feats, tol, small), "kmeans_centres")
                if state.where("_live").limit(1).count() == 0:
                    break
            states.append(state)
    out = []
    for (pts, _, _), state in zip(begun, states, strict=True):
        sets = state.select(*by, "_cent")
        best = (_to_nearest(pts, sets, key, by, feats).groupBy(*by).agg(F.sum("sqdist").alias("_sum"))
                .groupBy(*key).agg(F.min_by("_start", F.struct("_sum", "_start")).alias("_start")))
        sets = materialize(sets.join(best, by, "left_semi").select(*key, "_cent"), "kmeans_centres")
        out.append((_to_nearest(pts, sets, key, key, feats).select(*key, "driver", "cluster", "sqdist"),
                    sets.select(*key, F.explode("_cent").alias("_c")).select(*key, "_c.*")))
    return out


def inertia(assign: DataFrame, key: Sequence[str]) -> DataFrame:
    """M2: within-cluster sum of squared distances per key."""
    return assign.groupBy(*key).agg(F.sum("sqdist").alias("inertia"))


def silhouette_sq(points: DataFrame, assign: DataFrame, key: Sequence[str], features: Sequence[str]) -> DataFrame:
    """M4: mean silhouette per key with squared Euclidean distance, O(n k).

    Mean squared distance from x to the m points of cluster C is
    ||x||^2 - 2 x.S_C / m + Q_C / m, with S_C the vector sum and Q_C the sum of
    squared norms; for x's own cluster the divisor is m - 1 (x contributes 0).
    Singletons score 0, as in scikit-learn.
    """
    key = list(key)
    feats = list(features)
    p = points.select(*key, "driver", *feats).join(assign.select(*key, "driver", "cluster"), key + ["driver"])
    norm2 = sum((F.pow(F.col(f), 2) for f in feats), F.lit(0.0))
    cs = p.groupBy(*key, "cluster").agg(F.count("*").alias("_m"), F.sum(norm2).alias("_q"),
                                        *[F.sum(f).alias(f"_s_{f}") for f in feats])
    j = p.alias("x").join(cs.withColumnRenamed("cluster", "_cl"), key)
    dot = sum((F.col(f) * F.col(f"_s_{f}") for f in feats), F.lit(0.0))
    own = F.col("_cl") == F.col("cluster")
    msd = F.when(own, F.try_divide(F.col("_m") * norm2 - 2 * dot + F.col("_q"), F.col("_m") - 1)) \
        .otherwise((F.col("_m") * norm2 - 2 * dot + F.col("_q")) / F.col("_m"))
    per = j.groupBy(*key, "driver").agg(
        F.max(F.when(own, msd)).alias("_a"), F.min(F.when(~own, msd)).alias("_b"),
        F.max(F.when(own, F.col("_m"))).alias("_own_m"))
    s = F.when((F.col("_own_m") <= 1) | F.col("_b").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0)))
    return per.groupBy(*key).agg(F.avg(s).alias("silhouette"))


def labelled_clusters(points: DataFrame, key: Sequence[str], features: Sequence[str], k: int = 3) -> DataFrame:
    """M1 + M3: the assignments of ``kmeans`` with each cluster's label."""
    key = list(key)
    assign, _ = kmeans(points, key, features, k=k)
    labels = cluster_labels(assign, points, key)
    return assign.join(labels.select(*key, "cluster", "label"), key + ["cluster"], "left")


def cluster_labels(assign: DataFrame, points: DataFrame, key: Sequence[str], by: str = "average_lap_time",
                   k: int = 3) -> DataFrame:
    """M3: order clusters by mean (scaled) lap time; fastest 'stable_fast', slowest
    'irregular', middle 'aggressive' when there are 3 clusters, else 'group_<i>'."""
    key = list(key)
    m = (assign.join(points.select(*key, "driver", by), key + ["driver"])
         .groupBy(*key, "cluster").agg(F.avg(by).alias("_mean"), F.count("*").alias("members")))
    w = Window.partitionBy(*key).orderBy("_mean", "cluster")
    m = m.withColumn("_o", F.row_number().over(w)).withColumn("_nc", F.count("*").over(Window.partitionBy(*key)))
    lab = (F.when(F.col("_o") == 1, F.lit("stable_fast"))
           .when(F.col("_o") == F.col("_nc"), F.lit("irregular"))
           .when(F.col("_nc") == 3, F.lit("aggressive"))
           .otherwise(F.concat(F.lit("group_"), F.col("_o").cast("string"))))
    return m.select(*key, "cluster", lab.alias("label"), "members", F.col("_mean").alias("mean_" + by))
