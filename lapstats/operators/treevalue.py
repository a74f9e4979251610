"""Decision trees as values: a key's whole tree in one row, descended inside the row.

A node table is folded to one array per key, whose elements know the places of
their children. A row that meets its key's array finds its leaf in an expression,
without a join per level. Only trees of up to ``MOST_NODES`` nodes are folded, so
the array is bounded; larger ones are routed level by level (``ml.tree_predict``).

``leaf_boxes`` turns a tree into one row per leaf: for each feature the interval
that leads there, and the share of training rows that follow the path at the
splits on that feature. These are all that path-dependent Shapley values need.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstats.functions.aggregates import checked_broadcast

MOST_NODES = 4096


def fold_trees(tree: DataFrame, key: Sequence[str]) -> DataFrame:
    """key and ``_nodes``: array of (feature, threshold, left, right, pred, proba, n), the root first; a leaf has feature NULL."""
    key = list(key)
    held = tree.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(
        "depth", "node", F.when(~F.col("is_leaf"), F.col("feature")).alias("feature"), "threshold", "pred", "proba", "n"))).alias("_n"))
    names = F.transform("_n", lambda n: n["node"])
    child = lambda n, bit: (F.array_position(F.col("_names"), F.concat(n["node"], F.lit(bit))) - 1).cast("int")
    return held.withColumn("_names", names).select(*key, F.transform("_n", lambda n: F.struct(
        n["feature"].alias("feature"), n["threshold"].alias("threshold"), child(n, "0").alias("left"),
        child(n, "1").alias("right"), n["pred"].alias("pred"), n["proba"].alias("proba"),
        n["n"].alias("n"))).alias("_nodes"))


def descend(nodes: Column, values: Column, depth: int) -> Column:
    """Place of the leaf that the array ``values`` reaches in ``nodes`` within ``depth`` steps."""
    def step(at: Column, _: Column) -> Column:
        node = F.get(nodes, at)
        goes_left = F.get(values, node["feature"]) <= node["threshold"]
        return F.when(node["feature"].isNull(), at).when(goes_left, node["left"]).otherwise(node["right"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) if depth else F.lit(0)


def walk(nodes: Column, values: Column, depth: int) -> Column:
    """The nodes that the array ``values`` passes in ``nodes``, from the root to its leaf, as an array of (n, pred)."""
    def step(acc: Column, _: Column) -> Column:
        node = F.get(nodes, acc["at"])
        goes_left = F.get(values, node["feature"]) <= node["threshold"]
        child = F.when(goes_left, node["left"]).otherwise(node["right"])
        after = F.get(nodes, child)
        met = F.concat(acc["path"], F.array(F.struct(after["n"].alias("n"), after["pred"].alias("pred"))))
        return F.when(node["feature"].isNull(), acc).otherwise(F.struct(child.alias("at"), met.alias("path")))

    root = F.get(nodes, F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array(F.struct(root["n"].alias("n"), root["pred"].alias("pred"))).alias("path"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), start, step)["path"] if depth else start["path"]


def predict(tree: DataFrame, rows: DataFrame, key: Sequence[str], features: Sequence[str], ident: str,
            depth: int, nodes: int) -> DataFrame:
    """key, ident, pred and proba of every row; ``depth`` and ``nodes`` are those of the deepest tree and of all trees."""
    key = list(key)
    folded = checked_broadcast(fold_trees(tree, key)) if nodes <= 200_000 else fold_trees(tree, key)
    values = F.array(*[F.col(f).cast("double") for f in features])
    leaf = F.get("_nodes", descend(F.col("_nodes"), values, depth))
    return (rows.select(*key, ident, *features).join(folded, key, "left").withColumn("_leaf", leaf)
            .select(*key, ident, F.col("_leaf.pred").alias("pred"), F.col("_leaf.proba").alias("proba")))


def leaf_boxes(tree: DataFrame, key: Sequence[str], features: Sequence[str]) -> DataFrame:
    """key, leaf, proba, n and per feature i ``_lo{i}`` < x <= ``_hi{i}`` (NULL: open) and ``_w{i}``, one row per leaf."""
    key = list(key)
    leaves = tree.where("is_leaf").select(*key, F.col("node").alias("leaf"), F.col("proba").alias("_value"),
                                          F.col("n").alias("_leaf_n"))
    # Each step of a leaf's path: the node that splits, and the child that is next.
    steps = leaves.withColumn("_i", F.explode(F.sequence(F.lit(1), F.length("leaf")))).select(
        *key, "leaf", "_value", "_leaf_n", "_i", F.expr("left(leaf, _i)").alias("node"),
        F.expr("left(leaf, _i + 1)").alias("_next"))
    splits = tree.where(~F.col("is_leaf")).select(*key, "node", "feature", "threshold", F.col("n").alias("_n"))
    sizes = tree.select(*key, F.col("node").alias("_next"), F.col("n").alias("_next_n"))
    path = steps.join(splits, key + ["node"], "left").join(sizes, key + ["_next"], "left")
    right = F.expr("right(_next, 1) = '1'")
    parts = []
    for i in range(len(features)):
        here = F.col("feature") == i
        parts += [F.max(F.when(here & right, F.col("threshold"))).alias(f"_lo{i}"),
                  F.min(F.when(here & ~right, F.col("threshold"))).alias(f"_hi{i}"),
                  F.product(F.when(here, F.col("_next_n") / F.col("_n")).otherwise(F.lit(1.0))).alias(f"_w{i}")]
    return path.groupBy(*key, "leaf").agg(F.first("_value").alias("_value"), F.first("_leaf_n").alias("_leaf_n"), *parts)


def path_shapley(tree: DataFrame, rows: DataFrame, key: Sequence[str], features: Sequence[str],
                 ident: str = "driver") -> DataFrame:
    """Path-dependent Shapley values of P(class 1): key, ident, feature, phi, f_x, f_base.

    A leaf pays its value to a coalition with the product over the features of
    o (1 if the row meets the leaf's interval, else 0) for those in it and of w
    (the share of training rows that goes that way) for those outside it. The
    Shapley value of such a product game is
    ``value * (o_i - w_i) * integral over t in [0, 1] of the product over j <> i of (o_j t + w_j (1 - t))``,
    a polynomial of degree d - 1, which Gauss-Legendre points integrate exactly.
    So a row costs leaves x features^2, and no coalition is ever made.
    ``f_base`` is the mean prediction over the training rows, and the values of a
    row add up to ``f_x - f_base``.
    """
    key, feats = list(key), list(features)
    d = len(feats)
    points, weights = np.polynomial.legendre.leggauss(max((d + 1) // 2, 1))
    # One row per leaf of a key's tree.
    joined = rows.select(*key, ident, *[F.col(f).cast("double").alias(f) for f in feats]).join(
        leaf_boxes(tree, key, feats), key)
    meets = [(F.coalesce(F.col(f) > F.col(f"_lo{i}"), F.lit(True)) & F.coalesce(F.col(f) <= F.col(f"_hi{i}"), F.lit(True)))
             .cast("double").alias(f"_o{i}") for i, f in enumerate(feats)]
    game = joined.select(*key, ident, "_value", *meets, *[f"_w{i}" for i in range(d)])
    phis = []
    for i in range(d):
        total = F.lit(0.0)
        for x, g in zip(points, weights):
            t, product = (float(x) + 1) / 2, F.lit(float(g) / 2)
            for j in range(d):
                if j != i:
                    product = product * (F.col(f"_o{j}") * t + F.col(f"_w{j}") * (1 - t))
            total = total + product
        phis.append(F.sum(F.when(F.col(f"_o{i}") != F.col(f"_w{i}"),
                                 F.col("_value") * (F.col(f"_o{i}") - F.col(f"_w{i}")) * total).otherwise(0.0)).alias(f"_phi{i}"))
    every = lambda c: F.sum(np.prod([F.col(f"_{c}{i}") for i in range(d)]) * F.col("_value"))
    wide = game.groupBy(*key, ident).agg(*phis, every("o").alias("f_x"), every("w").alias("f_base"))
    long = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_phi{i}").alias("phi")) for i, f in enumerate(feats)]))
    return wide.select(*key, ident, "f_x", "f_base", long.alias("_e")).select(*key, ident, "_e.phi", "_e.feature", "f_x", "f_base")
