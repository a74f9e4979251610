"""Model explanations (M22, M24, M25) and the 2-D projection (M6).

* Permutation importance: each (feature, repeat) permutes one column within
  the race by pairing two md5 orders of the rows (a join on rank, no pairs).
* Shapley values: path-dependent, from the leaves' intervals and the shares of
  training rows (``treevalue.path_shapley``); cost is linear in rows and leaves.
  sum(phi) = f(x) - mean prediction over the training rows.
* PCA: per race the 5x5 covariance is an aggregate; only that tiny matrix
  (one row per race) goes through a grouped pandas function for the eigen
  decomposition, then points are projected with column arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapstats.functions.ranking import row_numbers
from lapstats.operators import ml, treevalue
from lapstats.schema import SEED
from lapstats.session import materialize

PERMUTATION_REPEATS = 30
#: Hex digits of a permutation's hash that name a piece of it.
PIECE_DIGITS = 2


def _accuracy_by(pred: DataFrame, keys: list[str]) -> DataFrame:
    return pred.groupBy(*keys).agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("acc"))


def _predicted(tree: DataFrame, rows: DataFrame, key: list[str], feats: list[str], kept: list[str]) -> DataFrame:
    """key, the columns ``kept`` of each row and its prediction: they ride along as the row's name, so nothing is joined back."""
    return ml.tree_predict(tree, rows.withColumn("_about", F.struct(*kept)), key, feats, ident="_about").select(
        *key, "_about.*", "pred")


def permutation_importance(tree: DataFrame, data: DataFrame, key: Sequence[str], features: Sequence[str],
                           repeats: int = PERMUTATION_REPEATS, seed: int = SEED) -> DataFrame:
    """Mean / std of the accuracy drop when one feature is shuffled (``repeats`` times)."""
    key = list(key)
    feats = list(features)
    known = data.where(F.col("driver").isNotNull())
    base = _accuracy_by(_predicted(tree, known, key, feats, ["label"]), key).withColumnRenamed("acc", "_base")
    g = key + ["_f", "_rep"]
    shuffle_order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_rep").cast("string"),
                                      F.col("_f").cast("string"), F.col("driver")))
    # The order of the rows is the same for every feature and repeat: they are ranked once.
    tgt = materialize(row_numbers(data.select(*key, "driver", "label", *feats), key, [F.col("driver")], "_rk"), "perm_rows")
    # A copy carries its value only. Few pieces: there is a row per key, feature, repeat and piece.
    one = F.explode(F.array(*[F.struct(F.lit(i).alias("_f"), F.col(f).cast("double").alias("_pv")) for i, f in enumerate(feats)]))
    ex = (data.select(*key, "driver", one.alias("_e")).select(*key, "driver", "_e._f", "_e._pv")
          .withColumn("_rep", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))))
    src = row_numbers(ex, g, [shuffle_order, F.col("driver")], "_rk", F.substring(shuffle_order, 1, PIECE_DIGITS)).drop("driver")
    perm = tgt.join(src, key + ["_rk"]).select(
        *key, "label", "_f", "_rep",
        *[F.when(F.col("_f") == i, F.col("_pv")).otherwise(F.col(f)).alias(f) for i, f in enumerate(feats)])
    acc = _accuracy_by(_predicted(tree, perm, key, feats, ["_f", "_rep", "label"]), g).join(base, key)
    names = F.element_at(F.array(*[F.lit(f) for f in feats]), F.col("_f") + 1)
    return (acc.groupBy(*key, names.alias("feature"))
            .agg(F.avg(F.col("_base") - F.col("acc")).alias("importance_mean"),
                 F.stddev_pop(F.col("_base") - F.col("acc")).alias("importance_std")))


shapley_values = treevalue.path_shapley


def mean_abs_shap(phi: DataFrame, key: Sequence[str]) -> DataFrame:
    """Global Shapley importance: mean |phi| per feature, descending rank."""
    key = list(key)
    m = phi.groupBy(*key, "feature").agg(F.avg(F.abs("phi")).alias("mean_abs_shap"))
    return m.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("mean_abs_shap"),
                                                                                       "feature")))


def local_explanations(tree: DataFrame, data: DataFrame, key: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Per driver prediction, actual, correctness, confidence and feature values."""
    key = list(key)
    p = ml.tree_predict(tree, data, key, features)
    return (data.join(p, key + ["driver"])
            .select(*key, "driver", F.col("pred").alias("prediction"), F.col("label").alias("actual"),
                    (F.col("pred") == F.col("label")).alias("correct"),
                    F.greatest(F.col("proba"), 1 - F.col("proba")).alias("confidence"), *features))


def pca_2d(data: DataFrame, key: Sequence[str], features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """M6: per-race PCA (2 components) of the standardised features.

    Returns (points with pc1 / pc2, components with loadings and explained
    variance ratio). The sign of each component is fixed so its largest
    loading is positive.
    """
    key = list(key)
    feats = list(features)
    d = len(feats)
    prods = [F.sum(F.col(a) * F.col(b)).alias(f"_p_{i}_{j}") for i, a in enumerate(feats) for j, b in
             enumerate(feats) if j >= i]
    mom = data.groupBy(*key).agg(F.count("*").alias("_n"), *[F.sum(f).alias(f"_s_{i}") for i, f in enumerate(feats)],
                                 *prods)

    out_schema = ", ".join([f"{k} {t}" for k, t in data.select(*key).dtypes]
                           + ["component int", "explained_variance_ratio double"]
                           + [f"loading_{i} double" for i in range(d)] + [f"mean_{i} double" for i in range(d)])

    def eig(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        n = float(r["_n"])
        mu = np.array([r[f"_s_{i}"] for i in range(d)]) / n
        c = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                c[i, j] = c[j, i] = (r[f"_p_{i}_{j}"] - n * mu[i] * mu[j]) / max(n - 1.0, 1.0)
        vals, vecs = np.linalg.eigh(c)
        order = np.argsort(vals)[::-1]
        vals, vecs = vals[order], vecs[:, order]
        total = vals.clip(min=0).sum()
        rows = []
        for comp in range(min(2, d)):
            v = vecs[:, comp]
            if v[np.argmax(np.abs(v))] < 0:
                v = -v
            row = {k: r[k] for k in key}
            row.update({"component": comp + 1,
                        "explained_variance_ratio": float(vals[comp] / total) if total > 0 else 0.0})
            row.update({f"loading_{i}": float(v[i]) for i in range(d)})
            row.update({f"mean_{i}": float(mu[i]) for i in range(d)})
            rows.append(row)
        return pd.DataFrame(rows)

    comps = materialize(mom.groupBy(*key).applyInPandas(eig, out_schema), "pca_components")
    proj = lambda c: sum(((F.col(f) - F.col(f"_c{c}.mean_{i}")) * F.col(f"_c{c}.loading_{i}")
                          for i, f in enumerate(feats)), F.lit(0.0))
    c1 = comps.where(F.col("component") == 1).alias("_c1")
    c2 = comps.where(F.col("component") == 2).alias("_c2")
    pts = (data.alias("p").join(c1, key).join(c2, key, "left")
           .select(*key, F.col("p.driver").alias("driver"),
                   proj(1).alias("pc1"), proj(2).alias("pc2")))
    names = {f"loading_{i}": f"loading_{f}" for i, f in enumerate(feats)}
    return pts, comps.select(*key, "component", "explained_variance_ratio",
                             *[F.col(k).alias(v) for k, v in names.items()])
