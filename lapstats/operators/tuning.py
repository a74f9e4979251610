"""Hyper-parameter search and sweeps.

Every variant becomes an extra key column (fit, dropped feature, train size, ...),
so one tree fit and one neighbour search per sweep train all variants of all races
and folds together. Configurations that only end a tree earlier are read off one
full tree.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapstats.functions.ranking import hash_piece, row_numbers
from lapstats.operators import ml
from lapstats.schema import MODEL_FEATURES, SEED
from lapstats.session import materialize

# ---- fixed values: the reference's search grids ----
DT_GRID = {"max_depth": [3, 4, 5, 7, None], "min_samples_split": [2, 4, 6], "min_samples_leaf": [1, 2, 3],
           "criterion": ["gini", "entropy"]}
KNN_GRID = {"n_neighbors": [3, 5, 7, 9], "metric": ["euclidean", "manhattan"], "weights": ["uniform", "distance"]}
KMEANS_GRID = {"n_clusters": [2, 3, 4, 5], "init": ["distance", "hash"]}
TOP_K = 5


def _explode_configs(df: DataFrame, configs: list[dict], name: str = "config") -> DataFrame:
    """Attach every configuration to every row via a generator (no join)."""
    lit = lambda v: F.lit(None).cast("int") if v is None else F.lit(v)
    structs = [F.struct(F.lit(i).alias(name), *[lit(v).alias(k) for k, v in c.items()]) for i, c in enumerate(configs)]
    return df.withColumn("_cfg", F.explode(F.array(*structs))).select("*", "_cfg.*").drop("_cfg")


def accuracy(pred: DataFrame, truth: DataFrame, keys: list[str], ident: str = "driver") -> DataFrame:
    """Share of the rows of ``truth`` whose ``pred`` equals the label, per ``keys``, as ``acc``."""
    return (pred.join(truth.select(*keys, ident, "label"), keys + [ident])
            .groupBy(*keys).agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("acc")))


def tree_cv_scores(train: DataFrame, test: DataFrame, keys: list[str], features: Sequence[str],
                   params: DataFrame, with_train: bool = False) -> DataFrame:
    """Validation (and optionally training) accuracy per ``keys`` (which include the fold)."""
    tree = ml.tree_fit(train, keys, features, params=params)
    out = accuracy(ml.tree_predict(tree, test, keys, features), test, keys).withColumnRenamed("acc", "val_acc")
    if with_train:
        tr = accuracy(ml.tree_predict(tree, train, keys, features), train, keys).withColumnRenamed("acc", "train_acc")
        out = out.join(tr, keys)
    return out


def nested_tree_scores(train: DataFrame, test: DataFrame, keys: list[str], features: Sequence[str],
                       configs: list[dict], with_train: bool = False) -> DataFrame:
    """``tree_cv_scores`` of every configuration (numbered by place, column ``config``) from few fits.

    Configurations of one criterion and leaf size share a full tree: depth and
    the rows that a split needs only say where it ends. So a row is copied once
    per (criterion, leaf size), not once per configuration.
    """
    fits = list(dict.fromkeys((c["criterion"], c["min_samples_leaf"]) for c in configs))
    depths = [c["max_depth"] for c in configs]
    full = [{"max_depth": None if None in depths else max(depths), "min_samples_leaf": leaf, "criterion": crit,
             "min_samples_split": min(c["min_samples_split"] for c in configs)} for crit, leaf in fits]
    kf = keys + ["fit"]
    tr = _explode_configs(train, full, "fit")
    te = _explode_configs(test, full, "fit").select(*kf, "label", *features)
    params = tr.select(*kf, *full[0]).distinct()
    tree = ml.tree_fit(tr, kf, features, params=params)
    ends = F.array(*[F.struct(F.lit(fits.index((c["criterion"], c["min_samples_leaf"]))).alias("fit"),
                              F.lit(i).alias("config"), F.lit(c["max_depth"]).cast("int").alias("depth"),
                              F.lit(c["min_samples_split"]).alias("split")) for i, c in enumerate(configs)])

    def scores(rows: DataFrame) -> DataFrame:
        own = F.explode(F.filter(ends, lambda c: c["fit"] == F.col("fit"))).alias("_c")
        hit = ml.pruned_prediction(F.col("_path"), F.col("_c.depth"), F.col("_c.split")) == F.col("label")
        return (ml.tree_paths(tree, rows, kf, features).select(*keys, "label", "_path", own)
                .groupBy(*keys, F.col("_c.config").alias("config")).agg(F.avg(hit.cast("double")).alias("acc")))

    out = scores(te).withColumnRenamed("acc", "val_acc")
    if with_train:
        out = out.join(scores(tr.select(*kf, "label", *features)).withColumnRenamed("acc", "train_acc"), keys + ["config"])
    return out


def knn_cv_scores(train: DataFrame, test: DataFrame, keys: list[str], features: Sequence[str],
                  ks: Sequence[int], metric: str = "euclidean", weights: Sequence[str] = ("uniform",),
                  with_train: bool = False) -> DataFrame:
    """Accuracy for every k in ``ks`` and vote in ``weights`` from one neighbour search with max(ks)."""
    votes = list(itertools.product(ks, weights))

    def scores(rows: DataFrame, name: str) -> DataFrame:
        lists = ml.neighbours.knn_lists(train, rows, keys, features, k=max(ks), metric=metric).withColumnRenamed("_qid", "driver")
        # All votes of a query are read off its list at once.
        hits = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(vote).alias("weights"), (
            ml.list_vote(F.col("_near"), k, vote)["pred"] == F.col("label")).alias("hit")) for k, vote in votes])
        return (lists.join(rows.select(*keys, "driver", "label"), keys + ["driver"])
                .select(*keys, F.explode(hits).alias("_v")).groupBy(*keys, F.col("_v.k").alias("k"), F.col("_v.weights").alias("weights"))
                .agg(F.avg(F.col("_v.hit").cast("double")).alias(name)))

    out = scores(test, "val_acc")
    return out.join(scores(train, "train_acc"), keys + ["k", "weights"]) if with_train else out


def _cv_data(matrix: DataFrame, key: list[str], features: Sequence[str], n_splits: int, seed: int = SEED,
             scaled: bool = True):
    rows = ml.model_input(matrix, key, features) if scaled else matrix.select(
        *key, "driver", F.col("strong_performance").alias("label"),
        *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    data = materialize(ml.assign_folds(rows, key, n_splits, seed=seed), "tune_data")
    train, test = ml.fold_sets(data, key)
    return data, train, test


def grid_search(matrix: DataFrame, key: Sequence[str], features: Sequence[str] = MODEL_FEATURES,
                inner_folds: int = 3) -> DataFrame:
    """Mean inner-CV accuracy of every tree (90) and kNN (16) configuration.

    Returns key, model, config, params (text), mean_score, rank (min-rank by
    score, W5), in_top5; kNN configs with n_neighbors >= rows of the race are dropped.
    """
    key = list(key)
    data, train, test = _cv_data(matrix, key, features, inner_folds, seed=SEED + 1)
    # Configurations are numbered by sorted parameter name, the last one fastest; ties go to the lowest number.
    names = sorted(DT_GRID)
    dt_cfgs = [dict(zip(names, v)) for v in itertools.product(*(DT_GRID[n] for n in names))]
    dt = nested_tree_scores(train, test, key + ["cv_fold"], features, dt_cfgs)
    dt = dt.groupBy(*key, "config").agg(F.avg("val_acc").alias("mean_score"))
    dt_names = F.element_at(F.array(*[F.lit(str(c)) for c in dt_cfgs]), F.col("config") + 1)
    dt = dt.select(*key, F.lit("Decision Tree").alias("model"), "config", dt_names.alias("params"), "mean_score")

    n_rows = data.groupBy(*key).agg(F.count("*").alias("_n"))
    knn_parts = []
    ks, votes = KNN_GRID["n_neighbors"], KNN_GRID["weights"]
    place = lambda values, c: F.array_position(F.array(*[F.lit(v) for v in values]), F.col(c)) - 1
    for i, metric in enumerate(KNN_GRID["metric"]):
        s = knn_cv_scores(train, test, key + ["cv_fold"], features, ks, metric, votes)
        s = s.groupBy(*key, "k", "weights").agg(F.avg("val_acc").alias("mean_score")).join(n_rows, key).where(
            F.col("k") < F.col("_n"))
        number = F.lit(i * len(ks) * len(votes)) + place(ks, "k") * len(votes) + place(votes, "weights")
        knn_parts.append(s.select(
            *key, F.lit("kNN").alias("model"), number.cast("int").alias("config"),
            F.format_string("{'metric': '%s', 'n_neighbors': %d, 'weights': '%s'}", F.lit(metric), F.col("k"),
                            F.col("weights")).alias("params"), "mean_score"))
    out = dt
    for p in knn_parts:
        out = out.unionByName(p)
    w = Window.partitionBy(*key, "model").orderBy(F.desc("mean_score"))
    return out.withColumn("rank", F.rank().over(w)).withColumn("in_top5", F.col("rank") <= TOP_K)


def best_params(grid: DataFrame, key: Sequence[str]) -> DataFrame:
    """Best configuration per race and model (first in config order on ties)."""
    return grid.groupBy(*key, "model").agg(
        F.min_by(F.struct("params", "mean_score"), F.struct(F.negative("mean_score"), "config")).alias("_b")
    ).select(*key, "model", F.col("_b.params").alias("best_params"), F.col("_b.mean_score").alias("best_score"))


def complexity_sweep(matrix: DataFrame, key: Sequence[str], features: Sequence[str] = MODEL_FEATURES,
                     depths: Sequence[int] = tuple(range(1, 11)), max_k: int = 15, folds: int = 3) -> DataFrame:
    """Train / validation accuracy and gap over tree depth 1..10 and k 1..min(15, train-1)."""
    key = list(key)
    data, train, test = _cv_data(matrix, key, features, folds)
    cfgs = [{"max_depth": d, "min_samples_split": 2, "min_samples_leaf": 1, "criterion": "gini"} for d in depths]
    dt = nested_tree_scores(train, test, key + ["cv_fold"], features, cfgs, with_train=True).groupBy(*key, "config").agg(
        F.avg("train_acc").alias("train_acc"), F.avg("val_acc").alias("val_acc"))
    dt = dt.select(*key, F.lit("Decision Tree").alias("model"), F.lit("max_depth").alias("param"),
                   (F.col("config") + 1).alias("value"), "train_acc", "val_acc")
    n_train = train.groupBy(*key, "cv_fold").agg(F.count("*").alias("_nt")).groupBy(*key).agg(
        F.min("_nt").alias("_nt"))
    kn = knn_cv_scores(train, test, key + ["cv_fold"], features, list(range(1, max_k + 1)), with_train=True)
    kn = (kn.groupBy(*key, "k").agg(F.avg("train_acc").alias("train_acc"), F.avg("val_acc").alias("val_acc"))
          .join(n_train, key).where(F.col("k") <= F.col("_nt") - 1)
          .select(*key, F.lit("kNN").alias("model"), F.lit("n_neighbors").alias("param"), F.col("k").alias("value"),
                  "train_acc", "val_acc"))
    out = dt.unionByName(kn).withColumn("gap", F.col("train_acc") - F.col("val_acc"))
    best = out.groupBy(*key, "model").agg(F.max_by("value", F.struct("val_acc", F.negative("value"))).alias("_best"))
    return out.join(best, key + ["model"]).withColumn("is_best", F.col("value") == F.col("_best")).drop("_best")


def ablation(matrix: DataFrame, key: Sequence[str], features: Sequence[str] = MODEL_FEATURES,
             folds: int = 3) -> DataFrame:
    """Drop-one-feature CV accuracy deltas (depth-3 tree, 3-NN), avg_delta ascending.

    Dropping a feature = zeroing it in every row: a constant column offers the
    tree no split and adds nothing to distances, so all variants train together.
    """
    key = list(key)
    feats = list(features)
    data, train, test = _cv_data(matrix, key, feats, folds)
    variants = ["__baseline__"] + feats

    def zeroed(df: DataFrame) -> DataFrame:
        d = df.withColumn("dropped", F.explode(F.array(*[F.lit(v) for v in variants])))
        return d.select(*[c for c in d.columns if c not in feats],
                        *[F.when(F.col("dropped") == f, F.lit(0.0)).otherwise(F.col(f)).alias(f) for f in feats])
    tr, te = zeroed(train), zeroed(test)
    kf = key + ["cv_fold", "dropped"]
    params = tr.select(*kf).distinct().select(*kf, F.lit(3).alias("max_depth"), F.lit(2).alias("min_samples_split"),
                                              F.lit(1).alias("min_samples_leaf"), F.lit("gini").alias("criterion"))
    dt = tree_cv_scores(tr, te, kf, feats, params).groupBy(*key, "dropped").agg(F.avg("val_acc").alias("dt"))
    kn = knn_cv_scores(tr, te, kf, feats, [3]).groupBy(*key, "dropped").agg(F.avg("val_acc").alias("knn"))
    s = dt.join(kn, key + ["dropped"])
    base = s.where(F.col("dropped") == "__baseline__").select(*key, F.col("dt").alias("_bdt"), F.col("knn").alias("_bkn"))
    r = s.where(F.col("dropped") != "__baseline__").join(base, key)
    return r.select(*key, F.col("dropped").alias("feature"), F.round("dt", 4).alias("dt_without"),
                    F.round("knn", 4).alias("knn_without"), F.round(F.col("dt") - F.col("_bdt"), 4).alias("delta_dt"),
                    F.round(F.col("knn") - F.col("_bkn"), 4).alias("delta_knn"),
                    F.round(((F.col("dt") - F.col("_bdt")) + (F.col("knn") - F.col("_bkn"))) / 2, 4).alias("avg_delta"))


def learning_curve(matrix: DataFrame, key: Sequence[str], features: Sequence[str] = MODEL_FEATURES,
                   folds: int = 3, points: int = 6) -> DataFrame:
    """Train / validation accuracy (mean, population std over folds) at up to 6
    training sizes between max(2k, 30% of n) and the fold training size - 1; features as they are, not scaled."""
    key = list(key)
    data, train, test = _cv_data(matrix, key, features, folds, scaled=False)
    n = data.groupBy(*key).agg(F.count("*").alias("_n"), F.first("n_folds").alias("_k"))
    mx = F.floor(F.col("_n") * (F.col("_k") - 1) / F.col("_k")) - 1
    mn = F.least(F.greatest(2 * F.col("_k"), F.floor(F.col("_n") * 0.3)), mx - 1)
    sizes = n.select(*key, F.explode(F.array(*[
        F.least(F.greatest(F.floor(mn + (mx - mn) * i / (points - 1)), F.lit(2)), mx).cast("int")
        for i in range(points)])).alias("size")).distinct()
    order = ml.hash_order(key, seed=SEED + 2)
    sub = (row_numbers(train, key + ["cv_fold"], [order, F.col("driver")], "_rn", hash_piece(order)).join(sizes, key)
           .where(F.col("_rn") <= F.col("size")).drop("_rn"))
    te = test.join(sizes, key)
    kf = key + ["cv_fold", "size"]
    params = sub.select(*kf).distinct().select(*kf, F.lit(3).alias("max_depth"), F.lit(2).alias("min_samples_split"),
                                               F.lit(1).alias("min_samples_leaf"), F.lit("gini").alias("criterion"))
    dt = tree_cv_scores(sub, te, kf, features, params, with_train=True).withColumn("model", F.lit("Decision Tree"))
    kn = knn_cv_scores(sub, te, kf, features, [3], with_train=True).drop("k", "weights").withColumn("model", F.lit("kNN"))
    s = dt.unionByName(kn)
    return s.groupBy(*key, "model", "size").agg(
        F.avg("train_acc").alias("train_mean"), F.stddev_pop("train_acc").alias("train_std"),
        F.avg("val_acc").alias("val_mean"), F.stddev_pop("val_acc").alias("val_std"))


def holdout_split(data: DataFrame, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """M7: stratified hold-out flag: 30% test (20% when the race has < 6 rows),
    per class in md5 order; a class too small to split stays in training."""
    key = list(key)
    n = data.groupBy(*key).agg(F.count("*").alias("_n"))
    frac = F.when(F.col("_n") < 6, F.lit(0.2)).otherwise(F.lit(0.3))
    order = ml.hash_order(key, seed=seed)
    ranked = row_numbers(data.join(n, key), key + ["label"], [order, F.col("driver")], "_rn", hash_piece(order), "_c")
    return (ranked
            .withColumn("is_test", (F.col("_c") >= 2) & (F.col("_rn") <= F.round(F.col("_c") * frac)))
            .drop("_rn", "_c", "_n"))


def model_winner(scores: DataFrame, key: Sequence[str]) -> DataFrame:
    """The tree wins when its hold-out accuracy is at least the kNN accuracy."""
    key = list(key)
    p = scores.groupBy(*key).agg(
        F.max(F.when(F.col("model") == "Decision Tree", F.col("accuracy"))).alias("dt_acc"),
        F.max(F.when(F.col("model") == "kNN", F.col("accuracy"))).alias("knn_acc"))
    return p.withColumn("winner", F.when(F.col("dt_acc") >= F.col("knn_acc"), F.lit("Decision Tree"))
                        .otherwise(F.lit("kNN")))


def kmeans_grid(points: DataFrame, key: Sequence[str], features: Sequence[str]) -> DataFrame:
    """M5: silhouette of k in 2..5 under two initialisations, ranked per race."""
    key = list(key)
    runs = list(itertools.product(KMEANS_GRID["n_clusters"], KMEANS_GRID["init"]))
    out = None
    for (k, init), (assign, _) in zip(runs, ml.kmeans_runs(points, key, features, runs), strict=True):
        assign = materialize(assign, "km_grid")
        r = (ml.silhouette_sq(points, assign, key, features).join(ml.inertia(assign, key), key)
             .withColumn("k", F.lit(k)).withColumn("init", F.lit(init)))
        out = r if out is None else out.unionByName(r)
    w = Window.partitionBy(*key).orderBy(F.desc("silhouette"), "k", "init")
    return out.withColumn("rank", F.row_number().over(w))
