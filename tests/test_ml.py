"""Property checks for the ML operators (exactness against brute force, invariants)."""

import hashlib
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lapstats.operators import explain as XP
from lapstats.operators import ml as ML
from lapstats.operators import neighbours, treevalue
from lapstats.operators import tuning as TU

FEATS = ["a", "b", "c"]


def _points(spark, n=120, seed=3, skew=False):
    rng = np.random.default_rng(seed)
    rows = []
    for race in ("r1", "r2"):
        x = rng.normal(size=(n, 3))
        x[:10] = x[0]  # duplicates -> distance ties
        if skew:  # one far outlier and a tight cluster: skewed projections
            x[10] = 60.0
            x[11:60] = x[11:60] * 0.01
        y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int)
        rows += [(race, f"d{i:03d}", int(y[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "race string, driver string, label int, a double, b double, c double")


@pytest.mark.parametrize("metric,skew", [("euclidean", False), ("manhattan", False), ("euclidean", True)])
def test_knn_matches_brute_force(spark, metric, skew):
    df = _points(spark, skew=skew)
    train = df.where(F.col("driver") >= "d030")
    query = df.where(F.col("driver") < "d030")
    got = ML.knn_neighbors(train, query, ["race"], FEATS, k=5, metric=metric).collect()
    got = {(r.race, r._qid, r._r): r._tid for r in got}
    pdf = df.toPandas()
    for race in ("r1", "r2"):
        p = pdf[pdf.race == race]
        tr, qu = p[p.driver >= "d030"], p[p.driver < "d030"]
        for _, q in qu.iterrows():
            diff = tr[FEATS].to_numpy() - q[FEATS].to_numpy(dtype=float)
            d = np.abs(diff).sum(1) if metric == "manhattan" else np.sqrt((diff ** 2).sum(1))
            order = sorted(zip(d, tr.driver))[:5]
            assert [got[(race, q.driver, i + 1)] for i in range(5)] == [t for _, t in order]


def test_folds_are_stratified_partition(spark):
    df = _points(spark)
    f = ML.assign_folds(df, ["race"], 5).toPandas()
    assert f.groupby("race").driver.nunique().tolist() == [120, 120]
    for (race, label), g in f.groupby(["race", "label"]):
        counts = g.fold.value_counts()
        assert counts.max() - counts.min() <= 1


def test_tree_fits_separable_data_and_shapley_efficiency(spark):
    df = _points(spark, n=60)
    tree = ML.tree_fit(df, ["race"], FEATS, max_depth=8)
    pred = ML.tree_predict(tree, df, ["race"], FEATS).join(df, ["race", "driver"])
    # duplicated points share one label, so training accuracy is perfect
    acc = pred.agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0]
    assert acc == pytest.approx(1.0)
    phi = XP.shapley_values(tree, df, ["race"], FEATS).toPandas()
    s = phi.groupby(["race", "driver"]).agg(phi_sum=("phi", "sum"), f_x=("f_x", "first"), f_b=("f_base", "first"))
    assert np.allclose(s.phi_sum, s.f_x - s.f_b, atol=1e-9)


def _expected(nodes, row, coalition, at="1"):
    """Prediction that follows the row at splits on features of the coalition, and both ways by their rows elsewhere."""
    n = nodes[at]
    if n.is_leaf:
        return n.proba
    if FEATS[n.feature] in coalition:
        return _expected(nodes, row, coalition, at + ("0" if row[FEATS[n.feature]] <= n.threshold else "1"))
    return sum(nodes[at + b].n / n.n * _expected(nodes, row, coalition, at + b) for b in "01")


def test_path_shapley_equals_enumeration(spark):
    df = _points(spark, n=50).withColumn("label", (F.xxhash64("driver") % 3 == 0).cast("int"))
    tree = ML.tree_fit(df, ["race"], FEATS, max_depth=4)
    nodes = {}
    for n in tree.collect():
        nodes.setdefault(n.race, {})[n.node] = n
    got = {(r.race, r.driver, r.feature): r for r in XP.shapley_values(tree, df, ["race"], FEATS).collect()}
    for row in df.where("driver < 'd020'").collect():
        for i, f in enumerate(FEATS):
            others = [g for g in FEATS if g != f]
            want = sum(math.factorial(len(c)) * math.factorial(2 - len(c)) / 6
                       * (_expected(nodes[row.race], row, {*c, f}) - _expected(nodes[row.race], row, set(c)))
                       for size in range(3) for c in itertools.combinations(others, size))
            r = got[row.race, row.driver, f]
            assert r.phi == pytest.approx(want, abs=1e-9)
            assert r.f_base == pytest.approx(_expected(nodes[row.race], row, set()))
            assert r.f_x == pytest.approx(_expected(nodes[row.race], row, set(FEATS)))


def test_trees_as_values_and_routing_by_joins_agree(spark, monkeypatch):
    df = _points(spark, n=80).withColumn("label", (F.xxhash64("driver") % 2 == 0).cast("int"))
    tree = ML.tree_fit(df, ["race"], FEATS, max_depth=None)
    by_value = ML.tree_predict(tree, df, ["race"], FEATS)
    plan = by_value._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1
    monkeypatch.setattr(treevalue, "MOST_NODES", 0)
    key = lambda r: (r.race, r.driver)
    assert sorted(by_value.collect(), key=key) == sorted(ML.tree_predict(tree, df, ["race"], FEATS).collect(), key=key)


@pytest.mark.parametrize("dims,share", [(5, 0.1), (24, 1.0)])
def test_knn_measures_few_rows_in_few_dimensions(spark, dims, share):
    n = 20_000 if dims == 5 else 1_500
    x = np.random.default_rng(dims).normal(size=(n, dims))
    names = [f"f{i}" for i in range(dims)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(race="r", driver=np.arange(n), label=0)).cache()
    query = df.where("driver % 50 = 0")
    found = neighbours.candidates(df, query, ["race"], names, k=5)
    counts = found.groupBy("_qid").count().agg(F.avg("count"), F.count("*")).first()
    print(f"{dims} dimensions: {counts[0]:.0f} of {n} rows measured per query")
    assert counts[1] == n // 50 and counts[0] < share * n + 1
    got = {}
    for r in ML.knn_neighbors(df, query, ["race"], names, k=5).collect():
        got.setdefault(r._qid, {})[r._r] = r._tid
    for q in list(got)[:100]:
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        assert [got[q][i] for i in range(1, 6)] == np.lexsort((np.arange(n), d))[:5].tolist()


def test_knn_with_fewer_rows_than_k_and_constant_features(spark):
    df = spark.createDataFrame([(r, f"d{i}", 0, 1.0, 2.0) for r, n in (("x", 3), ("y", 90)) for i in range(n)],
                               "race string, driver string, label int, a double, b double")
    got = ML.knn_neighbors(df, df, ["race"], ["a", "b"], k=5).groupBy("race", "_qid").count().collect()
    assert {(r.race, r["count"]) for r in got} == {("x", 3), ("y", 5)} and len(got) == 93


def test_silhouette_squared_matches_numpy(spark):
    df = _points(spark, n=40)
    assign, _ = ML.kmeans(df, ["race"], FEATS, k=3, max_iter=20)
    got = {r.race: r.silhouette for r in ML.silhouette_sq(df, assign, ["race"], FEATS).collect()}
    a = assign.toPandas().merge(df.toPandas(), on=["race", "driver"])
    for race, g in a.groupby("race"):
        x = g[FEATS].to_numpy()
        lab = g.cluster.to_numpy()
        d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
        s = []
        for i in range(len(x)):
            own = lab == lab[i]
            if own.sum() <= 1:
                s.append(0.0)
                continue
            ai = d2[i, own].sum() / (own.sum() - 1)
            bi = min(d2[i, lab == c].mean() for c in set(lab) if c != lab[i])
            s.append((bi - ai) / max(ai, bi))
        assert got[race] == pytest.approx(float(np.mean(s)), abs=1e-9)


def test_kmeans_best_start_is_never_worse_and_spread_starts_apart(spark):
    df = _points(spark, n=40)
    total = {(s, i): {r.race: r.inertia for r in ML.inertia(ML.kmeans(df, ["race"], FEATS, k=4, starts=s, init=i)[0],
                                                           ["race"]).collect()}
             for s, i in ((1, "hash"), (10, "hash"), (3, "spread"))}
    for race in ("r1", "r2"):
        assert total[10, "hash"][race] <= total[1, "hash"][race] + 1e-9
        assert total[3, "spread"][race] > 0
    # Three far groups: farthest-first meets each of them once, whatever the first row is.
    far = spark.createDataFrame([("r", f"d{i}", 100.0 * (i % 3) + 0.1 * i, 0.0, 0.0) for i in range(12)],
                                "race string, driver string, a double, b double, c double")
    a = ML.kmeans(far, ["race"], FEATS, k=3, starts=1, init="spread")[0].collect()
    assert len({(r.cluster, int(r.driver[1:]) % 3) for r in a}) == 3


def test_distance_starts_meet_far_groups_and_small_races(spark):
    far = [("far", f"d{i:03d}", 100.0 * (i % 5) + 0.01 * i, float(i % 3), 0.0) for i in range(200)]
    same = [("same", f"d{i}", 1.0, 1.0, 1.0) for i in range(8)]
    pair = [("pair", "d0", 0.0, 0.0, 0.0), ("pair", "d1", 5.0, 0.0, 0.0)]
    alone = [("alone", "d0", 0.0, 0.0, 0.0)]
    one_off = [("one_off", f"d{i:03d}", 1e6 if i == 7 else 0.001 * i, 0.0, 0.0) for i in range(100)]
    df = spark.createDataFrame(far + same + pair + alone + one_off,
                               "race string, driver string, a double, b double, c double")
    assign, cent = ML.kmeans(df, ["race"], FEATS, k=5, starts=1, max_iter=3)
    rows = assign.collect()
    clusters = {}
    for r in rows:
        clusters.setdefault(r.race, {}).setdefault(r.cluster, set()).add(r.driver)
    assert len({(r.cluster, int(r.driver[1:]) % 5) for r in rows if r.race == "far"}) == 5
    assert len(rows) == 200 + 8 + 2 + 100 and "alone" not in clusters
    assert len(clusters["same"]) == 1 and len(clusters["pair"]) == 1
    assert len(clusters["one_off"]) == 5 and {"d007"} in clusters["one_off"].values()
    assert cent.columns == ["race", "cluster", *FEATS]
    again = ML.kmeans(df.repartition(7), ["race"], FEATS, k=5, starts=1, max_iter=3)[0].collect()
    assert {(r.race, r.driver, r.cluster) for r in again} == {(r.race, r.driver, r.cluster) for r in rows}


def test_unlimited_tree_follows_a_deep_chain(spark):
    n = 38
    df = spark.createDataFrame([("r", f"d{i:02d}", i % 2, float(i)) for i in range(n)],
                               "race string, driver string, label int, a double")
    tree = ML.tree_fit(df, ["race"], ["a"], max_depth=None)
    assert tree.agg(F.max("depth")).first()[0] > 30
    assert tree.where("is_leaf AND proba NOT IN (0.0, 1.0)").count() == 0
    wrong = ML.tree_predict(tree, df, ["race"], ["a"]).join(df, ["race", "driver"]).where("pred != label")
    assert wrong.count() == 0


def test_tree_splits_neighbouring_floats(spark):
    low = 1.0
    high = math.nextafter(low, 2.0)
    top = math.nextafter(high, 2.0)
    df = spark.createDataFrame([("r", "x", 0, high), ("r", "y", 1, top)], "race string, driver string, label int, a double")
    got = ML.tree_predict(ML.tree_fit(df, ["race"], ["a"]), df, ["race"], ["a"]).collect()
    assert {(r.driver, r.pred) for r in got} == {("x", 0), ("y", 1)}


def test_comparison_rules_and_winner(spark):
    from lapstats.operators import evaluate as EV
    from lapstats.operators import tuning as TU

    key = ["race"]
    summary = spark.createDataFrame(
        [("a", "Decision Tree", 0.8, 0.9, 0.2), ("a", "kNN", 0.8, 0.8, 0.1),
         ("b", "Decision Tree", 0.5, None, 0.1), ("b", "kNN", 0.6, 0.54, 0.16)],
        "race string, model string, cv_mean_acc double, auc double, overfit_gap double")
    grid = spark.createDataFrame(
        [("a", "kNN", 3, "p3", 0.7), ("a", "kNN", 1, "p1", 0.7), ("a", "Decision Tree", 0, "t0", 0.6)],
        "race string, model string, config int, params string, mean_score double")
    got = {(r.race, r.model): r for r in EV.comparison_table(summary, grid, key).collect()}
    assert got["a", "kNN"].best_params == "p1" and got["a", "kNN"].gs_best_score == 0.7
    assert got["a", "kNN"].auc_rule == "tree_higher" and got["b", "kNN"].auc_rule == "similar"
    assert [got["a", m].overfit_risk for m in ("Decision Tree", "kNN")] == [True, False]
    assert got["b", "kNN"].overfit_risk and got["b", "kNN"].best_params is None
    scores = summary.withColumnRenamed("cv_mean_acc", "accuracy")
    won = {r.race: r.winner for r in TU.model_winner(scores, key).collect()}
    assert won == {"a": "Decision Tree", "b": "kNN"}  # a tie goes to the tree


CONFIGS = [{"criterion": c, "max_depth": d, "min_samples_leaf": m, "min_samples_split": n}
           for c, d, m, n in itertools.product(("gini", "entropy"), (1, 3, None), (1, 3), (2, 7))]


def _folds(spark):
    data = _points(spark).where(F.col("race") == "r1").withColumn("label", F.when(
        F.substring("driver", -1, 1) == "7", 1 - F.col("label")).otherwise(F.col("label")))
    data = data.withColumn("fold", (F.substring("driver", 2, 3).cast("int") % 3)).withColumn("n_folds", F.lit(3))
    return ML.fold_sets(data, ["race"])


@pytest.mark.parametrize("most_nodes", [4096, 0])
def test_nested_trees_equal_separate_fits(spark, monkeypatch, most_nodes):
    """A pruned prefix of one full tree scores as the tree fitted with that depth and split size."""
    train, test = _folds(spark)
    kf = ["race", "cv_fold", "config"]
    tr, te = TU._explode_configs(train, CONFIGS), TU._explode_configs(test, CONFIGS)
    params = tr.select(*kf, *CONFIGS[0]).distinct()
    apart = {tuple(r[c] for c in kf): (r["val_acc"], r["train_acc"])
             for r in TU.tree_cv_scores(tr, te, kf, FEATS, params, with_train=True).collect()}
    monkeypatch.setattr(treevalue, "MOST_NODES", most_nodes)
    nested = {tuple(r[c] for c in kf): (r["val_acc"], r["train_acc"])
              for r in TU.nested_tree_scores(train, test, ["race", "cv_fold"], FEATS, CONFIGS, with_train=True).collect()}
    assert len(apart) == 3 * len(CONFIGS) and set(nested) == set(apart)
    assert all(nested[k] == pytest.approx(apart[k]) for k in apart)
    assert len({v for v in apart.values()}) > 10  # the configurations do differ


def test_nested_trees_of_an_empty_table(spark):
    train, test = _folds(spark)
    none = TU.nested_tree_scores(train.limit(0), test.limit(0), ["race", "cv_fold"], FEATS, CONFIGS, with_train=True)
    assert none.count() == 0


def test_splits_by_ordered_pieces_equal_one_window(spark, monkeypatch):
    data = _points(spark)
    whole = sorted(map(tuple, ML.tree_fit(data, ["race"], FEATS, max_depth=2).collect()), key=str)
    monkeypatch.setattr(ML, "WINDOW_MAX_ROWS", 20)
    pieces = sorted(map(tuple, ML.tree_fit(data, ["race"], FEATS, max_depth=2).collect()), key=str)
    assert whole == pieces and len(whole) > 4


def test_knn_of_many_equal_rows_and_queries_stays_bounded(spark, monkeypatch):
    """A place that half of the rows share is searched as k rows, its queries in several tasks; results are exact."""
    x = np.random.default_rng(5).normal(size=(400, 2)).round(1)
    x[:200] = 0.5
    df = spark.createDataFrame([("r", f"d{i:03d}", i % 2, *map(float, x[i])) for i in range(400)],
                               "race string, driver string, label int, a double, b double").cache()
    monkeypatch.setattr(neighbours, "TASK_QUERIES", 50)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    met = []
    search = neighbours._search
    monkeypatch.setattr(neighbours, "_search", lambda q, t, *a: (met.append(t.count()), search(q, t, *a))[1])
    for metric in ("euclidean", "manhattan"):
        got = {}
        for r in ML.knn_neighbors(df, df, ["race"], ["a", "b"], k=5, metric=metric).collect():
            got.setdefault(r._qid, {})[r._r] = r._tid
        for i in range(0, 400, 7):
            gap = np.abs(x - x[i])
            d = gap.sum(1) if metric == "manhattan" else np.sqrt((gap ** 2).sum(1))
            assert [got[f"d{i:03d}"][r] for r in range(1, 6)] == [f"d{j:03d}" for j in np.lexsort((np.arange(400), d))[:5]]
    assert max(met) <= 205  # 5 of the 200 equal rows


def test_list_vote_equals_row_vote(spark):
    df = _points(spark)
    train, query = df.where("driver >= 'd030'"), df.where("driver < 'd060'")
    rows = ML.knn_neighbors(train, query, ["race"], FEATS, k=7)
    for k, weights in ((3, "uniform"), (4, "uniform"), (7, "distance")):
        want = {(r.race, r._qid): (r.pred, round(r.proba, 9)) for r in ML.knn_vote(rows, ["race"], k, weights).collect()}
        lists = neighbours.knn_lists(train, query, ["race"], FEATS, k=7)
        got = {(r.race, r._qid): (r.v.pred, round(r.v.proba, 9)) for r in lists.select(
            "race", "_qid", ML.list_vote(F.col("_near"), k, weights).alias("v")).collect()}
        assert got == want and len(got) == 120


@pytest.mark.parametrize("criterion,leaf", [("gini", 1), ("entropy", 3)])
def test_subtrees_of_one_task_equal_levels(spark, monkeypatch, criterion, leaf):
    """Levels over all rows and tasks that grow the rest below small nodes give one tree."""
    data = _points(spark).withColumn("label", F.when(F.xxhash64("driver") % 5 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    data = data.select("race", "driver", "label", F.round("a", 1).alias("a"), F.round("b", 1).alias("b"), "c")
    nodes = {}
    for rows in (0, 30, 10_000):
        monkeypatch.setattr(ML, "TASK_ROWS", rows)
        tree = ML.tree_fit(data, ["race"], FEATS, max_depth=6, min_samples_leaf=leaf, criterion=criterion)
        nodes[rows] = sorted(map(tuple, tree.collect()), key=str)
    assert nodes[0] == nodes[30] == nodes[10_000] and len(nodes[0]) > 20


def test_kmeans_steps_in_tasks_equal_steps_by_joins(spark, monkeypatch):
    df = _points(spark, n=60)
    runs = [(3, "distance"), (2, "hash"), (4, "spread")]
    read = lambda out: [sorted((r.race, r.driver, r.cluster, round(r.sqdist, 9)) for r in a.collect()) for a, _ in out]
    together = read(ML.kmeans_runs(df.repartition(5), ["race"], FEATS, runs, starts=2))
    assert together == read([ML.kmeans(df, ["race"], FEATS, k=k, init=init, starts=2) for k, init in runs])
    steps = []
    step = ML._lloyd_step
    monkeypatch.setattr(ML, "_lloyd_step", lambda *a: (steps.append(1), step(*a))[1])
    assert read([ML.kmeans(df, ["race"], FEATS, k=3, starts=2)]) == together[:1] and not steps  # no join per step
    monkeypatch.setattr(ML, "BROADCAST_MAX_COORDINATES", 0)
    assert read([ML.kmeans(df, ["race"], FEATS, k=3, starts=2)]) == together[:1] and steps


def test_kmeans_steps_between_borders_need_few_passes(spark, monkeypatch):
    df = _points(spark, n=400).repartition(3).cache()
    read = lambda out: [sorted((r.race, r.driver, r.cluster, r.sqdist) for r in a.collect()) for a, _ in out]
    passes = []

    def counted(self, *a, f=type(df).mapInArrow):
        passes.append(1)
        return f(self, *a)

    rest = ML._rest

    def steps(*a):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(type(df), "mapInArrow", counted)
            return rest(*a)

    monkeypatch.setattr(ML, "_rest", steps)
    runs = [(3, "hash")]
    found, counts = [], []
    for loose in (0, 400_000):  # one point a task, all of them: the same sums
        monkeypatch.setattr(ML, "LOOSE_ROWS", loose)
        passes.clear()
        found.append(read(ML.kmeans_runs(df, ["race"], FEATS, runs, starts=2)))
        counts.append(len(passes))
    monkeypatch.setattr(ML, "PARTIAL_ROWS", 0)  # a pass per step, sums added up by Spark
    passes.clear()
    found.append(read(ML.kmeans_runs(df, ["race"], FEATS, runs, starts=2)))
    assert all(f == found[0] for f in found)
    assert counts[1] == 1 < len(passes) and counts[0] <= len(passes)


def test_nearest_in_tasks_equals_nearest_by_join(spark):
    rows = [("r", "a", 0.0, 1.0), ("r", "b", None, 2.0), ("r", "c", float("nan"), 0.0), ("r", "d", 5.0, 5.0), (None, "e", 1.0, 1.0),
            ("q", "f", 1.0, 1.0), ("r", None, 0.5, 1.0)]
    pts = spark.createDataFrame(rows, "race string, driver string, a double, b double")
    cent = spark.createDataFrame([("r", 0, "x", 0.0, 1.0), ("r", 0, "y", 1.0, 1.0), ("r", 1, "u", None, 3.0), ("r", 1, "v", 4.0, 4.0),
                                  ("r", 2, None, 9.0, 9.0), (None, 0, "z", 1.0, 1.0)],
                                 "race string, _start int, cluster string, a double, b double")
    by = ["race", "_start"]
    sets = ML._sets(cent, by, ["a", "b"])
    read = lambda f: sorted(map(str, f(pts, sets, ["race"], by, ["a", "b"]).collect()))
    assert read(ML._to_nearest) == read(ML._joined_to_nearest)
    assert len(read(ML._to_nearest)) == 15


def test_permutations_rank_the_rows_once_and_carry_one_value(spark, monkeypatch):
    df = _points(spark, n=60)
    tree = ML.tree_fit(df, ["race"], FEATS)
    ranked, rank = [], XP.row_numbers
    monkeypatch.setattr(XP, "row_numbers", lambda d, *a: (ranked.append((d.count(), len(d.columns))), rank(d, *a))[1])
    got = {(r.race, r.feature): (r.importance_mean, r.importance_std)
           for r in XP.permutation_importance(tree, df, ["race"], FEATS, repeats=3).collect()}
    assert ranked == [(120, 6), (120 * 3 * 3, 5)]
    # The same by hand: the i-th row by name gets the value of the i-th row by hash.
    drops = {}
    pred = lambda p: ML.tree_predict(tree, spark.createDataFrame(p), ["race"], FEATS).toPandas().sort_values("driver").pred
    for race, p in df.toPandas().groupby("race"):
        p = p.sort_values("driver").reset_index(drop=True)
        base = (pred(p).to_numpy() == p.label).mean()
        for f, name in enumerate(FEATS):
            for rep in range(3):
                order = sorted(range(len(p)), key=lambda i: hashlib.md5(f"{XP.SEED}|{rep}|{f}|{p.driver[i]}".encode()).hexdigest())
                q = p.assign(**{name: p[name].to_numpy()[order]})
                drops.setdefault((race, name), []).append(base - (pred(q).to_numpy() == q.label).mean())
    assert got.keys() == drops.keys()
    for k, d in drops.items():
        assert got[k] == pytest.approx((np.mean(d), np.std(d)), abs=1e-9)


def test_knn_of_keys_of_two_types_meets_every_cell(spark):
    """Training rows come with a long fold, queries with an int one: they meet also where tasks are not put together."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(race, f"d{i:02d}", i % 2, float(i), i % 3) for race in ("r1", "r2", "r3") for i in range(24)]
        df = spark.createDataFrame(rows, "race string, driver string, label int, a double, fold int")
        train, query = df.withColumn("fold", F.col("fold").cast("long")), df
        got = neighbours.knn_lists(train, query, ["race", "fold"], ["a"], k=3).collect()
        assert len(got) == 72
        for r in got:
            x = int(r._qid[1:])
            want = sorted((abs(x - i), f"d{i:02d}") for i in range(24) if i % 3 == r.fold)[:3]
            assert [(n._d, n._tid) for n in r._near] == want
        folds = ML.fold_sets(df.withColumn("n_folds", F.lit(3).cast("long")), ["race"])
        assert folds[0].schema["cv_fold"].dataType == folds[1].schema["cv_fold"].dataType
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
