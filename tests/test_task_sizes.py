"""How much one task of the neighbour search and of a tree takes: enough that few passes are left, never a result."""

import numpy as np
from pyspark.sql import functions as F

from lapstats.operators import ml
from lapstats.operators import neighbours as N


def _rows(spark, n, features, seed):
    x = np.random.default_rng(seed).normal(size=(n, features))
    names = [f"f{i}" for i in range(features)]
    df = spark.createDataFrame([("r", f"d{i:05d}", int(i % 3 == 0), *map(float, v)) for i, v in enumerate(x)],
                               "race string, driver string, label int, " + ", ".join(f"{c} double" for c in names))
    return x, names, df


def test_a_few_thousand_wide_rows_are_one_cell(spark, monkeypatch):
    """Bounds prune next to nothing in many dimensions: more cells only meant that each query was measured in two passes."""
    x, names, df = _rows(spark, 6000, 10, 1)
    met = []
    whole = N._search
    monkeypatch.setattr(N, "_search", lambda q, *a: (met.append(q.count()), whole(q, *a))[1])
    queries = df.where("driver < 'd00020'")
    out = {r._qid: [n._tid for n in r._near] for r in N.knn_lists(df, queries, ["race"], names, k=3).collect()}
    assert met == [20, 0]
    for i in range(20):
        near = np.lexsort((np.arange(len(x)), np.sqrt(((x - x[i]) ** 2).sum(1))))[:3]
        assert out[f"d{i:05d}"] == [f"d{j:05d}" for j in near]


def test_queries_dealt_to_tasks_by_a_counted_share_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(N, "TASK_QUERIES", 40)
    monkeypatch.setattr(N, "BLOCK_ROWS", 64)
    x, names, df = _rows(spark, 700, 2, 2)
    out = {r._qid: [n._tid for n in r._near] for r in N.knn_lists(df, df, ["race"], names, k=4).collect()}
    assert len(out) == 700
    for i in range(700):
        near = np.lexsort((np.arange(len(x)), np.sqrt(((x - x[i]) ** 2).sum(1))))[:4]
        assert out[f"d{i:05d}"] == [f"d{j:05d}" for j in near]


def test_which_cells_a_query_meets_is_counted_on_a_share(spark):
    _, names, df = _rows(spark, 50, 2, 4)
    q = df.select("race", F.col("driver").alias("_qid"), F.lit(0).alias("_cell"), F.lit(float("inf")).alias("_reach"),
                  *[F.col(c).alias(f"_q_{c}") for c in names])
    t = _rows(spark, 50, 2, 4)[2].select("race", F.lit(0).alias("_cell"), F.col("driver").alias("_tid"), F.col("label").alias("_y"), *names)
    counted = []
    whole = N.checked_broadcast
    N.checked_broadcast = lambda d, *a: (counted.append(d._jdf.queryExecution().optimizedPlan().toString()), whole(d, *a))[1]
    try:
        assert N._search(q, t, ["race"], names, 2, "euclidean", ["race", "_qid"]).count() == 50
    finally:
        N.checked_broadcast = whole
    assert "xxhash64(11," in counted[0]


def test_a_node_of_some_ten_thousand_rows_needs_no_pass_per_level(spark, monkeypatch):
    df = spark.range(30_000).select(
        F.lit("r").alias("race"), (F.pmod(F.xxhash64("id"), 1000) / 7.0).alias("a"), (F.col("id") % 97).cast("double").alias("b"),
        ((F.pmod(F.xxhash64("id"), 1000) > 400) != (F.col("id") % 97 > 50)).cast("int").alias("label"))
    written = []
    whole = ml.materialize
    monkeypatch.setattr(ml, "materialize", lambda d, name="stage": (written.append(name), whole(d, name))[1])
    nodes = lambda t: sorted((r.node, r.feature, r.threshold, r.pred, r.n) for r in t.collect())
    one = nodes(ml.tree_fit(df, ["race"], ["a", "b"], max_depth=3))
    assert "tree_level" not in written
    monkeypatch.setattr(ml, "TASK_ROWS", 100)  # level by level in Spark
    levels = nodes(ml.tree_fit(df, ["race"], ["a", "b"], max_depth=3))
    assert "tree_level" in written and str(one) == str(levels)
