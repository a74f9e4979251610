import numpy as np
import pytest

from lapstats.functions.aggregates import exact_quantiles, medians_by_key


def test_exact_quantiles_large_key_matches_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.round(rng.normal(90, 5, 20000), 3)
    small = np.array([1.0, 2.0, 4.0, 8.0])
    rows = [("hot", float(v)) for v in vals] + [("cold", float(v)) for v in small] + [("cold", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    # accuracy far below the key size forces the bracket path on the hot key
    out = {r.k: r for r in exact_quantiles(df, ["k"], "v", {"q25": .25, "q50": .5, "q75": .75}, accuracy=500).collect()}
    for name, p in (("q25", 25), ("q50", 50), ("q75", 75)):
        assert getattr(out["hot"], name) == pytest.approx(np.percentile(vals, p), abs=1e-12)
        assert getattr(out["cold"], name) == pytest.approx(np.percentile(small, p), abs=1e-12)


def test_medians_by_key_all_null_column(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, None), ("b", 5.0, 2.0)], "k string, x double, y double")
    out = {r.k: r for r in medians_by_key(df, ["k"], {"mx": "x", "my": "y"}).collect()}
    assert out["a"].mx == 2.0 and out["a"].my is None
    assert out["b"].mx == 5.0 and out["b"].my == 2.0


def test_exact_quantiles_hot_ties(spark):
    # one key where most rows share a value: the bracket collapses to it
    vals = [5.0] * 30000 + [float(i) for i in range(100)]
    df = spark.createDataFrame([("k", v) for v in vals], "k string, v double")
    r = exact_quantiles(df, ["k"], "v", {"q50": .5, "q01": .001}, accuracy=500).collect()[0]
    assert r.q50 == pytest.approx(np.percentile(vals, 50))
    assert r.q01 == pytest.approx(np.percentile(vals, 0.1))
