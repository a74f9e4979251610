"""Golden vectors from the reference's committed result tables (values copied here)."""

import math

import pytest

from lapstats.functions.pvalues import betainc_reg, t_two_sided_p
from lapstats.operators import significance as S

# Fold accuracies (tree, kNN) and the published statistics they produced.
BAHRAIN = ([0.8571, 0.8571, 1.0], [0.8571, 0.8571, 0.8333])


def _scores(spark, a, b, key="bahrain"):
    rows = [(key, i, float(x), float(y)) for i, (x, y) in enumerate(zip(a, b))]
    return spark.createDataFrame(rows, "race string, fold int, score_a double, score_b double")


def test_paired_t_golden(spark):
    r = S.paired_t(_scores(spark, *BAHRAIN), ["race"]).collect()[0]
    assert r.t_stat == pytest.approx(1.0, abs=1e-3)
    assert r.p_value == pytest.approx(0.4226, abs=2e-4)
    assert r.a_mean == pytest.approx(0.9048, abs=2e-4)
    assert r.a_std == pytest.approx(0.0673, abs=2e-4)
    assert not r.significant


def test_wilcoxon_golden_single_nonzero(spark):
    r = S.wilcoxon(_scores(spark, *BAHRAIN), ["race"]).collect()[0]
    assert r.stat == 0.0
    assert r.p_value == pytest.approx(1.0)


def test_wilcoxon_all_zero_and_short(spark):
    r = S.wilcoxon(_scores(spark, [0.5, 0.5, 0.5], [0.5, 0.5, 0.5]), ["race"]).collect()[0]
    assert (r.stat, r.p_value) == (0.0, 1.0)
    r = S.wilcoxon(_scores(spark, [0.5, 0.7], [0.4, 0.5]), ["race"]).collect()[0]
    assert (r.stat, r.p_value) == (0.0, 1.0)


def test_wilcoxon_exact_small(spark):
    # d = 1..6 all positive: W- = 0, exact two-sided p = 2 / 2^6
    r = S.wilcoxon(_scores(spark, [1, 2, 3, 4, 5, 6], [0] * 6), ["race"]).collect()[0]
    assert r.stat == 0.0
    assert r.p_value == pytest.approx(2 / 64)


@pytest.mark.parametrize("b,c,chi2,p", [(0, 2, 0.5, 0.4795), (2, 1, 0.0, 1.0), (0, 0, 0.0, 1.0)])
def test_mcnemar_golden(spark, b, c, chi2, p):
    rows = [("r", i, 1, 1, 0) for i in range(b)] + [("r", 100 + i, 1, 0, 1) for i in range(c)]
    rows += [("r", 1000, 1, 1, 1)]
    df = spark.createDataFrame(rows, "race string, id int, label int, pred_a int, pred_b int")
    r = S.mcnemar(df, ["race"]).collect()[0]
    assert (r.b, r.c) == (b, c)
    assert r.chi2_stat == pytest.approx(chi2)
    assert r.p_value == pytest.approx(p, abs=1e-4)


def test_t_distribution_tail():
    # t = 2.0 with 10 df: two-sided p = 0.07339 (standard table value)
    assert t_two_sided_p([2.0], [10.0])[0] == pytest.approx(0.0733880, abs=1e-6)
    assert betainc_reg([2.0], [3.0], [0.4])[0] == pytest.approx(0.5248, abs=1e-4)
    assert math.isclose(t_two_sided_p([0.0], [5.0])[0], 1.0)


def test_vote(spark):
    mc = spark.createDataFrame([("r", True, "kNN")], "race string, significant boolean, better_model string")
    tt = spark.createDataFrame([("r", True, "Decision Tree")], "race string, significant boolean, better_model string")
    wx = spark.createDataFrame([("r", False)], "race string, significant boolean")
    r = S.test_vote(mc, tt, wx, ["race"]).collect()[0]
    assert (r.significant_tests, r.verdict, r.better_model) == (2, "majority", "Decision Tree")
