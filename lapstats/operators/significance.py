"""Model-comparison tests (T1-T4) as keyed DataFrame operators.

Inputs are long tables the evaluation step produces: out-of-fold predictions
(one row per entity) for McNemar and fold scores (one row per fold) for the
paired tests. Statistics are column aggregates; only the distribution tails
go through the small p-value UDFs in ``lapstats.functions.pvalues``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapstats.functions.pvalues import chi2_df1_p, normal_two_sided_p, t_test_p

ALPHA = 0.05
WILCOXON_EXACT_MAX_N = 50


def mcnemar(pred: DataFrame, key: Sequence[str], label: str = "label",
            pred_a: str = "pred_a", pred_b: str = "pred_b",
            name_a: str = "Decision Tree", name_b: str = "kNN") -> DataFrame:
    """Continuity-corrected McNemar on paired correctness; b+c = 0 -> stat 0, p 1."""
    key = list(key)
    ok_a = F.col(pred_a) == F.col(label)
    ok_b = F.col(pred_b) == F.col(label)
    g = pred.groupBy(*key).agg(F.count_if(ok_a & ~ok_b).alias("b"), F.count_if(~ok_a & ok_b).alias("c"))
    n = F.col("b") + F.col("c")
    stat = F.when(n == 0, F.lit(0.0)).otherwise(
        F.pow(F.abs(F.col("b") - F.col("c")) - 1.0, 2) / n)
    df = g.select(*key, "b", "c", n.alias("n_discordant"), stat.alias("chi2_stat"))
    df = df.withColumn("p_value", F.when(F.col("n_discordant") == 0, F.lit(1.0))
                       .otherwise(chi2_df1_p(F.col("chi2_stat"))))
    return df.select(*key, "b", "c", "n_discordant", "chi2_stat", "p_value",
                     (F.col("p_value") < ALPHA).alias("significant"),
                     F.when(F.col("b") > F.col("c"), F.lit(name_a)).when(F.col("c") > F.col("b"), F.lit(name_b))
                     .otherwise(F.lit("equal")).alias("better_model"))


def paired_t(scores: DataFrame, key: Sequence[str], a: str = "score_a", b: str = "score_b",
             name_a: str = "Decision Tree", name_b: str = "kNN") -> DataFrame:
    """Paired two-sided t-test on fold scores; fewer than 2 folds -> t 0, p 1.

    Identical differences (sd 0) give t = NULL like scipy's NaN; stds are population.
    """
    key = list(key)
    d = F.col(a) - F.col(b)
    g = scores.groupBy(*key).agg(
        F.count("*").alias("n"), F.avg(d).alias("mean_diff"), F.stddev_samp(d).alias("_sd"),
        F.avg(a).alias("a_mean"), F.avg(b).alias("b_mean"),
        F.stddev_pop(a).alias("a_std"), F.stddev_pop(b).alias("b_std"))
    t = F.try_divide(F.col("mean_diff"), F.col("_sd") / F.sqrt(F.col("n")))
    g = g.withColumn("t_stat", F.when(F.col("n") < 2, F.lit(0.0)).otherwise(
        F.when(F.col("_sd") > 0, t)))
    g = g.withColumn("p_value", F.when(F.col("n") < 2, F.lit(1.0))
                     .otherwise(t_test_p(F.col("t_stat"), F.col("n") - 1)))
    return g.select(*key, "n", "t_stat", "p_value", "mean_diff", "a_mean", "b_mean", "a_std", "b_std",
                    F.coalesce(F.col("p_value") < ALPHA, F.lit(False)).alias("significant"),
                    F.when(F.col("mean_diff") > 0, F.lit(name_a)).when(F.col("mean_diff") < 0, F.lit(name_b))
                    .otherwise(F.lit("equal")).alias("better_model"))


@F.pandas_udf(T.DoubleType())
def _wilcoxon_exact_p(n: pd.Series, stat: pd.Series) -> pd.Series:
    """Two-sided exact p of the signed-rank statistic min(W+, W-) for n untied non-zero diffs."""
    out = []
    for nn, s in zip(n.astype("int64"), stat.astype("float64")):
        if nn <= 0:
            out.append(1.0)
            continue
        total = nn * (nn + 1) // 2
        counts = np.zeros(total + 1)
        counts[0] = 1.0
        for r in range(1, nn + 1):
            counts[r:] = counts[r:] + counts[:-r].copy() if r <= total else counts[r:]
        cdf = counts.cumsum() / 2.0 ** nn
        k = int(np.floor(s + 1e-9))
        out.append(float(min(1.0, 2.0 * cdf[min(max(k, 0), total)])))
    return pd.Series(out)


def wilcoxon(scores: DataFrame, key: Sequence[str], a: str = "score_a", b: str = "score_b") -> DataFrame:
    """Wilcoxon signed-rank (zeros dropped, average ranks for ties).

    Statistic min(W+, W-); fewer than 3 folds or all differences zero -> stat 0,
    p 1. Exact two-sided p for up to 50 untied differences, else the normal
    approximation with the tie-corrected variance.
    """
    key = list(key)
    d = scores.select(*key, (F.col(a) - F.col(b)).alias("_d"))
    all_n = d.groupBy(*key).agg(F.count("*").alias("n_folds"))
    nz = d.where(F.col("_d") != 0).withColumn("_ad", F.abs("_d"))
    w_rank = Window.partitionBy(*key).orderBy("_ad")
    ranked = (nz.withColumn("_rk", F.rank().over(w_rank))
              .withColumn("_tc", F.count("*").over(Window.partitionBy(*key, "_ad")))
              .withColumn("_avg_rank", F.col("_rk") + (F.col("_tc") - 1) / 2.0))
    ties = ranked.groupBy(*key, "_ad").agg(F.count("*").alias("_t"))
    tie_term = ties.groupBy(*key).agg(F.sum(F.pow("_t", 3) - F.col("_t")).alias("_tie"),
                                      F.max("_t").alias("_max_tie"))
    g = ranked.groupBy(*key).agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("_d") > 0, F.col("_avg_rank")).otherwise(0.0)).alias("w_plus"),
        F.sum(F.when(F.col("_d") < 0, F.col("_avg_rank")).otherwise(0.0)).alias("w_minus"))
    g = all_n.join(g, key, "left").join(tie_term, key, "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    stat = F.least(F.col("w_plus"), F.col("w_minus"))
    mean = n * (n + 1) / 4.0
    var = n * (n + 1) * (2 * n + 1) / 24.0 - F.coalesce(F.col("_tie"), F.lit(0.0)) / 48.0
    z = F.try_divide(stat - mean, F.sqrt(var))
    trivial = (F.col("n_folds") < 3) | (n == 0)
    exact = (n <= WILCOXON_EXACT_MAX_N) & (F.coalesce(F.col("_max_tie"), F.lit(1)) <= 1)
    p = (F.when(trivial, F.lit(1.0))
         .when(exact, _wilcoxon_exact_p(n, stat))
         .otherwise(normal_two_sided_p(z)))
    out = g.select(*key, "n_folds", n.alias("n_nonzero"),
                   F.when(trivial, F.lit(0.0)).otherwise(stat).alias("stat"), p.alias("p_value"))
    return out.withColumn("significant", F.col("p_value") < ALPHA)


def test_vote(mc: DataFrame, tt: DataFrame, wx: DataFrame, key: Sequence[str]) -> DataFrame:
    """T4: how many of the three tests are significant -> none / mixed / majority."""
    key = list(key)
    j = (mc.select(*key, F.col("significant").alias("_m"), F.col("better_model").alias("_mb"))
         .join(tt.select(*key, F.col("significant").alias("_t"), F.col("better_model").alias("_tb")), key, "full")
         .join(wx.select(*key, F.col("significant").alias("_w")), key, "full"))
    cnt = sum((F.coalesce(F.col(c), F.lit(False)).cast("int") for c in ("_m", "_t", "_w")), F.lit(0))
    return j.select(*key, cnt.alias("significant_tests"),
                    F.when(cnt == 0, F.lit("none")).when(cnt >= 2, F.lit("majority")).otherwise(F.lit("mixed"))
                    .alias("verdict"),
                    F.when(cnt >= 2, F.coalesce(F.col("_tb"), F.col("_mb"))).alias("better_model"))
