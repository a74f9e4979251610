"""P-values for already-aggregated statistics.

Spark has no t / chi-square CDF, so the distribution tail is a vectorised
pandas UDF applied to the small aggregated rows (one per race x test), never
to lap-grain data. Statistics themselves are plain column expressions.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _betacf(a: np.ndarray, b: np.ndarray, x: np.ndarray, iters: int = 300) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < tiny, tiny, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, iters + 1):
        m2 = 2.0 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        h = h * d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        delta = d * c
        h = h * delta
        if np.all(np.abs(delta - 1.0) < 3e-16):
            break
    return h


def betainc_reg(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b), vectorised."""
    a, b, x = (np.asarray(v, dtype="float64") for v in (a, b, x))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0)
    out[ok & (x <= 0)] = 0.0
    out[ok & (x >= 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if mid.any():
        am, bm, xm = a[mid], b[mid], x[mid]
        lg = np.vectorize(math.lgamma)
        lbt = lg(am + bm) - lg(am) - lg(bm) + am * np.log(xm) + bm * np.log1p(-xm)
        bt = np.exp(lbt)
        swap = xm >= (am + 1.0) / (am + bm + 2.0)
        res = np.empty_like(xm)
        ns = ~swap
        if ns.any():
            res[ns] = bt[ns] * _betacf(am[ns], bm[ns], xm[ns]) / am[ns]
        if swap.any():
            res[swap] = 1.0 - bt[swap] * _betacf(bm[swap], am[swap], 1.0 - xm[swap]) / bm[swap]
        out[mid] = res
    return out


def t_two_sided_p(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided p of Student's t: I_{df/(df+t^2)}(df/2, 1/2)."""
    t = np.asarray(t, dtype="float64")
    df = np.asarray(df, dtype="float64")
    with np.errstate(divide="ignore", invalid="ignore"):
        x = df / (df + t * t)
        p = betainc_reg(df / 2.0, np.full_like(df, 0.5), x)
    p = np.where(np.isinf(t) & (df > 0), 0.0, p)
    return p


@F.pandas_udf(T.DoubleType())
def _t_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    tv = t.astype("float64").to_numpy()
    dv = df.astype("float64").to_numpy()
    p = t_two_sided_p(tv, dv)
    p = np.where(np.isnan(tv) | np.isnan(dv) | (dv <= 0), np.nan, p)
    return pd.Series(p).where(~np.isnan(p), None)


def t_test_p(t: Column, df: Column) -> Column:
    """Two-sided p for a t statistic with ``df`` degrees of freedom (NULL-safe)."""
    return F.when(t.isNotNull() & df.isNotNull() & (df > 0), _t_p_udf(t.cast("double"), df.cast("double")))


def pearson_p(r: Column, n: Column) -> Column:
    """T5: two-sided p of a Pearson r over n pairs (t with n-2 df); |r| = 1 -> 0."""
    t = r * F.sqrt(F.try_divide(n - F.lit(2.0), F.lit(1.0) - r * r))
    return (F.when(r.isNull() | (n < 3), F.lit(None).cast("double"))
            .when(F.abs(r) >= 1.0, F.lit(0.0))
            .otherwise(t_test_p(t, n - 2)))


def chi2_df1_p(x: Column) -> Column:
    """Upper tail of chi-square with 1 df: erfc(sqrt(x / 2))."""
    return _erfc_udf(F.sqrt(x.cast("double") / 2.0))


def normal_two_sided_p(z: Column) -> Column:
    """Two-sided normal p: erfc(|z| / sqrt 2)."""
    return _erfc_udf(F.abs(z.cast("double")) / math.sqrt(2.0))


@F.pandas_udf(T.DoubleType())
def _erfc_udf(x: pd.Series) -> pd.Series:
    v = x.astype("float64").to_numpy()
    erfc = np.vectorize(math.erfc, otypes=[float])
    out = np.full(v.shape, np.nan)
    ok = ~np.isnan(v)
    if ok.any():
        out[ok] = erfc(v[ok])
    return pd.Series(out).where(~np.isnan(out), None)
