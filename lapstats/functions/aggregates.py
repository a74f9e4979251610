"""Keyed aggregate building blocks that stay bounded on skewed keys.

Spark's exact ``percentile``/``median`` keeps every distinct value of a group
in one aggregation buffer, so one hot key would land whole in one task. The
exact quantiles below instead:

1. take a Greenwald-Khanna bracket per key with ``percentile_approx`` (a
   mergeable sketch, partial-aggregated map side), widened by twice the
   sketch's rank-error bound so the true order statistics are inside it;
2. count the rows below the bracket (plain partial aggregation);
3. rank only the rows strictly inside the bracket (fewer than 8n/accuracy of
   a key, or the whole key when it has at most ``accuracy`` rows); copies of
   the bracket ends are counted instead, so heavy ties stay cheap. The two
   order statistics of the linear interpolation are read from those runs.

If the sketch bound were ever violated the job fails loudly via
``raise_error`` rather than returning a wrong number.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUANTILE_ACCURACY = 10_000


def _quantiles(df: DataFrame, keys: list[str], items: Sequence[tuple[str, Column, float]], accuracy: int) -> DataFrame:
    """Every key of ``df`` with the exact quantile of each of ``items`` (name, values, share), NULL where a key is NULL
    or has no value. All items are read side by side: no row is copied for them."""
    k = len(items)
    values = [v.cast("double") for _, v, _ in items]
    ps = [p for _, _, p in items]
    x = df.select(*keys, *[v.alias(f"_v{i}") for i, v in enumerate(values)])

    # Bracket half-width in rank fraction: the sketch's rank error (1/accuracy),
    # the shift between p*n and p*(n-1) and the 1-based rank of the sketch each
    # stay below 1/accuracy once n > accuracy; smaller keys use the whole key.
    eps = 4.0 / accuracy
    br = x.groupBy(*keys).agg(*[c for i, p in enumerate(ps) for c in (
        F.count(f"_v{i}").alias(f"_n{i}"),
        F.percentile_approx(f"_v{i}", [max(0.0, p - eps), min(1.0, p + eps)], accuracy).alias(f"_q{i}"))])
    # 0-based order statistics needed per probability.
    cols = []
    for i, p in enumerate(ps):
        pos = F.lit(p) * (F.col(f"_n{i}") - 1)
        small = F.col(f"_n{i}") <= accuracy
        cols += [F.when(small, F.lit(float("-inf"))).otherwise(F.col(f"_q{i}")[0]).alias(f"_lo{i}"),
                 F.when(small, F.lit(float("inf"))).otherwise(F.col(f"_q{i}")[1]).alias(f"_hi{i}"),
                 F.floor(pos).cast("long").alias(f"_r1{i}"), F.ceil(pos).cast("long").alias(f"_r2{i}"),
                 (pos - F.floor(pos)).alias(f"_fr{i}")]
    br = checked_broadcast(br.select(*keys, *[f"_n{i}" for i in range(k)], *cols))

    # One row per key, broadcast after a size check. Sorted values of a key
    # fall into five runs: below lo | == lo | strictly inside | == hi | above.
    # Only the strictly-inside run is ranked. A value with more copies than
    # the bracket is wide can only sit at lo or hi, where it is counted, not
    # ranked, so a hot run of ties never lands in one window partition.
    tagged = x.join(br, keys)
    v = lambda i: F.col(f"_v{i}")
    lo = lambda i: F.col(f"_lo{i}")
    hi = lambda i: F.col(f"_hi{i}")
    between = lambda i: (v(i) > lo(i)) & (v(i) < hi(i))
    cnt = tagged.groupBy(*keys).agg(*[c for i in range(k) for c in (
        F.count_if(v(i) < lo(i)).alias(f"_below{i}"),
        F.count_if(v(i) == lo(i)).alias(f"_eqlo{i}"),
        F.count_if(between(i)).alias(f"_mid{i}"),
        F.count_if((v(i) == hi(i)) & (lo(i) < hi(i))).alias(f"_eqhi{i}"))])
    # Read twice below; counted once.
    stats = checked_broadcast(br.join(cnt, keys, "left"))

    # Most rows are in no bracket and go before any array is made.
    some = functools.reduce(lambda a, b: a | b, [F.coalesce(between(i), F.lit(False)) for i in range(k)])
    member = F.filter(
        F.array(*[F.when(between(i), F.struct(F.lit(i).alias("_pid"), v(i).alias("_v"))) for i in range(k)]),
        lambda e: e.isNotNull())
    inside = (tagged.where(some).select(*keys, F.explode(member).alias("_e")).select(*keys, "_e.*")
              .withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_pid").orderBy("_v")) - 1))
    offsets = stats.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_pid"), (F.col(f"_below{i}") + F.col(f"_eqlo{i}")).alias("_off"),
                 F.col(f"_r1{i}").alias("_r1"), F.col(f"_r2{i}").alias("_r2")) for i in range(k)])).alias("_o")
    ).select(*keys, "_o.*")
    picked = (inside.join(offsets, keys + ["_pid"])
              .withColumn("_rank", F.col("_rn") + F.col("_off"))
              .where((F.col("_rank") == F.col("_r1")) | (F.col("_rank") == F.col("_r2")))
              .groupBy(*keys)
              .agg(*[c for i in range(k) for c in (
                  F.max(F.when((F.col("_pid") == i) & (F.col("_rank") == F.col("_r1")), F.col("_v"))).alias(f"_p1{i}"),
                  F.max(F.when((F.col("_pid") == i) & (F.col("_rank") == F.col("_r2")), F.col("_v"))).alias(f"_p2{i}"))]))
    full = stats.join(picked, keys, "left")

    def value_at(i: int, r: str, p: str) -> Column:
        below, eqlo, mid, eqhi = (F.col(f"_{n}{i}") for n in ("below", "eqlo", "mid", "eqhi"))
        rank = F.col(f"_{r}{i}")
        miss = F.raise_error(F.lit("quantile bracket missed the order statistic")).cast("double")
        return (F.when(rank < below, miss)
                .when(rank < below + eqlo, lo(i))
                .when(rank < below + eqlo + mid, F.coalesce(F.col(f"_{p}{i}"), miss))
                .when(rank < below + eqlo + mid + eqhi, hi(i))
                .otherwise(miss))

    out = []
    for i, (name, _, _) in enumerate(items):
        v1, v2 = value_at(i, "r1", "p1"), value_at(i, "r2", "p2")
        # A NULL key met no counts.
        out.append(F.when((F.col(f"_n{i}") > 0) & F.col(f"_below{i}").isNotNull(), v1 + F.col(f"_fr{i}") * (v2 - v1)).alias(name))
    return full.select(*keys, *out)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str | Column,
                    probs: Mapping[str, float], accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / DuckDB quantile_cont).

    Returns one row per key with at least one non-NULL value: ``keys + list(probs)``.
    """
    v = F.col(value) if isinstance(value, str) else value
    q = _quantiles(df, list(keys), [(n, v, float(p)) for n, p in probs.items()], accuracy)
    return q.where(F.col(next(iter(probs))).isNotNull())


def median_by_key(df: DataFrame, keys: Sequence[str], value: str | Column,
                  name: str = "median", accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """Exact median per key (``keys + [name]``); NULLs skipped."""
    return exact_quantiles(df, keys, value, {name: 0.5}, accuracy)


def medians_by_key(df: DataFrame, keys: Sequence[str], values: Mapping[str, str | Column],
                   accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """Exact medians of several columns per key, in one pass over the data.

    One row per key. Keys with an all-NULL column get NULL for it.
    """
    return _quantiles(df, list(keys), [(n, F.col(v) if isinstance(v, str) else v, 0.5) for n, v in values.items()], accuracy)


BROADCAST_MAX_ROWS = 200_000


def checked_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast a per-key table only after counting it.

    The table is cached and counted (one small job); if it has at most
    ``max_rows`` rows it is hinted for broadcast, otherwise it stays a normal
    shuffle-join side. Lost cache blocks are recomputed from lineage.
    """
    small = small.cache()
    if small.count() <= max_rows:
        return F.broadcast(small)
    return small
