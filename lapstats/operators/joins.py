"""Weather attachment (J7 mean, J8 nearest sample) and set helpers.

The as-of join never builds a window over a whole race of laps. Weather
samples (small per race) are turned into intervals [t_i, t_{i+1}); each
interval is listed under the time buckets it overlaps, and laps equi-join on
(key, bucket) with the range condition. Every lap therefore meets only the
one or two intervals of its bucket, however many laps a race has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapstats.functions.aggregates import checked_broadcast
from lapstats.schema import KEY

WEATHER_VALUES = ("air_temp", "track_temp", "humidity")


def attach_weather_mean(laps: DataFrame, weather: DataFrame, key: Sequence[str] = KEY,
                        values: Sequence[str] = WEATHER_VALUES) -> DataFrame:
    """J7 (as the reference implements it): race-wide mean of each weather value
    joined to every lap that lacks the column; races without weather get NULL."""
    key = list(key)
    missing = [v for v in values if v not in laps.columns]
    if not missing:
        return laps
    means = weather.groupBy(*key).agg(*[F.avg(v).alias(v) for v in missing])
    return laps.join(checked_broadcast(means), key, "left")


def attach_weather_asof(laps: DataFrame, weather: DataFrame, key: Sequence[str] = KEY, time_col: str = "time_s",
                        values: Sequence[str] = WEATHER_VALUES, bucket_seconds: float = 3600.0) -> DataFrame:
    """J8 (as documented): values of the weather sample nearest in time to each lap.

    Ties go to the earlier sample; laps before the first sample take the
    first one. Output: laps + ``weather_time`` + the weather values.
    """
    key = list(key)
    vals = list(values)
    lap_cols = [c for c in laps.columns if c not in vals]
    ws = weather.select(*key, F.col(time_col).alias("_t"), *vals)
    w = Window.partitionBy(*key).orderBy("_t")
    iv = ws.select(*key, "_t", F.lead("_t").over(w).alias("_tn"),
                   *[F.col(v).alias(f"_p_{v}") for v in vals],
                   *[F.lead(v).over(w).alias(f"_n_{v}") for v in vals])
    lap_span = laps.groupBy(*key).agg(F.max(time_col).alias("_lmax"))
    iv = iv.join(lap_span, key, "left")
    b0 = F.floor(F.col("_t") / bucket_seconds)
    b1 = F.floor(F.coalesce(F.col("_tn"), F.greatest(F.col("_lmax"), F.col("_t"))) / bucket_seconds)
    iv = iv.withColumn("_b", F.explode(F.sequence(b0.cast("long"), F.greatest(b0, b1).cast("long"))))
    lp = laps.select(*lap_cols).withColumn("_lt", F.col(time_col)).withColumn(
        "_b", F.floor(F.col("_lt") / bucket_seconds).cast("long"))
    cond = ([lp[k] == iv[k] for k in key] + [lp["_b"] == iv["_b"], iv["_t"] <= lp["_lt"],
                                             iv["_tn"].isNull() | (lp["_lt"] < iv["_tn"])])
    j = lp.join(iv.drop(*[]), cond, "left")
    first = ws.groupBy(*key).agg(F.min_by(F.struct("_t", *vals), "_t").alias("_f"))
    j = j.select(*[lp[c] for c in lap_cols], "_lt", iv["_t"], iv["_tn"],
                 *[F.col(f"_p_{v}") for v in vals], *[F.col(f"_n_{v}") for v in vals])
    j = j.join(first, key, "left")
    use_next = F.col("_tn").isNotNull() & ((F.col("_tn") - F.col("_lt")) < (F.col("_lt") - F.col("_t")))
    before_first = F.col("_t").isNull()
    out = j.select(
        *lap_cols,
        F.when(before_first, F.col("_f._t")).when(use_next, F.col("_tn")).otherwise(F.col("_t")).alias("weather_time"),
        *[F.when(before_first, F.col(f"_f.{v}")).when(use_next, F.col(f"_n_{v}")).otherwise(F.col(f"_p_{v}")).alias(v)
          for v in vals])
    return out


def pending_keys(requested: DataFrame, ledger: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Requested races that are not yet complete in the ledger.

    With a column ``source_file``, a race is also pending when it has a file that its ledger entry doesn't name.
    """
    key = list(key)
    done = ledger.where(F.col("status") == "complete")
    if "source_file" not in requested.columns or "files" not in ledger.columns:
        return requested.select(*key).distinct().join(done.select(*key), key, "left_anti")
    known = done.select(*key, F.explode(F.coalesce("files", F.array().cast("array<string>"))).alias("source_file"))
    return requested.select(*key, "source_file").distinct().join(known, key + ["source_file"], "left_anti").select(*key).distinct()
