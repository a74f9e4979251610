"""Lap cleaning (P1-P12) and generic column transforms.

All race-level scalars (median lap time, normal-lap mean/std, weather
medians) are computed once per key as tiny aggregate tables and joined back
as broadcasts after a row-count check (``checked_broadcast``), so the lap
table itself is never shuffled to attach them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapstats.functions.aggregates import checked_broadcast, exact_quantiles, medians_by_key
from lapstats.functions.exprs import (decode_status, duration_text_to_seconds, is_sc_status,
                                      standard_compound)
from lapstats.schema import (COLUMN_ALIASES, KEY, LAPS, OUTLIER_MIN_LAPS, OUTLIER_SIGMA,
                             PIT_LAP_FACTOR)

TIME_COLUMNS = ("lap_time", "sector1_time", "sector2_time", "sector3_time", "pit_in_time", "pit_out_time")
WEATHER_COLUMNS = ("air_temp", "track_temp", "humidity")


def standardize_columns(df: DataFrame) -> DataFrame:
    """Map source column names to canonical ones and add missing columns as typed NULLs.

    Names compare case-, space- and underscore-insensitively; a canonical
    name already present is never overwritten.
    """
    renames = {}
    present = {c.strip() for c in df.columns}
    for c in df.columns:
        norm = c.strip().lower().replace(" ", "").replace("_", "")
        target = COLUMN_ALIASES.get(norm)
        if target and target not in present and target not in renames.values():
            renames[c] = target
    out = df.withColumnsRenamed(renames) if renames else df
    for f in LAPS.fields:
        if f.name not in out.columns:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out


def times_to_seconds(df: DataFrame, columns: Sequence[str] = TIME_COLUMNS) -> DataFrame:
    """Duration text -> seconds; numeric columns pass through unchanged."""
    types = dict(df.dtypes)
    conv = {}
    for c in columns:
        if c in types and types[c] == "string":
            conv[c] = duration_text_to_seconds(c)
    return df.withColumns(conv) if conv else df


def clean_laps(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """P3-P10 in one plan: drop missing laps, tag SC / pit / outlier laps,
    decode status, fill weather with race medians, normalise compound and team.
    """
    key = list(key)
    kept = (laps.where(F.col("lap_time").isNotNull() & (F.col("lap_time") > 0))       # P3
            .withColumn("is_sc_lap", is_sc_status(F.col("track_status")))             # P4
            .withColumn("track_status_label", decode_status(F.col("track_status"))))  # P6

    # Race medians of lap time (P5) and of the weather columns (P8), one quantile job.
    med = medians_by_key(kept, key, {"_med_lap": "lap_time", "_med_air": "air_temp",
                                     "_med_track": "track_temp", "_med_hum": "humidity"})
    tagged = kept.join(checked_broadcast(med), key, "left").withColumn(
        "is_pit_lap",
        (F.col("lap_time") > F.col("_med_lap") * PIT_LAP_FACTOR)
        | F.col("pit_in_time").isNotNull() | F.col("pit_out_time").isNotNull())      # P5

    # Mean +- 3 sample std of normal laps; fewer than 10 normal laps -> none flagged.
    normal = tagged.where(~F.col("is_pit_lap") & ~F.col("is_sc_lap"))
    band = normal.groupBy(*key).agg(F.count("*").alias("_n_norm"), F.avg("lap_time").alias("_mu"),
                                    F.stddev_samp("lap_time").alias("_sd"))
    tagged = tagged.join(checked_broadcast(band), key, "left").withColumn(
        "is_outlier",
        F.coalesce((F.col("_n_norm") >= OUTLIER_MIN_LAPS)
                   & ((F.col("lap_time") < F.col("_mu") - OUTLIER_SIGMA * F.col("_sd"))
                      | (F.col("lap_time") > F.col("_mu") + OUTLIER_SIGMA * F.col("_sd"))),
                   F.lit(False)))

    out = tagged.withColumns({
        "air_temp": F.coalesce("air_temp", "_med_air"),                               # P8
        "track_temp": F.coalesce("track_temp", "_med_track"),
        "humidity": F.coalesce("humidity", "_med_hum"),
        "compound": standard_compound(F.col("compound")),                             # P9
        "team": F.coalesce(F.col("team"), F.lit("Unknown")),                          # P10
    })
    return out.drop("_med_lap", "_med_air", "_med_track", "_med_hum", "_n_norm", "_mu", "_sd")


def clean_view(laps: DataFrame, pit: bool = True, sc: bool = True, outlier: bool = True) -> DataFrame:
    """One of the four clean-lap variants."""
    cond = F.lit(True)
    if pit:
        cond = cond & ~F.col("is_pit_lap")
    if sc:
        cond = cond & ~F.col("is_sc_lap")
    if outlier:
        cond = cond & ~F.col("is_outlier")
    return laps.where(cond)


def iqr_filter(df: DataFrame, column: str, key: Sequence[str] = KEY) -> DataFrame:
    """Keep Q1 - 1.5 IQR <= x <= Q3 + 1.5 IQR per key (exact quartiles)."""
    key = list(key)
    q = exact_quantiles(df, key, column, {"_q1": 0.25, "_q3": 0.75})
    iqr = F.col("_q3") - F.col("_q1")
    return (df.join(checked_broadcast(q), key)
            .where(F.col(column).between(F.col("_q1") - 1.5 * iqr, F.col("_q3") + 1.5 * iqr))
            .drop("_q1", "_q3"))


def minmax_normalize(df: DataFrame, column: str, out: str, key: Sequence[str] = KEY) -> DataFrame:
    """(x - min) / (max - min) per key; constant column -> 0.5."""
    key = list(key)
    mm = df.groupBy(*key).agg(F.min(column).alias("_mn"), F.max(column).alias("_mx"))
    return (df.join(checked_broadcast(mm), key, "left")
            .withColumn(out, F.when(F.col("_mx") > F.col("_mn"),
                                    (F.col(column) - F.col("_mn")) / (F.col("_mx") - F.col("_mn")))
                        .otherwise(F.lit(0.5)))
            .drop("_mn", "_mx"))


def median_impute(df: DataFrame, columns: Sequence[str], key: Sequence[str] = KEY) -> DataFrame:
    """NULL -> median of the column within the key (exact median)."""
    key = list(key)
    med = medians_by_key(df, key, {f"_med_{c}": c for c in columns})
    return (df.join(checked_broadcast(med), key, "left")
            .withColumns({c: F.coalesce(F.col(c), F.col(f"_med_{c}")) for c in columns})
            .drop(*[f"_med_{c}" for c in columns]))


def standardize(df: DataFrame, columns: Sequence[str], key: Sequence[str] = KEY,
                suffix: str = "_z") -> DataFrame:
    """z = (x - mean) / population std per key; constant column -> 0."""
    key = list(key)
    st = df.groupBy(*key).agg(*[F.avg(c).alias(f"_mu_{c}") for c in columns],
                              *[F.stddev_pop(c).alias(f"_sd_{c}") for c in columns])
    return (df.join(checked_broadcast(st), key, "left")
            .withColumns({f"{c}{suffix}": F.coalesce(
                F.when(F.col(f"_sd_{c}") > 0, (F.col(c) - F.col(f"_mu_{c}")) / F.col(f"_sd_{c}")),
                F.lit(0.0)) for c in columns})
            .drop(*[f"_mu_{c}" for c in columns], *[f"_sd_{c}" for c in columns]))


def simulated_flag(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Any simulated lap in the race."""
    return laps.groupBy(*key).agg(F.coalesce(F.bool_or("is_simulated"), F.lit(False)).alias("is_simulated"))
