"""Profiling (A19-A28) and correlation pairs.

All results are long-form tables keyed by race; a correlation matrix is
computed as one aggregation holding every pair's moments, then unpivoted,
so each race is scanned once regardless of how many pairs there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapstats.functions.aggregates import checked_broadcast, exact_quantiles
from lapstats.functions.exprs import safe_corr
from lapstats.functions.output import round_half_away as rnd
from lapstats.operators.clean import clean_view
from lapstats.schema import COMPOUNDS_ALL, KEY

LAP_CORR_COLUMNS = ("lap_time", "tyre_life", "air_temp", "track_temp", "humidity", "consistency_score",
                    "tire_degradation_rate", "sector1_time", "sector2_time", "sector3_time")
HIST_BINS = 40


def basic_summary(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Rows, columns, drivers, lap-time moments, mean temps, flagged lap counts."""
    key = list(key)
    n_cols = len(laps.columns)
    return laps.groupBy(*key).agg(
        F.count("*").alias("total_rows"), F.lit(n_cols).cast("bigint").alias("total_cols"),
        F.count_distinct("driver").alias("drivers"),
        F.avg("lap_time").alias("avg_lap_time"), F.min("lap_time").alias("min_lap_time"),
        F.max("lap_time").alias("max_lap_time"), F.stddev_samp("lap_time").alias("std_lap_time"),
        F.avg("air_temp").alias("avg_air_temp"), F.avg("track_temp").alias("avg_track_temp"),
        F.count_if("is_pit_lap").alias("pit_laps"), F.count_if("is_sc_lap").alias("sc_laps"),
        F.count_if("is_outlier").alias("outliers"))


def missing_values(df: DataFrame, key: Sequence[str] = KEY, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column NULL count and percent (2 dp); only columns with NULLs."""
    key = list(key)
    cols = [c for c in (columns or df.columns) if c not in key]
    agg = df.groupBy(*key).agg(F.count("*").alias("_n"),
                               *[F.count_if(F.col(c).isNull()).alias(f"_m_{i}") for i, c in enumerate(cols)])
    long = agg.select(*key, "_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_m_{i}").alias("missing")) for i, c in enumerate(cols)
    ])).alias("_e")).select(*key, "_n", "_e.*")
    return (long.where(F.col("missing") > 0)
            .select(*key, "column_name", "missing",
                    rnd(F.lit(100.0) * F.col("missing") / F.col("_n"), 2).alias("percent")))


def laps_per_driver(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Lap count per driver."""
    return laps.groupBy(*key, "driver").agg(F.count("*").alias("laps"))


def lap_time_distribution(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """A22 on clean (b): mean, median, std, q25, q75, min, max (exact quantiles)."""
    key = list(key)
    c = clean_view(laps, pit=True, sc=False, outlier=True).where(F.col("lap_time").isNotNull())
    mom = c.groupBy(*key).agg(F.avg("lap_time").alias("mean"), F.stddev_samp("lap_time").alias("std"),
                              F.min("lap_time").alias("min"), F.max("lap_time").alias("max"))
    q = exact_quantiles(c, key, "lap_time", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return mom.join(q, key, "left")


def lap_time_histogram(laps: DataFrame, key: Sequence[str] = KEY, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width histogram min..max on clean (b), empty bins too; the last bin is closed."""
    key = list(key)
    c = clean_view(laps, pit=True, sc=False, outlier=True).where(F.col("lap_time").isNotNull())
    rng = c.groupBy(*key).agg(F.min("lap_time").alias("_mn"), F.max("lap_time").alias("_mx"))
    b = F.when(F.col("_mx") > F.col("_mn"), F.least(
        F.floor((F.col("lap_time") - F.col("_mn")) / (F.col("_mx") - F.col("_mn")) * bins),
        F.lit(bins - 1))).otherwise(F.lit(0))
    rng = checked_broadcast(rng)
    counts = c.join(rng, key).groupBy(*key, b.cast("int").alias("bin")).agg(F.count("*").alias("count"))
    last = F.when(F.col("_mx") > F.col("_mn"), F.lit(bins - 1)).otherwise(F.lit(0))
    return (rng.withColumn("bin", F.explode(F.sequence(F.lit(0), last))).join(counts, key + ["bin"], "left")
            .select(*key, "bin",
                    (F.col("_mn") + (F.col("_mx") - F.col("_mn")) * F.col("bin") / bins).alias("bin_start"),
                    F.coalesce("count", F.lit(0).cast("long")).alias("count")))


def temperature_summary(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Mean / min / max / sample std of air and track temperature (long form)."""
    key = list(key)
    long = laps.select(*key, F.explode(F.array(
        F.struct(F.lit("air_temp").alias("variable"), F.col("air_temp").alias("v")),
        F.struct(F.lit("track_temp").alias("variable"), F.col("track_temp").alias("v")))).alias("_e")
    ).select(*key, "_e.*")
    return long.groupBy(*key, "variable").agg(F.avg("v").alias("mean"), F.min("v").alias("min"),
                                              F.max("v").alias("max"), F.stddev_samp("v").alias("std"))


def correlation_matrix(df: DataFrame, columns: Sequence[str], key: Sequence[str] = KEY) -> DataFrame:
    """Pairwise-complete Pearson r for every pair f1 < f2 (column order).

    Long form (key, feature_1, feature_2, r); constant columns give NULL. Each
    row is unpivoted into its column pairs and one grouped aggregation with
    five stable moments per pair follows: a wide aggregate with hundreds of
    moment buffers falls out of code generation and is several times slower.
    """
    key = list(key)
    cols = list(columns)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    long = df.select(*key, F.explode(F.array(*[
        F.struct(F.lit(a).alias("feature_1"), F.lit(b).alias("feature_2"),
                 F.col(a).cast("double").alias("_x"), F.col(b).cast("double").alias("_y"))
        for a, b in pairs])).alias("_e")).select(*key, "_e.*")
    return long.groupBy(*key, "feature_1", "feature_2").agg(safe_corr("_x", "_y").alias("r"))


def lap_time_correlations(corr: DataFrame, target: str = "lap_time", key: Sequence[str] = KEY) -> DataFrame:
    """A25 ranking: |r| of every column against lap time, with its rank (desc)."""
    key = list(key)
    other = F.when(F.col("feature_1") == target, F.col("feature_2")).otherwise(F.col("feature_1"))
    from pyspark.sql import Window
    return (corr.where((F.col("feature_1") == target) | (F.col("feature_2") == target))
            .where(F.col("r").isNotNull())
            .select(*key, other.alias("feature"), F.abs("r").alias("abs_r"))
            .withColumn("rank", F.row_number().over(
                Window.partitionBy(*key).orderBy(F.desc("abs_r"), "feature"))))


def high_correlation_pairs(corr: DataFrame, threshold: float = 0.7, key: Sequence[str] = KEY) -> DataFrame:
    """Upper-triangle pairs with |r| > threshold, |r| rounded to 4 dp."""
    return (corr.where(F.abs("r") > threshold)
            .select(*key, "feature_1", "feature_2", rnd(F.abs("r"), 4).alias("correlation")))


def preprocessing_summary(laps: DataFrame, key: Sequence[str] = KEY,
                          columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, drivers, NULL cells, flagged laps, laps per compound, lap-time mean/min/max."""
    key = list(key)
    cols = [c for c in (columns or laps.columns) if c not in key]
    nulls = sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0).cast("long"))
    return laps.groupBy(*key).agg(
        F.count("*").alias("rows"), F.count_distinct("driver").alias("drivers"),
        F.sum(nulls).alias("missing_cells"),
        *[F.count_if(F.col("compound") == c).alias(f"{c.lower()}_laps") for c in COMPOUNDS_ALL],
        F.count_if("is_pit_lap").alias("pit_laps"), F.count_if("is_sc_lap").alias("sc_laps"),
        F.count_if("is_outlier").alias("outliers"),
        F.avg("lap_time").alias("avg_lap_time"), F.min("lap_time").alias("min_lap_time"),
        F.max("lap_time").alias("max_lap_time"))


def temperature_trend(laps: DataFrame, key: Sequence[str] = KEY, min_points: int = 5) -> DataFrame:
    """OLS line of lap time on air / track temperature, clean (b), more than 5 points."""
    key = list(key)
    c = clean_view(laps, pit=True, sc=False, outlier=True)
    long = c.select(*key, "lap_time", F.explode(F.array(
        F.struct(F.lit("air_temp").alias("variable"), F.col("air_temp").alias("x")),
        F.struct(F.lit("track_temp").alias("variable"), F.col("track_temp").alias("x")))).alias("_e")
    ).select(*key, "lap_time", "_e.*")
    return (long.groupBy(*key, "variable")
            .agg(F.regr_count("lap_time", "x").alias("n"), F.regr_slope("lap_time", "x").alias("slope"),
                 F.regr_intercept("lap_time", "x").alias("intercept"))
            .where(F.col("n") > min_points))
