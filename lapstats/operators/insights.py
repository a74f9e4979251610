"""Insight rules (I1-I12): analysis tables -> one long table of findings.

Each rule is a small per-race projection of an analysis result; findings are
unioned into (key, category, seq, code, subject, value, level). Codes are
language-neutral identifiers; presentation text is out of scope.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapstats.functions.exprs import format_laptime
from lapstats.schema import KEY

# ---- fixed values: track attributes (DRS zones, pit window); unknown tracks -> N/A ----
TRACKS = [
    ("Bahrain", 3, "12-18"), ("Monaco", 1, "18-28"), ("Italy", 2, "16-22"), ("Belgium", 2, "10-18"),
    ("Great Britain", 2, "14-22"), ("Japan", 1, "14-20"), ("Singapore", 3, "20-30"), ("Azerbaijan", 2, "12-22"),
]
DEGRADATION_WARNING = 0.1      # s/lap
COMPOUND_GAP = 0.3             # s
PIT_CLEAR_BENEFIT = 0.5        # s
WEATHER_R = 0.3
TRACK_TEMP_BANDS = (30.0, 40.0, 45.0)
HIGH_CONFIDENCE = 0.7

def _decimal(c: str | Column, digits: int) -> Column:
    """A rounded number that prints without an exponent."""
    return F.round(c, digits).cast(f"decimal(18,{digits})")


FINDING_COLS = ["category", "seq", "code", "subject", "value", "level"]
CATEGORY_ORDER = ["performance", "tire", "pit", "ml", "track"]


def _finding(df: DataFrame, key: list[str], category: str, seq: int, code: Column | str, subject: Column,
             value: Column, level: Column | str) -> DataFrame:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return df.select(*key, F.lit(category).alias("category"), F.lit(seq).alias("seq"), lit(code).alias("code"),
                     subject.cast("string").alias("subject"), value.cast("string").alias("value"),
                     lit(level).alias("level"))


def track_dimension(spark: SparkSession) -> DataFrame:
    """The track attribute table."""
    return spark.createDataFrame(TRACKS, "race_name string, drs_zones int, pit_window string")


def performance_insights(stability: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Most stable, fastest, and a speed-vs-stability note when they differ."""
    key = list(key)
    s = stability.groupBy(*key).agg(
        F.min_by(F.struct("driver", "consistency_score"), "stability_rank").alias("_ms"),
        F.min_by(F.struct("driver", "best_lap_time"), F.struct("best_lap_time", "stability_rank")).alias("_f"))
    return (_finding(s, key, "performance", 1, "most_stable_driver", F.col("_ms.driver"),
                     _decimal("_ms.consistency_score", 3), "positive")
            .unionByName(_finding(s, key, "performance", 2, "fastest_driver", F.col("_f.driver"),
                                  format_laptime(F.col("_f.best_lap_time")), "positive"))
            .unionByName(_finding(s.where(F.col("_f.driver") != F.col("_ms.driver")), key, "performance", 3,
                                  "speed_vs_stability", F.concat_ws("/", "_f.driver", "_ms.driver"),
                                  F.lit("opposite_profiles"), "neutral")))


def tire_insights(compounds: DataFrame, degradation: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Best compound, worst-degrading compound, compound gap above 0.3 s."""
    key = list(key)
    c = compounds.groupBy(*key).agg(
        F.min_by(F.struct("compound", "avg_lap_time"), F.struct("avg_lap_time", "compound")).alias("_b"),
        (F.max("avg_lap_time") - F.min("avg_lap_time")).alias("_gap"), F.count("*").alias("_n"))
    worst = degradation.where(F.col("is_worst"))
    return (_finding(c, key, "tire", 1, "best_compound", F.col("_b.compound"), _decimal("_b.avg_lap_time", 3),
                     "positive")
            .unionByName(_finding(worst, key, "tire", 2, "worst_degradation", F.col("compound"),
                                  _decimal("degradation_rate", 4),
                                  F.when(F.col("degradation_rate") > DEGRADATION_WARNING, "warning")
                                  .otherwise("neutral")))
            .unionByName(_finding(c.where((F.col("_n") >= 2) & (F.col("_gap") > COMPOUND_GAP)), key, "tire", 3,
                                  "compound_gap", F.lit(None), _decimal("_gap", 3), "info")))


def pit_insights(pit: DataFrame, races: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Race pit benefit (clear above 0.5 s), best pit driver; no pit data -> neutral row."""
    key = list(key)
    r = pit.groupBy(*key).agg(F.first("race_avg_impact", ignorenulls=True).alias("_avg"),
                              F.max_by(F.struct("driver", "avg_impact"), F.struct("avg_impact", F.negative(
                                  F.length("driver")), "driver")).alias("_best"))
    r = races.select(*key).distinct().join(r, key, "left")
    impact = _finding(r.where(F.col("_avg").isNotNull()), key, "pit", 1,
                      F.when(F.col("_avg") > PIT_CLEAR_BENEFIT, "pit_clear_benefit").otherwise("pit_impact"),
                      F.lit("all_drivers"), _decimal("_avg", 3),
                      F.when(F.col("_avg") > 0, "positive").otherwise("warning"))
    nodata = _finding(r.where(F.col("_avg").isNull()), key, "pit", 1, "pit_no_data", F.lit("N/A"), F.lit(None),
                      "neutral")
    best = _finding(r.where(F.col("_best.avg_impact") > 0), key, "pit", 2, "best_pit_driver",
                    F.col("_best.driver"), _decimal("_best.avg_impact", 3), "positive")
    return impact.unionByName(nodata).unionByName(best)


def weather_insights(weather: DataFrame, overview: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """I4: temperature correlations (|r| > 0.3 and significant -> info; not significant
    -> neutral) and the track-temperature band (warning above 45 C)."""
    key = list(key)
    corr = _finding(
        weather.where(((F.abs("pearson_r") > WEATHER_R) & F.col("significant")) | ~F.col("significant")),
        key, "weather", 1, F.when(F.col("significant"), F.concat(F.lit("temp_effect_"), F.col("direction")))
        .otherwise("temp_effect_not_significant"), F.col("variable"), _decimal("pearson_r", 3),
        F.when(F.col("significant"), "info").otherwise("neutral"))
    lo, mid, hi = TRACK_TEMP_BANDS
    t = F.col("avg_track_temp")
    band = _finding(overview, key, "weather", 2,
                    F.when(t > mid, "track_temp_high").when(t > lo, "track_temp_medium").otherwise("track_temp_low"),
                    F.lit("track_temp"), _decimal(t, 1), F.when(t > hi, "warning").otherwise("neutral"))
    return corr.unionByName(band)


def ml_insights(importance: DataFrame | None, comparison: DataFrame | None, clusters: DataFrame | None,
                key: Sequence[str] = KEY) -> DataFrame | None:
    """Top tree feature, winning model, size of the fastest stable cluster."""
    key = list(key)
    parts = []
    if importance is not None:
        top = importance.groupBy(*key).agg(F.max_by(F.struct("feature", "importance"),
                                                    F.struct("importance", "feature")).alias("_t"))
        parts.append(_finding(top, key, "ml", 1, "top_feature", F.col("_t.feature"), F.col("_t.importance"),
                              "positive"))
    if comparison is not None:
        parts.append(_finding(comparison.where("is_best"), key, "ml", 2, "best_model", F.col("model"),
                              _decimal("cv_mean_acc", 4), "positive"))
    if clusters is not None:
        elite = clusters.where(F.col("label") == "stable_fast").groupBy(*key).agg(F.count("*").alias("_m"))
        parts.append(_finding(elite, key, "ml", 3, "elite_cluster", F.lit("stable_fast"), F.col("_m"), "positive"))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def driver_insights(stability: DataFrame, sectors: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Least consistent driver (3+ drivers) and the sector specialists."""
    key = list(key)
    worst = stability.groupBy(*key).agg(F.count("*").alias("_n"),
                                        F.max_by(F.struct("driver", "lap_time_std"), "stability_rank").alias("_w"))
    return (_finding(worst.where(F.col("_n") >= 3), key, "driver", 1, "least_consistent_driver", F.col("_w.driver"),
                     _decimal("_w.lap_time_std", 3), "warning")
            .unionByName(_finding(sectors, key, "driver", 2, F.concat(F.lit("fastest_"), F.col("sector")),
                                  F.col("driver"), _decimal("mean_time", 3), "positive")))


def track_insights(spark: SparkSession, races: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """DRS zones and pit window of the track (N/A when unknown)."""
    key = list(key)
    t = races.select(*key).distinct().join(F.broadcast(track_dimension(spark)), "race_name", "left")
    return _finding(t, key, "track", 1, "track_profile", F.col("race_name"),
                    F.concat_ws(" ", F.concat(F.lit("drs="), F.coalesce(F.col("drs_zones").cast("string"),
                                                                        F.lit("N/A"))),
                                F.concat(F.lit("pit_window="), F.coalesce("pit_window", F.lit("N/A")))), "neutral")


def top5(findings: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """I8: first finding of performance, tire, pit, ML, then track."""
    key = list(key)
    order = F.array_position(F.array(*[F.lit(c) for c in CATEGORY_ORDER]), F.col("category"))
    first = (findings.where(order > 0)
             .withColumn("_rn", F.row_number().over(Window.partitionBy(*key, "category").orderBy("seq")))
             .where(F.col("_rn") == 1).withColumn("rank", order.cast("int")).drop("_rn"))
    return first


def comment_code(metric: str, value: Column) -> Column:
    """Threshold comments as codes (degradation > 0.2; std < 1 / < 2)."""
    if "degradation" in metric:
        return F.when(value > 0.2, F.lit("degradation_high")).otherwise(F.lit("degradation_low"))
    if "consistency" in metric or "std" in metric:
        return (F.when(value < 1.0, F.lit("stable")).when(value < 2.0, F.lit("moderate"))
                .otherwise(F.lit("volatile")))
    return F.lit(metric)


def pit_rating(pit: DataFrame) -> DataFrame:
    """Advantage (> 0.5 s), normal (> 0), limited."""
    return pit.withColumn("pit_rating", F.when(F.col("avg_impact") > PIT_CLEAR_BENEFIT, F.lit("advantage"))
                          .when(F.col("avg_impact") > 0, F.lit("normal")).otherwise(F.lit("limited")))


def conclusions(findings: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """One row per race with the headline findings side by side."""
    key = list(key)
    pick = lambda code: F.max(F.when(F.col("code") == code, F.col("subject")))
    return findings.groupBy(*key).agg(
        pick("fastest_driver").alias("fastest_driver"), pick("most_stable_driver").alias("most_stable_driver"),
        pick("best_compound").alias("best_compound"), pick("top_feature").alias("top_feature"),
        pick("best_model").alias("best_model"),
        F.max(F.when(F.col("code") == "elite_cluster", F.col("value"))).alias("elite_cluster_size"))


def race_findings(spark: SparkSession, tables: Mapping[str, DataFrame], key: Sequence[str] = KEY) -> DataFrame:
    """All rule families over the analysis tables available in ``tables``."""
    key = list(key)
    parts = [
        performance_insights(tables["stability"], key),
        tire_insights(tables["compound_stats"], tables["degradation_curve"], key),
        pit_insights(tables["pit"], tables["overview"], key),
        weather_insights(tables["weather"], tables["overview"], key),
        driver_insights(tables["stability"], tables["sectors"], key),
        track_insights(spark, tables["overview"], key),
    ]
    ml = ml_insights(tables.get("importance"), tables.get("comparison"), tables.get("clusters"), key)
    if ml is not None:
        parts.append(ml)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
