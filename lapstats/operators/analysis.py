"""Per-race analyses.

Every function returns one flat DataFrame for all races at once; no result is
gathered on the driver. Ties are broken explicitly (driver name, lap number)
because Spark has no row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapstats.functions.exprs import safe_corr, std0
from lapstats.functions.output import round_half_away as rnd
from lapstats.functions.pvalues import pearson_p
from lapstats.functions.ranking import row_numbers
from lapstats.operators.clean import clean_view
from lapstats.operators.features import pit_windows
from lapstats.schema import KEY


def driver_stability(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """A9 + W2: per-driver clean (a) stats, team, rank by consistency (desc, then driver).

    One pass over the laps: the clean-lap statistics are conditional
    aggregates next to the team lookup (first team in lap order, all laps),
    so no second scan or join is needed.
    """
    key = list(key)
    ok = ~F.col("is_pit_lap") & ~F.col("is_sc_lap") & ~F.col("is_outlier")
    x = F.when(ok, F.col("lap_time"))
    stats = (laps.groupBy(*key, "driver")
             .agg(F.avg(x).alias("avg_lap_time"), F.min(x).alias("best_lap_time"),
                  std0(x).alias("lap_time_std"), F.count(x).alias("lap_count"),
                  F.min_by("team", F.when(F.col("team").isNotNull(), F.struct("lap_number", "lap_time")))
                  .alias("team"))
             .where(F.col("lap_count") > 0)
             .withColumn("consistency_score", 1.0 / (1.0 + F.col("lap_time_std"))))
    return row_numbers(stats, key, [F.desc("consistency_score"), F.col("driver")], "stability_rank").withColumn(
        "stability_rank", F.col("stability_rank").cast("int"))


def stability_summary(stability: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Most stable (rank 1) and fastest (lowest best lap, first in rank order) driver per race."""
    key = list(key)
    return stability.groupBy(*key).agg(
        F.min_by("driver", "stability_rank").alias("most_stable_driver"),
        F.min_by("driver", F.struct("best_lap_time", "stability_rank")).alias("fastest_driver"),
        F.min("best_lap_time").alias("fastest_lap"))


def compound_stats(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """A10: per compound on clean (a): mean, min, sample std, count; is_best = lowest mean."""
    key = list(key)
    s = (clean_view(laps).groupBy(*key, "compound")
         .agg(F.avg("lap_time").alias("avg_lap_time"), F.min("lap_time").alias("best_lap_time"),
              F.stddev_samp("lap_time").alias("std"), F.count("*").alias("count")))
    best = s.groupBy(*key).agg(F.min_by("compound", F.struct("avg_lap_time", "compound")).alias("_best"))
    return (s.join(best, key).withColumn("is_best", F.col("compound") == F.col("_best")).drop("_best"))


def tyre_age_curve(laps: DataFrame, key: Sequence[str] = KEY, min_laps: int = 5) -> DataFrame:
    """Mean lap time per (compound, tyre life), compounds with more than 5 clean laps."""
    key = list(key)
    c = clean_view(laps)
    per_age = (c.where(F.col("tyre_life").isNotNull())
               .groupBy(*key, "compound", "tyre_life")
               .agg(F.avg("lap_time").alias("avg_lap_time"), F.count("*").alias("_n")))
    big = c.groupBy(*key, "compound").agg(F.count("*").alias("_total")).where(F.col("_total") > min_laps)
    return per_age.join(big.select(*key, "compound"), key + ["compound"], "left_semi").drop("_n")


def strategy_map(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Per (driver, stint), all laps: first compound in lap order, lap count, mean time."""
    key = list(key)
    return (laps.where(F.col("stint").isNotNull())
            .groupBy(*key, "driver", "stint")
            .agg(F.min_by("compound", F.struct("lap_number", "lap_time")).alias("compound"),
                 F.count("lap_number").alias("laps"), F.avg("lap_time").alias("avg_time")))


def degradation_curve(laps: DataFrame, key: Sequence[str] = KEY, min_laps: int = 5) -> DataFrame:
    """Per compound with >= 5 clean laps, OLS of the per-age means on age (>= 3 ages).

    Returns one row per (race, compound): degradation_rate, intercept, r_squared,
    n_ages, is_worst (largest slope in the race).
    """
    key = list(key)
    c = clean_view(laps)
    counts = c.groupBy(*key, "compound").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_laps)
    per_age = (c.where(F.col("tyre_life").isNotNull())
               .join(counts.select(*key, "compound"), key + ["compound"], "left_semi")
               .groupBy(*key, "compound", "tyre_life").agg(F.avg("lap_time").alias("_m")))
    fit = per_age.groupBy(*key, "compound").agg(
        F.count("*").alias("n_ages"),
        F.regr_slope("_m", "tyre_life").alias("_slope"), F.regr_intercept("_m", "tyre_life").alias("_icpt"),
        F.regr_r2("_m", "tyre_life").alias("_r2"))
    fit = fit.select(*key, "compound", "n_ages",
                     F.when(F.col("n_ages") >= 3, F.col("_slope")).alias("degradation_rate"),
                     F.when(F.col("n_ages") >= 3, F.col("_icpt")).alias("intercept"),
                     F.when(F.col("n_ages") >= 3, F.col("_r2")).alias("r_squared"))
    fit = counts.select(*key, "compound").join(fit, key + ["compound"], "left")
    worst = fit.groupBy(*key).agg(F.max_by("compound", F.when(
        F.col("degradation_rate").isNotNull(), F.struct("degradation_rate", "compound"))).alias("_worst"))
    return (fit.join(worst, key, "left")
            .withColumn("is_worst", F.coalesce(F.col("compound") == F.col("_worst"), F.lit(False)))
            .drop("_worst"))


def degradation_ages(laps: DataFrame, key: Sequence[str] = KEY, min_laps: int = 5) -> DataFrame:
    """A13 points: mean, sample std and count per (compound, tyre life), compounds with >= 5 clean laps."""
    key = list(key)
    c = clean_view(laps)
    enough = c.groupBy(*key, "compound").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_laps)
    ages = (c.where(F.col("tyre_life").isNotNull()).groupBy(*key, "compound", "tyre_life")
            .agg(F.avg("lap_time").alias("mean"), F.stddev_samp("lap_time").alias("std"), F.count("*").alias("count")))
    return ages.join(enough, key + ["compound"], "left_semi")


def pit_stop_details(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """A15 (per pit lap): before / after means and impact, rounded to 3 dp like the reference."""
    key = list(key)
    w = pit_windows(laps, key)
    return (w.where(F.col("before_avg").isNotNull() & F.col("after_avg").isNotNull())
            .select(*key, "driver", F.col("lap_number").alias("pit_lap"),
                    rnd("before_avg", 3).alias("before_avg"),
                    rnd("after_avg", 3).alias("after_avg"),
                    rnd(F.col("before_avg") - F.col("after_avg"), 3).alias("impact")))


def _mean_of_milli(c) -> F.Column:
    """Mean of values already rounded to 3 dp, rounded to 3 dp again.

    The values are whole milli-units, so their mean often lands exactly on a
    half; summing them as integers makes that half exact in every engine and
    summation order, and the half is then rounded away from zero.
    """
    milli = F.round(c * 1000.0, 0).cast("long")
    return F.round(F.sum(milli) / F.count(milli), 0) / 1000.0


def pit_stop_analysis(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """A15 (per driver) + A33: pit count and mean of the rounded impacts; the race
    average is over drivers with a non-zero average; pit_total sums the counts."""
    key = list(key)
    d = (pit_stop_details(laps, key).groupBy(*key, "driver")
         .agg(F.count("*").alias("pit_count"), _mean_of_milli(F.col("impact")).alias("avg_impact")))
    race = d.groupBy(*key).agg(
        _mean_of_milli(F.when(F.col("avg_impact") != 0, F.col("avg_impact"))).alias("race_avg_impact"),
        F.sum("pit_count").alias("race_pit_total"))
    return d.join(race, key, "left")


def pit_driver_means(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Per driver mean of before / after / impact over pit laps."""
    key = list(key)
    return (pit_stop_details(laps, key).groupBy(*key, "driver")
            .agg(F.avg("before_avg").alias("before_mean"), F.avg("after_avg").alias("after_mean"),
                 F.avg("impact").alias("impact_mean")))


def weather_correlation(laps: DataFrame, key: Sequence[str] = KEY, min_pairs: int = 5) -> DataFrame:
    """Pearson r and two-sided p of air / track temperature vs lap time, clean (a).

    Long form: one row per (race, variable). Constant weather gives r = NULL
    and no label (the reference's NaN fell through to its strongest label).
    """
    key = list(key)
    c = clean_view(laps)
    rows = []
    for var in ("air_temp", "track_temp"):
        both = F.col(var).isNotNull() & F.col("lap_time").isNotNull()
        rows.append(c.groupBy(*key).agg(
            F.lit(var).alias("variable"),
            F.count_if(both).alias("n_pairs"),
            safe_corr(var, "lap_time").alias("_r")))
    df = rows[0].unionByName(rows[1]).where(F.col("n_pairs") >= min_pairs)
    df = df.withColumn("pearson_r", F.col("_r")).withColumn(
        "p_value", pearson_p(F.col("_r"), F.col("n_pairs")))
    a = F.abs(F.col("pearson_r"))
    label = (F.when(a < 0.1, "negligible").when(a < 0.3, "weak").when(a < 0.5, "moderate")
             .when(a < 0.7, "strong").when(a.isNotNull(), "very_strong"))
    return df.select(*key, "variable", "n_pairs", "pearson_r", "p_value",
                     (F.col("p_value") < 0.05).alias("significant"),
                     label.alias("strength"),
                     F.when(F.col("pearson_r") > 0, "increasing").when(F.col("pearson_r").isNotNull(), "decreasing")
                     .alias("direction"))


def race_overview(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Laps, drivers, fastest clean lap and driver, most stable driver, mean temps."""
    key = list(key)
    c = clean_view(laps)
    fastest = c.groupBy(*key).agg(
        F.min("lap_time").alias("fastest_lap"),
        F.min_by("driver", F.struct("lap_time", "lap_number", "driver")).alias("fastest_driver"))
    stable = (driver_stability(laps, key).groupBy(*key)
              .agg(F.min_by("driver", F.struct(F.negative("consistency_score"), "driver"))
                   .alias("most_stable_driver")))
    base = laps.groupBy(*key).agg(
        F.count("*").alias("total_laps"), F.count_distinct("driver").alias("total_drivers"),
        F.avg("air_temp").alias("avg_air_temp"), F.avg("track_temp").alias("avg_track_temp"))
    return base.join(fastest, key, "left").join(stable, key, "left")


def compound_usage(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Lap count per compound."""
    return laps.groupBy(*key, "compound").agg(F.count("*").alias("laps"))


def driver_profiles(lap_feats: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Comparison profile of every driver (rounded as the reference rounds).

    ``lap_feats`` is the lap-grain feature table (needs tire_degradation_rate
    and pit_stop_impact). compounds_used lists compounds by first use.
    """
    key = list(key)
    kd = key + ["driver"]
    c = clean_view(lap_feats)
    clean_stats = (c.groupBy(*kd).agg(
        rnd(F.avg("lap_time"), 3).alias("avg_lap_time"),
        rnd(F.min("lap_time"), 3).alias("best_lap_time"),
        rnd(F.stddev_samp("lap_time"), 3).alias("lap_time_std"),
        F.count("*").alias("lap_count"),
        *[rnd(F.avg(f"sector{i}_time"), 3).alias(f"sector{i}_mean") for i in (1, 2, 3)])
        .withColumn("consistency", rnd(1.0 / (1.0 + F.col("lap_time_std")), 4)))
    firsts = lap_feats.groupBy(*kd, "compound").agg(F.min("lap_number").alias("_first"))
    comp = firsts.groupBy(*kd).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_first", "compound"))), lambda s: s["compound"]), ",")
        .alias("compounds_used"))
    all_laps = lap_feats.groupBy(*kd).agg(
        rnd(F.avg("tire_degradation_rate"), 4).alias("tire_degradation"),
        rnd(F.avg("pit_stop_impact"), 3).alias("pit_impact"))
    return all_laps.join(clean_stats, kd, "left").join(comp, kd, "left")


def compare_with_leader(profiles: DataFrame, stability: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """J10 + I12 at linear cost: every driver side by side with the race's most stable driver.

    The leader table has one row per race, so the join fans out by at most
    one; no pair table of all drivers is ever formed.
    """
    key = list(key)
    leader = stability.where(F.col("stability_rank") == 1).select(*key, F.col("driver").alias("_leader"))
    a = profiles.join(leader, key).where(F.col("driver") != F.col("_leader")).alias("a")
    b = profiles.alias("b")
    cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key] + [F.col("a._leader") == F.col("b.driver")]
    return _pair_table(a.join(b, cond), key)


def compare_two(profiles: DataFrame, driver1: str, driver2: str, key: Sequence[str] = KEY) -> DataFrame:
    """J10 for one named pair in every race where both drove."""
    key = list(key)
    a = profiles.where(F.col("driver") == driver1).alias("a")
    b = profiles.where(F.col("driver") == driver2).alias("b")
    return _pair_table(a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key]), key)


def _pair_table(j: DataFrame, key: list[str]) -> DataFrame:
    d1 = F.col("a.driver")
    d2 = F.col("b.driver")
    faster = F.when(F.coalesce(F.col("a.avg_lap_time"), F.lit(999.0))
                    < F.coalesce(F.col("b.avg_lap_time"), F.lit(999.0)), d1).otherwise(d2)
    stable = F.when(F.coalesce(F.col("a.consistency"), F.lit(0.0))
                    > F.coalesce(F.col("b.consistency"), F.lit(0.0)), d1).otherwise(d2)
    lower_deg = (F.when((F.col("a.tire_degradation") != 0) & (F.col("b.tire_degradation") != 0),
                        F.when(F.col("a.tire_degradation") < F.col("b.tire_degradation"), d1).otherwise(d2)))
    return j.select(*[F.col(f"a.{k}").alias(k) for k in key],
                    d1.alias("driver1"), d2.alias("driver2"),
                    (F.col("a.avg_lap_time") - F.col("b.avg_lap_time")).alias("avg_lap_delta"),
                    (F.col("a.best_lap_time") - F.col("b.best_lap_time")).alias("best_lap_delta"),
                    faster.alias("faster_driver"), stable.alias("more_stable_driver"),
                    lower_deg.alias("lower_degradation_driver"))


def fastest_sector_drivers(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Per sector, the driver with the lowest mean sector time on clean (a)."""
    key = list(key)
    c = clean_view(laps)
    long = c.select(*key, "driver", F.explode(F.array(*[
        F.struct(F.lit(f"sector{i}").alias("sector"), F.col(f"sector{i}_time").alias("t"))
        for i in (1, 2, 3)])).alias("_s")).select(*key, "driver", "_s.*")
    means = long.groupBy(*key, "sector", "driver").agg(F.avg("t").alias("mean_time"))
    return (means.where(F.col("mean_time").isNotNull()).groupBy(*key, "sector")
            .agg(F.min_by("driver", F.struct("mean_time", "driver")).alias("driver"),
                 F.min("mean_time").alias("mean_time")))


def fastest_lap_per_driver(laps: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Each driver's fastest lap row (lap number and time)."""
    key = list(key)
    best = laps.groupBy(*key, "driver").agg(
        F.min_by(F.struct("lap_number", "lap_time", "compound"), F.struct("lap_time", "lap_number")).alias("_b"))
    return best.select(*key, "driver", "_b.lap_number", "_b.lap_time", "_b.compound")

