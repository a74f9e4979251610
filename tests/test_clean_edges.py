"""Hand-written edge fixtures: composite status, NULL stint,
mixed-case compounds, too few normal laps, constant columns, single class."""

import pytest
from pyspark.sql import functions as F

from lapstats.operators.clean import clean_laps, standardize_columns, times_to_seconds
from lapstats.operators.features import stint_lap, strong_performance
from lapstats.operators.profile import correlation_matrix
from lapstats.schema import LAPS


def _laps(spark, rows):
    cols = ["season", "race_name", "driver", "lap_number", "lap_time", "compound", "stint", "track_status",
            "air_temp", "pit_in_time"]
    df = spark.createDataFrame(rows, "season int, race_name string, driver string, lap_number int, lap_time double,"
                                     " compound string, stint int, track_status string, air_temp double,"
                                     " pit_in_time double")
    return standardize_columns(df).select(*[F.col(f.name).cast(f.dataType) for f in LAPS.fields])


def test_status_compound_and_flags(spark):
    rows = [(2024, "R", "A", i, 90.0 + (i % 3) * 0.1, c, 1 if i < 8 else None, s, None if i == 2 else 25.0, None)
            for i, (c, s) in enumerate([(" soft ", "124"), ("hypersoft", "1"), ("MEDIUM", "6"), (None, "2"),
                                        ("hard", "5"), ("wet", "3"), ("Intermediate", None), ("SOFT", "1"),
                                        ("SOFT", "1"), ("SOFT", "1")], start=1)]
    rows.append((2024, "R", "A", 11, 200.0, "SOFT", None, "1", 25.0, None))   # slow -> pit lap by the 1.5x rule
    rows.append((2024, "R", "A", 12, None, "SOFT", None, "1", 25.0, None))    # dropped
    out = {r.lap_number: r for r in clean_laps(_laps(spark, rows)).collect()}
    assert 12 not in out
    assert out[1].is_sc_lap and out[1].track_status_label == "Unknown" and out[1].compound == "SOFT"
    assert out[3].is_sc_lap and out[3].track_status_label == "VSC"
    assert not out[6].is_sc_lap and out[6].track_status_label == "Yellow"
    assert out[7].track_status_label == "Unknown" and not out[7].is_sc_lap
    assert out[2].compound == "UNKNOWN" and out[4].compound == "UNKNOWN" and out[7].compound == "INTERMEDIATE"
    assert out[2].air_temp == 25.0                       # race median fill
    assert out[11].is_pit_lap
    # fewer than 10 normal laps -> nothing flagged as outlier
    assert not any(r.is_outlier for r in out.values())
    sl = {r.lap_number: r.stint_lap for r in stint_lap(clean_laps(_laps(spark, rows))).collect()}
    assert sl[1] == 1 and sl[7] == 7 and sl[9] is None


def test_duration_text_parsing(spark):
    df = spark.createDataFrame([("0 days 00:01:35.140000",), ("1:02:03",), ("95.1",), (None,), ("fast",)],
                               "lap_time string")
    got = [r.lap_time for r in times_to_seconds(df).collect()]
    assert got[0] == pytest.approx(95.14) and got[1] == pytest.approx(3723.0)
    assert got[2] == pytest.approx(95.1) and got[3] is None and got[4] is None


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([("k", float(i), 5.0, float(i) * 2) for i in range(6)], "race string, x double, c double, y double")
    r = {(x.feature_1, x.feature_2): x.r for x in correlation_matrix(df, ["x", "c", "y"], ["race"]).collect()}
    assert r[("x", "c")] is None and r[("c", "y")] is None
    assert r[("x", "y")] == pytest.approx(1.0)


def test_single_class_target_falls_back_to_fastest(spark):
    m = spark.createDataFrame([("k", "A", 90.0, 0.5), ("k", "B", 91.0, 0.5), ("k", "C", 91.0, 0.5)],
                              "race string, driver string, average_lap_time double, consistency_score double")
    # identical lap times and consistency: every driver is "strong", i.e. one class only
    same = m.withColumn("average_lap_time", F.lit(90.0))
    got = {r.driver: r.strong_performance for r in strong_performance(same, ["race"]).collect()}
    assert got == {"A": 1, "B": 0, "C": 0}
