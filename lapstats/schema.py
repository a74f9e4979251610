"""Schemas, key columns and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Session key: one race of one season. Every operator takes it as a parameter.
KEY = ("season", "race_name")
ENTITY = "driver"

LAPS = T.StructType([
    T.StructField("season", T.IntegerType()),
    T.StructField("race_name", T.StringType()),
    T.StructField("driver", T.StringType()),
    T.StructField("team", T.StringType()),
    T.StructField("lap_number", T.IntegerType()),
    T.StructField("lap_time", T.DoubleType()),
    T.StructField("sector1_time", T.DoubleType()),
    T.StructField("sector2_time", T.DoubleType()),
    T.StructField("sector3_time", T.DoubleType()),
    T.StructField("compound", T.StringType()),
    T.StructField("tyre_life", T.IntegerType()),
    T.StructField("stint", T.IntegerType()),
    T.StructField("air_temp", T.DoubleType()),
    T.StructField("track_temp", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("pit_in_time", T.DoubleType()),
    T.StructField("pit_out_time", T.DoubleType()),
    T.StructField("track_status", T.StringType()),
    T.StructField("is_personal_best", T.BooleanType()),
    T.StructField("is_simulated", T.BooleanType()),
])

WEATHER = T.StructType([
    T.StructField("time_s", T.DoubleType()),
    T.StructField("air_temp", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("pressure", T.DoubleType()),
    T.StructField("rainfall", T.BooleanType()),
    T.StructField("track_temp", T.DoubleType()),
    T.StructField("wind_direction", T.IntegerType()),
    T.StructField("wind_speed", T.DoubleType()),
])

# ---- fixed values (must equal the reference's for equal results) ----
# Column-name normalisation: lower-case, spaces and underscores removed -> canonical name.
COLUMN_ALIASES = {
    "driver": "driver", "team": "team", "lapnumber": "lap_number", "laptime": "lap_time",
    "sector1time": "sector1_time", "sector2time": "sector2_time", "sector3time": "sector3_time",
    "compound": "compound", "tyrelife": "tyre_life", "stint": "stint", "airtemp": "air_temp",
    "tracktemp": "track_temp", "humidity": "humidity", "trackstatus": "track_status",
    "pitintime": "pit_in_time", "pitouttime": "pit_out_time", "ispersonalbest": "is_personal_best",
    "racename": "race_name",
}
# Valid tyre compounds; anything else becomes UNKNOWN.
COMPOUNDS = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET")
COMPOUNDS_ALL = COMPOUNDS + ("UNKNOWN",)
# Track status code -> label (exact match; composite codes are Unknown).
TRACK_STATUS = {"1": "Green", "2": "Yellow", "3": "Yellow", "4": "SafetyCar", "5": "RedFlag", "6": "VSC"}
# A status containing one of these characters marks a safety-car lap.
SC_CODES = "[46]"
PIT_LAP_FACTOR = 1.5          # lap slower than 1.5 x race median -> pit lap
OUTLIER_SIGMA = 3.0           # mean +- 3 sample std of normal laps
OUTLIER_MIN_LAPS = 10         # fewer normal laps -> no outliers flagged
MIN_STINT_LAPS = 3            # degradation slope needs at least 3 laps
PIT_WINDOW = 3                # laps before / after a pit lap
# Model features (driver matrix columns fed to clustering and classifiers).
MODEL_FEATURES = ("average_lap_time", "consistency_score", "tire_degradation_rate",
                  "pit_stop_impact", "sector_consistency")
MATRIX_FEATURES = ("average_lap_time", "best_lap_time", "lap_time_std", "consistency_score",
                   "average_race_pace", "tire_degradation_rate", "pit_stop_impact",
                   "sector_consistency", "air_temp", "track_temp")
# Every numeric column of the driver matrix: what the sweeps train on.
MATRIX_NUMERIC = ["average_lap_time", "best_lap_time", "lap_time_std", "consistency_score", "average_race_pace",
                  "tire_degradation_rate", "pit_stop_impact", "sector_consistency", "air_temp", "track_temp",
                  "degradation_soft", "degradation_medium", "degradation_hard", "degradation_intermediate",
                  "degradation_wet", "degradation_unknown", "avg_air_temp"]
SEED = 42
