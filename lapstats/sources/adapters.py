"""Lap-shaped views over the driver-generated tables (pure projections).

The reference consumes a lap table (one row per driver x lap of a race). The
test fixtures are event and order-line tables, so these adapters derive the
lap roles from their columns. Everything is a lazy projection plus one
window per (race, driver), so the work grows with the input table.

Adapter A (``laps_from_events``): events -> laps; exercises every cleaning
edge (NULL and zero lap times, composite status codes, mixed-case compounds,
missing weather, missing sectors).
Adapter B (``laps_from_lineitem``): order lines -> laps; bulk input for the
benchmark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from lapstats.functions.aggregates import checked_broadcast
from lapstats.schema import KEY, LAPS

#: Suppliers whose team is sent to every task.
TEAM_MAX_ROWS = 2_000_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _seconds_since_epoch(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts) / 1e6


def _laps_and_stints(driver: WindowSpec, pit_in: Column) -> list[Column]:
    """lap_number, the place of a row in ``driver``, and stint, 1 + earlier pit laps: both from one sort."""
    earlier = F.sum(pit_in.isNotNull().cast("int")).over(driver.rowsBetween(Window.unboundedPreceding, -1))
    return [F.row_number().over(driver).alias("lap_number"), (F.lit(1) + F.coalesce(earlier, F.lit(0))).cast("int").alias("stint")]


def _project(df: DataFrame) -> DataFrame:
    extra = [c for c in df.columns if c not in LAPS.fieldNames()]
    return df.select(*[F.col(f.name).cast(f.dataType) for f in LAPS.fields], *extra)


def laps_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    base = (e.select(
        F.year("ts").alias("season"),
        F.concat(F.lit("W"), F.floor((F.dayofmonth("ts") - 1) / 6).cast("int").cast("string")).alias("race_name"),
        F.concat(F.lit("D"), F.col("user_id").cast("string")).alias("driver"),
        F.concat(F.lit("T"), (F.col("user_id") % 10).cast("string")).alias("team"),
        "user_id", "event_id", "ts", "event_type", "value", k.alias("k"))
        .withColumn("base_time", F.lit(80.0) + F.col("value") / 19.7
                    + F.when((F.col("event_type") == "purchase") & (F.col("k") < 10), F.lit(60.0))
                    .otherwise(F.lit(0.0))))
    w = Window.partitionBy(*KEY, "driver").orderBy("ts", "event_id")
    pit_in = F.when(F.col("k") >= 93, F.col("base_time"))
    df = base.select(
        "season", "race_name", "driver", "team", "user_id", "k", "value", "event_type",
        *_laps_and_stints(w, pit_in),
        F.when((F.col("event_type") == "click") & (F.col("k") == 1), F.lit(None).cast("double"))
        .when((F.col("event_type") == "click") & (F.col("k") == 2), F.lit(0.0))
        .otherwise(F.col("base_time")).alias("lap_time"),
        pit_in.alias("pit_in_time"),
        F.lit(None).cast("double").alias("pit_out_time"),
        F.when((F.col("event_type") == "error") & (F.col("k") % 3 == 0), F.lit("4"))
        .when((F.col("event_type") == "view") & (F.col("k") % 25 == 0), F.lit("124"))
        .when((F.col("event_type") == "click") & (F.col("k") == 50), F.lit("6"))
        .when(F.col("event_type") == "signup", F.lit("2"))
        .otherwise(F.lit("1")).alias("track_status"),
        _seconds_since_epoch(F.col("ts")).alias("time_s"),
    )
    compound = F.element_at(F.array(F.lit("SOFT"), F.lit("MEDIUM"), F.lit("HARD")),
                            ((F.col("stint") + F.col("user_id")) % 3 + 1).cast("int"))
    w_stint = Window.partitionBy(*KEY, "driver", "stint").orderBy("lap_number")
    fv = F.floor("value")
    df = df.select(
        "*",
        F.when(F.col("k") == 97, F.lit("hypersoft"))
        .when(F.col("k") % 11 == 0, F.concat(F.lit(" "), F.lower(compound), F.lit(" ")))
        .otherwise(compound).alias("compound"),
        (F.row_number().over(w_stint) + F.col("user_id") % 3).alias("tyre_life"),
        (F.col("lap_time") * 0.28 + F.col("k") / 1000.0).alias("sector1_time"),
        (F.col("lap_time") * 0.38).alias("sector2_time"),
        F.when(F.col("k") == 77, F.lit(None).cast("double"))
        .otherwise(F.col("lap_time") * 0.34 - F.col("k") / 1000.0).alias("sector3_time"),
        F.when(F.col("k") % 23 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(20.0) + fv % 13).alias("air_temp"),
        (F.lit(30.0) + F.floor(F.col("value") * 7) % 17).alias("track_temp"),
        F.when(F.col("k") % 19 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(40.0) + F.floor(F.col("value") * 3) % 31).alias("humidity"),
        F.lit(False).alias("is_personal_best"),
        F.lit(False).alias("is_simulated"),
    )
    return _project(df.select(*LAPS.fieldNames(), "time_s"))


def weather_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather samples per race: mean of 'view' event values in the hour."""
    e = _table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    hour = F.date_trunc("hour", "ts")
    return (e.groupBy(
        F.year("ts").alias("season"),
        F.concat(F.lit("W"), F.floor((F.dayofmonth("ts") - 1) / 6).cast("int").cast("string")).alias("race_name"),
        _seconds_since_epoch(hour).alias("time_s"))
        .agg(F.avg("value").alias("_v"), F.count("*").alias("_n"))
        .select("season", "race_name", "time_s",
                (F.lit(20.0) + F.col("_v") / 10.0).alias("air_temp"),
                (F.lit(30.0) + F.col("_v") / 5.0).alias("track_temp"),
                (F.lit(40.0) + F.col("_n")).alias("humidity")))


def laps_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    sup = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = li.select(
        F.year("l_shipdate").alias("season"),
        F.when(F.month("l_shipdate") <= 6, F.lit(1)).otherwise(F.lit(2)).alias("half"), "*")
    # A driver's laps of a race; sorted by numbers, the most selective first. The names are made afterwards.
    w = Window.partitionBy("l_suppkey", "season", "half").orderBy(
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    lap_time = (F.lit(80.0) + F.col("l_extendedprice") / 10000.0
                + F.when((F.col("l_discount") == 0.10) & (F.col("l_tax") == 0.08), F.lit(60.0))
                .otherwise(F.lit(0.0)))
    pit_in = F.when((F.col("l_discount") == 0.0) & (F.col("l_tax") < 0.02), lap_time)
    df = base.select("*", *_laps_and_stints(w, pit_in)).select(
        "season", F.concat(F.lit("H"), F.col("half").cast("string")).alias("race_name"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("driver"),
        "l_suppkey", "l_partkey", "l_orderkey", "l_linenumber",
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "lap_number", "stint",
        lap_time.alias("lap_time"),
        pit_in.alias("pit_in_time"),
        F.lit(None).cast("double").alias("pit_out_time"),
        F.when((F.col("l_tax") == 0.08) & (F.col("l_linestatus") == "F"), F.lit("4"))
        .when((F.col("l_tax") == 0.07) & (F.col("l_linestatus") == "O"), F.lit("6"))
        .when(F.col("l_tax") == 0.01, F.lit("2"))
        .otherwise(F.lit("1")).alias("track_status"))
    teams = sup.join(nat, sup.s_nationkey == nat.n_nationkey).select("s_suppkey", F.col("n_name").alias("team"))
    # Two short columns a supplier; more of them are joined by a shuffle.
    teams = checked_broadcast(teams, TEAM_MAX_ROWS)
    df = df.join(teams, df.l_suppkey == teams.s_suppkey, "left")
    df = df.select(
        "*",
        F.when(F.col("l_returnflag") == "A", F.lit("SOFT"))
        .when(F.col("l_returnflag") == "N", F.lit("MEDIUM"))
        .otherwise(F.lit("HARD")).alias("compound"),
        F.col("l_quantity").cast("int").alias("tyre_life"),
        (F.col("lap_time") * 0.30).alias("sector1_time"),
        (F.col("lap_time") * 0.35 + F.col("l_discount")).alias("sector2_time"),
        (F.col("lap_time") * 0.35 - F.col("l_discount")).alias("sector3_time"),
        (F.lit(20.0) + F.col("l_linenumber")).alias("air_temp"),
        (F.lit(30.0) + F.col("l_partkey") % 20).alias("track_temp"),
        (F.lit(40.0) + F.col("l_orderkey") % 30).alias("humidity"),
        F.lit(False).alias("is_personal_best"),
        F.lit(False).alias("is_simulated"),
    )
    return _project(df.select(*LAPS.fieldNames()))


ADAPTERS = {"events": laps_from_events, "lineitem": laps_from_lineitem}
