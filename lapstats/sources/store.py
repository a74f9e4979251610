"""Sinks and stores (S4-S19) on partitioned Parquet.

Result tables keep versions: a run writes its races to ``<table>/run=<run>`` and
touches nothing else. The ledger of processed races is the manifest: it names the
run whose rows are a race's current ones. It is an append-only table, and a run's
entries are one file, so all its tables switch at once when that file appears; a
run that dies before leaves every race as it was. ``read_table`` shows current
rows only. Versions that are no longer current go after the switch.

Single tables (caches, upserts) are written with dynamic partition overwrite: one
idempotent write that replaces exactly the races present in the output.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapstats.functions.aggregates import checked_broadcast
from lapstats.schema import KEY

STORED_LAP_COLUMNS = ["season", "race_name", "driver", "team", "lap_number", "lap_time", "sector1_time",
                      "sector2_time", "sector3_time", "compound", "tyre_life", "stint", "air_temp", "track_temp",
                      "humidity", "track_status", "is_pit_lap", "is_sc_lap", "is_outlier"]
LEDGER = T.StructType([T.StructField("season", T.IntegerType()), T.StructField("race_name", T.StringType()),
                       T.StructField("status", T.StringType()), T.StructField("processed_at", T.TimestampType()),
                       T.StructField("run", T.StringType()), T.StructField("files", T.ArrayType(T.StringType()))])


def write_partitioned(df: DataFrame, path: str, key: Sequence[str] = KEY, fmt: str = "parquet") -> None:
    """Replace the races present in ``df``; other races stay untouched."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*key).format(fmt).save(path))


def drop_races(spark: SparkSession, path: str, races: DataFrame, key: Sequence[str] = KEY, only: Column | None = None) -> None:
    """Delete the partitions of ``races`` (of which ``only`` holds). Only folders that exist already are listed and deleted."""
    try:
        old = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return  # no table yet, or one without any row
        raise
    old = old if only is None else old.where(only)
    folders = (old.select(*key, F.regexp_extract("_metadata.file_path", "(.*)/", 1).alias("folder")).distinct()
               .join(races.select(*key).distinct(), list(key), "left_semi").select("folder"))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for row in folders.toLocalIterator():
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.folder))
        folder.getFileSystem(conf).delete(folder, True)


def stored_laps(laps: DataFrame) -> DataFrame:
    """Stored lap table (the reference's 17 columns plus flags) with a load timestamp."""
    return laps.select(*STORED_LAP_COLUMNS).withColumn("created_at", F.current_timestamp())


def driver_stats(matrix: DataFrame, stability: DataFrame, clusters: DataFrame | None,
                 key: Sequence[str] = KEY) -> DataFrame:
    """S7 rows: one per race and driver, with team, cluster number (NULL without models) and strong flag."""
    kd = [*key, "driver"]
    out = matrix.join(stability.select(*kd, "team"), kd, "left")
    if clusters is not None:
        out = out.join(clusters.select(*kd, F.col("cluster").cast("int").alias("cluster_label")), kd, "left")
    else:
        out = out.withColumn("cluster_label", F.lit(None).cast("int"))
    return out.select(
        *kd, "team", F.col("average_lap_time").alias("avg_lap_time"), "best_lap_time", "lap_time_std",
        "consistency_score", F.col("average_race_pace").alias("avg_race_pace"),
        F.col("tire_degradation_rate").alias("tire_degradation"), "pit_stop_impact", "cluster_label", "strong_performance")


def race_summary(overview: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """S8 rows: one per race with its totals, fastest lap and the time of processing."""
    return overview.select(*key, "total_laps", "total_drivers", "fastest_lap", "fastest_driver", "most_stable_driver",
                           F.current_timestamp().alias("processed_at"))


def upsert(spark: SparkSession, path: str, updates: DataFrame, key: Sequence[str] = KEY) -> None:
    """Insert-or-replace rows by key (the key is the partition, so a
    dynamic partition overwrite of the updated keys is exactly the upsert)."""
    write_partitioned(updates, path, key)


def new_run() -> str:
    """Name of a run; later runs sort later."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def write_version(df: DataFrame, path: str, run: str, key: Sequence[str] = KEY) -> None:
    """The rows of a run, beside those of other runs."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*key).parquet(f"{path}/run={run}")


def read_table(spark: SparkSession, path: str, ledger_path: str, key: Sequence[str] = KEY) -> DataFrame | None:
    """Current rows of a versioned table; None where no run has written it."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    current = read_ledger(spark, ledger_path).where(F.col("status") == "complete").select(*key, "run")
    return df.join(checked_broadcast(current), [*key, "run"], "left_semi").drop("run")


def drop_superseded(spark: SparkSession, path: str, races: DataFrame, run: str, key: Sequence[str] = KEY) -> None:
    """Delete what other runs wrote for ``races``; call it after the switch to ``run``."""
    drop_races(spark, path, races, key, F.col("run") != run)


def mark_processed(spark: SparkSession, ledger_path: str, races: DataFrame, status: str = "complete",
                   key: Sequence[str] = KEY, run: str | None = None) -> None:
    """Record races in the processed-races ledger; ``races`` may name their ``files``. One file, so all or nothing."""
    files = F.col("files") if "files" in races.columns else F.lit(None).cast("array<string>")
    rows = races.select(*key, F.lit(status).alias("status"), F.current_timestamp().alias("processed_at"),
                        F.lit(run or new_run()).alias("run"), files.alias("files"))
    rows.dropDuplicates(list(key)).coalesce(1).write.mode("append").parquet(ledger_path)


def read_ledger(spark: SparkSession, ledger_path: str, key: Sequence[str] = KEY) -> DataFrame:
    """The latest entry of every race."""
    try:
        rows = spark.read.schema(LEDGER).parquet(ledger_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)  # no ledger yet: nothing processed
    last = F.max_by(F.struct("status", "processed_at", "run", "files"), F.struct("run", "processed_at"))
    return rows.groupBy(*key).agg(last.alias("_l")).select(*key, "_l.*")


def is_processed(spark: SparkSession, ledger_path: str, season: int, race_name: str) -> bool:
    """Point lookup (partition-pruned, stops at the first row)."""
    led = read_ledger(spark, ledger_path)
    return (led.where((F.col("season") == season) & (F.col("race_name") == race_name)
                      & (F.col("status") == "complete")).limit(1).count() > 0)


def processed_races(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Completed races, newest first."""
    return read_ledger(spark, ledger_path).where(F.col("status") == "complete").orderBy(F.desc("processed_at"),
                                                                                         "season", "race_name")


def nan_to_null(df: DataFrame) -> DataFrame:
    """S16 serializer rule: NaN / +-Inf in double columns become NULL."""
    cols = []
    for name, t in df.dtypes:
        if t in ("double", "float"):
            c = F.col(name)
            cols.append(F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def save_cached(result: DataFrame, path: str, version: str, key: Sequence[str] = KEY) -> None:
    """S16 save: result rows tagged with the cache version and a valid status."""
    write_partitioned(nan_to_null(result).withColumn("version", F.lit(version))
                      .withColumn("cache_status", F.lit("valid")).withColumn("cached_at", F.current_timestamp()),
                      path, key)


def load_cached(spark: SparkSession, path: str, version: str) -> DataFrame:
    """S16 load: rows of the current version only (a version mismatch reads as a miss)."""
    return (spark.read.parquet(path).where((F.col("version") == version) & (F.col("cache_status") == "valid"))
            .drop("version", "cache_status", "cached_at"))


def invalidate_cached(spark: SparkSession, path: str, races: DataFrame, key: Sequence[str] = KEY) -> None:
    """Replace the races' cache partitions with a single tombstone row."""
    schema = spark.read.parquet(path).schema
    base = races.select(*key).distinct()
    cols = [F.col(f.name) if f.name in key else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields if f.name not in ("cache_status",)]
    write_partitioned(base.select(*cols).withColumn("cache_status", F.lit("invalidated")), path, key)


def cached_races(spark: SparkSession, path: str, key: Sequence[str] = KEY) -> DataFrame:
    """S17 list: races with a valid cache entry."""
    return spark.read.parquet(path).where(F.col("cache_status") == "valid").select(*key).distinct()


def to_json_documents(result: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """F12 / S16 document export: one JSON line per result row, NaN-safe."""
    df = nan_to_null(result)
    return df.select(*key, F.to_json(F.struct(*[c for c in df.columns if c not in key])).alias("json"))


def export_csv(result: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV export of a result table. ``single_file`` is meant for small
    per-race summaries only; lap-grain exports stay partitioned by race."""
    df = result.coalesce(1) if single_file else result
    df.write.mode("overwrite").option("header", True).csv(path)
