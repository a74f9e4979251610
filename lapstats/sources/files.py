"""File scans.

Race files are named ``{slug}_{kind}_raw.csv`` (slug = lower-case race name
with non-alphanumerics as '_'). One scan reads every race at once; the race
comes from the file name, so there is no per-race loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapstats.functions.exprs import duration_text_to_seconds, slug_to_title
from lapstats.operators.clean import standardize_columns, times_to_seconds
from lapstats.schema import LAPS, WEATHER


def race_from_path(kind: str) -> F.Column:
    """Race name from '<dir>/<slug>_<kind>_raw.csv' (F2 applied to the slug)."""
    slug = F.regexp_extract(F.input_file_name(), rf"([^/]+)_{kind}_raw\.csv(/[^/]*)?$", 1)
    return slug_to_title(slug)


def typed_laps() -> list[F.Column]:
    """The lap columns in their types; integers may be written as "1.0"."""
    def typed(f: T.StructField) -> F.Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            return c.cast("string")
        if isinstance(f.dataType, T.IntegerType):
            return c.try_cast("double").try_cast(f.dataType).alias(f.name)
        return c.try_cast(f.dataType)

    return [typed(f).alias(f.name) for f in LAPS.fields]


def files_by_header(spark: SparkSession, path: str | Sequence[str]) -> dict[str, list[str]]:
    """Header line -> the files that have it. Only file names and first lines reach the driver; empty files are left out."""
    first = F.regexp_extract(F.substring("content", 1, 65536).cast("string"), r"^\uFEFF?([^\r\n]*)", 1)
    found: dict[str, list[str]] = {}
    for r in spark.read.format("binaryFile").load(path).select("path", first.alias("header")).where("header <> ''").toLocalIterator():
        found.setdefault(r.header, []).append(r.path)
    return {h: sorted(files) for h, files in sorted(found.items())}


def _canonical(raw: DataFrame, season: int | None) -> DataFrame:
    """Canonical lap columns of one scan; the race and season that rows don't name come from file and argument."""
    df = times_to_seconds(standardize_columns(raw.toDF(*[c.strip().lstrip("\ufeff") for c in raw.columns])))
    df = df.withColumn("source_file", F.input_file_name())
    df = df.withColumn("race_name", F.coalesce(F.col("race_name").cast("string"), race_from_path("laps")))
    if season is not None:
        df = df.withColumn("season", F.coalesce(F.col("season").try_cast("int"), F.lit(season)))
    return df.select(*typed_laps(), *[c for c in df.columns if c not in LAPS.fieldNames()])


def read_raw_laps_csv(spark: SparkSession, path: str | Sequence[str], season: int | None = None,
                      schema: T.StructType | None = None) -> DataFrame:
    """S1 + P1 + P2: raw lap CSVs of any number of races -> canonical lap schema and ``source_file``.

    Files are grouped by their header line and each group is one scan, so files
    may differ in the names and order of columns. All columns are read as text
    and typed by what they are, so a column's type never depends on a sample.
    With an explicit ``schema`` there is one scan, and files with another header fail.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        return _canonical(reader.option("enforceSchema", False).schema(schema).csv(path), season)
    out: DataFrame | None = None
    for files in files_by_header(spark, path).values():
        part = _canonical(reader.csv(files), season)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], T.StructType([*LAPS.fields, T.StructField("source_file", T.StringType())])) if out is None else out


def read_weather_csv(spark: SparkSession, path: str | Sequence[str], season: int | None = None) -> DataFrame:
    """Weather sample CSVs; 'Time' duration text -> time_s; race from the file name."""
    raw = spark.read.option("header", True).csv(path)
    cols = {c.strip().lower().replace(" ", "").replace("_", ""): c for c in raw.columns}
    pick = lambda name, t: F.col(cols[name]).try_cast(t) if name in cols else F.lit(None).cast(t)
    df = raw.select(
        duration_text_to_seconds(F.col(cols["time"])).alias("time_s") if "time" in cols
        else F.lit(None).cast("double").alias("time_s"),
        pick("airtemp", "double").alias("air_temp"), pick("humidity", "double").alias("humidity"),
        pick("pressure", "double").alias("pressure"),
        F.lower(F.col(cols["rainfall"])).isin("true", "1").alias("rainfall") if "rainfall" in cols
        else F.lit(None).cast("boolean").alias("rainfall"),
        pick("tracktemp", "double").alias("track_temp"), pick("winddirection", "int").alias("wind_direction"),
        pick("windspeed", "double").alias("wind_speed"),
        race_from_path("weather").alias("race_name"))
    if season is not None:
        df = df.withColumn("season", F.lit(season))
    return df.select(*[f.name for f in WEATHER.fields], "race_name", *(["season"] if season is not None else []))


def read_processed(spark: SparkSession, path: str, races: Sequence[str] | None = None,
                   season: int | None = None) -> DataFrame:
    """Partitioned Parquet table, pruned to the requested races."""
    df = spark.read.parquet(path)
    if season is not None:
        df = df.where(F.col("season") == season)
    if races:
        df = df.where(F.col("race_name").isin(list(races)))
    return df
