"""End to end: raw CSV files -> pipeline -> stores; incremental rerun; streaming ingest."""

import os
import tempfile

from pyspark.sql import functions as F

from lapstats.plans.pipeline import run_pipeline
from lapstats.sources.adapters import laps_from_events
from lapstats.sources.files import read_raw_laps_csv
from lapstats.sources import store

SF = "/root/testdata/sf0.001"


def _write_raw(spark, d):
    laps = laps_from_events(spark, SF).where(F.col("race_name").isin("W0", "W1")).drop("time_s")
    pdf = laps.toPandas()  # small test fixture only
    for race, slug in (("W0", "bahrain"), ("W1", "great_britain")):
        part = pdf[pdf.race_name == race].drop(columns=["race_name", "season"])
        part = part.rename(columns={"lap_time": "LapTime", "tyre_life": "Tyre Life"})
        if slug == "bahrain":  # durations as text, as the fetcher writes them
            part["LapTime"] = part["LapTime"].map(
                lambda s: None if s != s else f"0 days 00:{int(s // 60):02d}:{s % 60:09.6f}")
        part.to_csv(os.path.join(d, f"{slug}_laps_raw.csv"), index=False)


def test_pipeline_and_incremental(spark):
    raw_dir = tempfile.mkdtemp(prefix="lapstats-raw-")
    out = tempfile.mkdtemp(prefix="lapstats-out-")
    _write_raw(spark, raw_dir)
    raw = read_raw_laps_csv(spark, raw_dir + "/*_laps_raw.csv", season=2024)
    races = sorted(r.race_name for r in raw.select("race_name").distinct().collect())
    assert races == ["Bahrain", "Great Britain"]
    assert raw.where(F.col("lap_time").isNull()).count() < raw.count()
    paths = run_pipeline(spark, raw, out, with_models=True, with_tuning=False)
    assert "model_comparison" in paths and "findings" in paths
    drivers = store.read_table(spark, paths["driver_matrix"], paths["processed_races"]).count()
    for name in ("cv_predictions", "entity_errors", "local_explanations"):
        assert store.read_table(spark, paths[name], paths["processed_races"]).count() == drivers
    for name in ("holdout_scores", "model_winner", "roc_curve", "permutation_importance", "shap_importance", "race_top5"):
        found = store.read_table(spark, paths[name], paths["processed_races"])
        assert found.select("race_name").distinct().count() == 2, name
    summary = store.read_table(spark, paths["model_comparison"], paths["processed_races"])
    assert summary.where("overfit_gap IS NULL").count() == 0
    assert spark.read.parquet(paths["driver_stability"]).select("race_name").distinct().count() == 2
    assert store.is_processed(spark, paths["processed_races"], 2024, "Bahrain")
    # second run: everything already complete -> nothing to do
    assert run_pipeline(spark, raw, out, with_models=False) == {}
    summary = spark.read.parquet(f"{out}/race_summary").collect()
    assert len(summary) == 2 and all(r.fastest_driver and r.total_laps and r.processed_at for r in summary)
    stats = spark.read.parquet(f"{out}/driver_stats")
    assert stats.count() == spark.read.parquet(paths["driver_matrix"]).count()
    assert stats.where("cluster_label IS NULL OR strong_performance IS NULL").count() == 0


def test_reprocessed_race_without_rows_keeps_none(spark):
    path = tempfile.mkdtemp(prefix="lapstats-drop-") + "/t"
    races = spark.createDataFrame([(2024, "São Paulo"), (2024, "B")], "season int, race_name string")
    store.drop_races(spark, path, races)  # no table yet
    store.write_partitioned(races.withColumn("x", F.lit(1)), path)
    store.drop_races(spark, path, races.where("race_name <> 'B'"))
    assert [r.race_name for r in spark.read.parquet(path).collect()] == ["B"]
    store.drop_races(spark, path, races)
    store.write_partitioned(races.withColumn("x", F.lit(2)).limit(1), path)
    assert spark.read.parquet(path).count() == 1


def test_streaming_incremental(spark):
    from lapstats.streaming.incremental import start_incremental
    raw_dir = tempfile.mkdtemp(prefix="lapstats-sraw-")
    out = tempfile.mkdtemp(prefix="lapstats-sout-")
    ck = tempfile.mkdtemp(prefix="lapstats-sck-")
    _write_raw(spark, raw_dir)
    q = start_incremental(spark, raw_dir, out, ck, season=2024)
    q.awaitTermination(600)
    done = {r.race_name for r in store.processed_races(spark, f"{out}/processed_races").collect()}
    assert done == {"Bahrain", "Great Britain"}


def test_cache_roundtrip(spark):
    p = tempfile.mkdtemp(prefix="lapstats-cache-") + "/c"
    df = spark.createDataFrame([(2024, "A", float("nan")), (2024, "B", 1.0)], "season int, race_name string, x double")
    store.save_cached(df, p, "v1")
    assert store.load_cached(spark, p, "v2").count() == 0
    got = {r.race_name: r.x for r in store.load_cached(spark, p, "v1").collect()}
    assert got == {"A": None, "B": 1.0}
    store.invalidate_cached(spark, p, df.where("race_name = 'A'"))
    assert {r.race_name for r in store.cached_races(spark, p).collect()} == {"B"}
