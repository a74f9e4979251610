"""End-to-end race pipeline (the reference's full run), for all races at once.

raw laps -> clean (written) -> features (written) -> analyses -> matrix ->
models and evaluation -> insights -> stores and ledger. Each stage that feeds
several later ones is written to storage (partitioned by race) and read back,
so a stage is computed once, a failure restarts from the last written stage,
and the incremental path (S15) only processes races missing from the ledger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstats.operators import analysis as A
from lapstats.operators import evaluate as EV
from lapstats.operators import explain as XP
from lapstats.operators import features as FE
from lapstats.operators import insights as INS
from lapstats.operators import ml as ML
from lapstats.operators import profile as PR
from lapstats.operators import tuning as TU
from lapstats.operators.clean import clean_laps
from lapstats.operators.joins import pending_keys
from lapstats.schema import KEY, MATRIX_NUMERIC, MODEL_FEATURES
from lapstats.sources import store
from lapstats.session import materialize


def run_pipeline(spark: SparkSession, raw_laps: DataFrame, out_dir: str, key: Sequence[str] = KEY,
                 with_models: bool = True, incremental: bool = True, with_tuning: bool = True) -> dict[str, str]:
    """Process every race in ``raw_laps`` (or, incrementally, only those not yet
    complete in the ledger) and write all result tables under ``out_dir``.

    With a column ``source_file``, a race is complete for the files in its ledger
    entry: a file that arrives later reruns the race from all its files. Tables
    keep versions and switch together at the end (``store.read_table`` reads them).

    ``with_models`` adds evaluation, hold-out scores, tests, explanations and
    clusters; ``with_tuning`` also the grid search, the sweeps, the ablation and the
    learning curve, which train many models.

    Returns the table name -> path map.
    """
    key = list(key)
    out = out_dir.rstrip("/")
    paths: dict[str, str] = {}
    ledger = f"{out}/processed_races"
    if incremental:
        todo = pending_keys(raw_laps, store.read_ledger(spark, ledger, key), key)
        raw_laps = raw_laps.join(todo, key, "left_semi")
    raw_laps = materialize(raw_laps, "raw_laps")
    if raw_laps.limit(1).count() == 0:
        return paths
    if "source_file" in raw_laps.columns:
        raw_laps = _with_earlier_files(spark, raw_laps, f"{out}/laps_raw", ledger, key)
        races = raw_laps.groupBy(*key).agg(F.array_sort(F.collect_set("source_file")).alias("files"))
    else:
        races = raw_laps.select(*key).distinct()
    races, run = materialize(races, "races"), store.new_run()

    def write(name: str, df: DataFrame) -> DataFrame:
        p = f"{out}/{name}"
        store.write_version(df, p, run, key)
        paths[name] = p
        # The table's own schema: a result without any row has no file to take one from.
        return spark.read.schema(df.schema).parquet(f"{p}/run={run}")

    write("laps_raw", raw_laps)
    write("pits_raw", raw_laps.where(F.col("pit_in_time").isNotNull() | F.col("pit_out_time").isNotNull()))
    laps = write("laps_clean", clean_laps(raw_laps, key))
    write("laps_store", store.stored_laps(laps))
    feats = write("laps_features", FE.lap_features(laps, key))
    stability = write("driver_stability", A.driver_stability(laps, key))
    tables = {
        "stability": stability,
        "compound_stats": write("compound_stats", A.compound_stats(laps, key)),
        "degradation_curve": write("degradation_curve", A.degradation_curve(laps, key)),
        "pit": write("pit_stop_analysis", A.pit_stop_analysis(laps, key)),
        "overview": write("race_overview", A.race_overview(laps, key)),
        "weather": write("weather_correlation", A.weather_correlation(laps, key)),
        "sectors": write("fastest_sector_drivers", A.fastest_sector_drivers(laps, key)),
    }
    write("tyre_age_curve", A.tyre_age_curve(laps, key))
    write("strategy_map", A.strategy_map(laps, key))
    write("pit_stop_details", A.pit_stop_details(laps, key))
    write("driver_profiles", A.driver_profiles(feats, key))
    write("eda_summary", PR.basic_summary(laps, key))
    write("eda_missing", PR.missing_values(laps, key))
    write("eda_lap_time_distribution", PR.lap_time_distribution(laps, key))
    write("eda_lap_correlations", PR.correlation_matrix(feats, PR.LAP_CORR_COLUMNS, key))

    matrix = write("driver_matrix", FE.strong_performance(FE.driver_matrix(laps, key), key))
    if with_models:
        oof, on_training_rows = EV.cross_validate_fitted(matrix, key)
        oof = write("cv_predictions", oof)
        scores = write("cv_fold_scores", EV.fold_scores(oof, key))
        comparison = EV.cv_summary(scores, oof, key, on_training_rows())
        if with_tuning:
            comparison = EV.comparison_table(comparison, write("grid_search", TU.grid_search(matrix, key)), key)
            write("learning_curve", TU.learning_curve(matrix, key, MATRIX_NUMERIC))
            write("ablation_study", TU.ablation(matrix, key, MATRIX_NUMERIC))
            write("complexity_sweep", TU.complexity_sweep(matrix, key, MATRIX_NUMERIC))
        tables["comparison"] = write("model_comparison", comparison)
        holdout = write("holdout_scores", EV.holdout_scores(matrix, key))
        write("model_winner", TU.model_winner(holdout, key))
        write("roc_curve", EV.roc_curve(oof, key, "dt").unionByName(EV.roc_curve(oof, key, "knn")))
        write("entity_errors", EV.entity_errors(oof, key))
        write("statistical_tests", EV.model_tests(oof, scores, key))
        write("error_analysis", EV.error_analysis(oof, key))
        data = materialize(ML.model_input(matrix, key), "model_input")
        tree = write("decision_tree", ML.tree_fit(data, key, MODEL_FEATURES))
        tables["importance"] = write("feature_importance", ML.tree_importance(tree, key, MODEL_FEATURES))
        write("permutation_importance", XP.permutation_importance(tree, data, key, MODEL_FEATURES))
        write("shap_importance", XP.mean_abs_shap(XP.shapley_values(tree, data, key, MODEL_FEATURES), key))
        write("local_explanations", XP.local_explanations(tree, data, key, MODEL_FEATURES))
        tables["clusters"] = write("driver_clusters", ML.labelled_clusters(data, key, MODEL_FEATURES))
    findings = write("findings", INS.race_findings(spark, tables, key))
    write("race_top5", INS.top5(findings, key))
    write("race_conclusions", INS.conclusions(findings, key))
    write("driver_stats", store.driver_stats(matrix, stability, tables.get("clusters"), key))
    write("race_summary", store.race_summary(tables["overview"], key))
    # The switch: until this entry is there, readers see what they saw before.
    store.mark_processed(spark, ledger, races, "complete", key, run)
    for p in paths.values():
        store.drop_superseded(spark, p, races, run, key)
    paths["processed_races"] = ledger
    return paths


def _with_earlier_files(spark: SparkSession, raw_laps: DataFrame, stored: str, ledger: str, key: list[str]) -> DataFrame:
    """``raw_laps`` and the stored rows of the same races from files that it does not hold: a late file joins its race."""
    old = store.read_table(spark, stored, ledger, key)
    if old is None or "source_file" not in old.columns:
        return raw_laps
    given = raw_laps.select(*key, "source_file").distinct()
    kept = old.join(given.select(*key).distinct(), key, "left_semi").join(given, key + ["source_file"], "left_anti")
    return materialize(raw_laps.unionByName(kept, allowMissingColumns=True), "raw_laps")


def compare(spark: SparkSession, out_dir: str, driver1: str, driver2: str, key: Sequence[str] = KEY) -> DataFrame:
    """Entry 3: side-by-side comparison of two drivers from the stored profiles."""
    out = out_dir.rstrip("/")
    profiles = store.read_table(spark, f"{out}/driver_profiles", f"{out}/processed_races", key)
    if profiles is None:
        raise ValueError(f"no races have been processed in {out}")
    return A.compare_two(profiles, driver1, driver2, key)
