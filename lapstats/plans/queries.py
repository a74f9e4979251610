"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the given tables through a lap adapter, runs one library
operator over all races at once and normalises the output edge (doubles
rounded to 6 dp, integers as bigint) so it can be compared with its DuckDB
twin in ``oracle_sql.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lapstats.functions.output import finalize
from lapstats.session import materialize
from lapstats.operators import analysis as A
from lapstats.operators.clean import clean_laps
from lapstats.sources.adapters import laps_from_events, laps_from_lineitem

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: finalize(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned adapter-A laps. The raw lap table and the cleaned one are each
    written once (as a lap store would be) so every operator downstream reads a
    Parquet leaf instead of recomputing the adapter and the cleaning."""
    return materialize(clean_laps(materialize(laps_from_events(spark, sf_dir), "laps")), "clean")


def clean_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned adapter-B laps over the written raw ones: tags and fills are made again by each operator for the
    columns that it reads, which costs less than writing every lap a second time."""
    return clean_laps(materialize(laps_from_lineitem(spark, sf_dir), "laps"))


@register("driver_stability")
def q_driver_stability(spark, sf_dir):
    """A9 + W2 on adapter A (flagship)."""
    return A.driver_stability(clean_events(spark, sf_dir))


@register("driver_stability_bulk")
def q_driver_stability_bulk(spark, sf_dir):
    """A9 + W2 on adapter B (order lines)."""
    return A.driver_stability(clean_lineitem(spark, sf_dir))


from lapstats.operators import features as FE  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

_LAP_OUT = ["season", "race_name", "driver", "lap_number", "lap_time", "compound", "team", "track_status_label",
            "is_sc_lap", "is_pit_lap", "is_outlier", "air_temp", "track_temp", "humidity"]


@register("clean_laps")
def q_clean_laps(spark, sf_dir):
    """Cleaned and tagged laps."""
    return clean_events(spark, sf_dir).select(*_LAP_OUT)


@register("lap_features")
def q_lap_features(spark, sf_dir):
    """W1 stint lap, P16 sector sum, P15 normalised track temperature."""
    laps = clean_events(spark, sf_dir)
    df = FE.minmax_normalize(FE.sector_sum(FE.stint_lap(laps)), "track_temp", "norm_track_temp")
    return df.select("season", "race_name", "driver", "lap_number", "stint_lap", "sector_sum", "norm_track_temp")


@register("pit_stop_details")
def q_pit_stop_details(spark, sf_dir):
    """W3 + A15 per pit lap."""
    return A.pit_stop_details(clean_events(spark, sf_dir))


@register("pit_stop_analysis")
def q_pit_stop_analysis(spark, sf_dir):
    """A15 per driver + race average + A33 pit total."""
    return A.pit_stop_analysis(clean_events(spark, sf_dir))


@register("pit_driver_means")
def q_pit_driver_means(spark, sf_dir):
    """A29."""
    return A.pit_driver_means(clean_events(spark, sf_dir))


@register("driver_features")
def q_driver_features(spark, sf_dir):
    """A1, A2, A5, A6, A14 per driver."""
    return FE.driver_features(clean_events(spark, sf_dir))


@register("driver_features_bulk")
def q_driver_features_bulk(spark, sf_dir):
    """Same on adapter B."""
    return FE.driver_features(clean_lineitem(spark, sf_dir))


@register("degradation_rates")
def q_degradation_rates(spark, sf_dir):
    """A3 per (driver, compound) on adapter B."""
    return FE.degradation_rates(clean_lineitem(spark, sf_dir))


@register("tire_efficiency")
def q_tire_efficiency(spark, sf_dir):
    """A4 per compound."""
    return FE.tire_efficiency(clean_events(spark, sf_dir))


@register("driver_matrix")
def q_driver_matrix(spark, sf_dir):
    """A7 + A8 + P17: model feature matrix."""
    return FE.driver_matrix(clean_events(spark, sf_dir))


@register("driver_matrix_bulk")
def q_driver_matrix_bulk(spark, sf_dir):
    """Same on adapter B."""
    return FE.driver_matrix(clean_lineitem(spark, sf_dir))


@register("strong_performance")
def q_strong_performance(spark, sf_dir):
    """P19 target over the matrix."""
    m = FE.strong_performance(materialize(FE.driver_matrix(clean_events(spark, sf_dir))))
    return m.select("season", "race_name", "driver", "average_lap_time", "consistency_score", "strong_performance")


@register("fast_only")
def q_fast_only(spark, sf_dir):
    """P20 target over the matrix."""
    return FE.fast_only(materialize(FE.driver_matrix(clean_events(spark, sf_dir)), "matrix")).select(
        "season", "race_name", "driver", "average_lap_time", "fast_only")


@register("compound_stats")
def q_compound_stats(spark, sf_dir):
    """A10."""
    return A.compound_stats(clean_events(spark, sf_dir))


@register("tyre_age_curve")
def q_tyre_age_curve(spark, sf_dir):
    """A11."""
    return A.tyre_age_curve(clean_events(spark, sf_dir))


@register("strategy_map")
def q_strategy_map(spark, sf_dir):
    """A12."""
    return A.strategy_map(clean_events(spark, sf_dir))


@register("degradation_curve")
def q_degradation_curve(spark, sf_dir):
    """A13 on adapter B."""
    return A.degradation_curve(clean_lineitem(spark, sf_dir))


@register("degradation_ages")
def q_degradation_ages(spark, sf_dir):
    """A13 points on adapter B."""
    return A.degradation_ages(clean_lineitem(spark, sf_dir))


@register("race_overview")
def q_race_overview(spark, sf_dir):
    """A17."""
    return A.race_overview(clean_events(spark, sf_dir))


@register("compound_usage")
def q_compound_usage(spark, sf_dir):
    """A17 / A21 compound counts."""
    return A.compound_usage(clean_events(spark, sf_dir))


@register("driver_profiles")
def q_driver_profiles(spark, sf_dir):
    """A18."""
    return A.driver_profiles(FE.lap_features(clean_events(spark, sf_dir)))


@register("driver_vs_leader")
def q_driver_vs_leader(spark, sf_dir):
    """J10 + I12: each driver against the race's most stable driver."""
    laps = clean_events(spark, sf_dir)
    return A.compare_with_leader(A.driver_profiles(FE.lap_features(laps)), A.driver_stability(laps))


@register("fastest_sector_drivers")
def q_fastest_sector_drivers(spark, sf_dir):
    """A31."""
    return A.fastest_sector_drivers(clean_events(spark, sf_dir))


@register("fastest_lap_per_driver")
def q_fastest_lap_per_driver(spark, sf_dir):
    """A32."""
    return A.fastest_lap_per_driver(clean_events(spark, sf_dir))


@register("weather_correlation")
def q_weather_correlation(spark, sf_dir):
    """A16 + T5."""
    return A.weather_correlation(clean_events(spark, sf_dir))


from lapstats.operators import profile as PR  # noqa: E402
from lapstats.schema import LAPS, MATRIX_NUMERIC  # noqa: E402

RAW_COLUMNS = [c for c in LAPS.fieldNames() if c not in ("season", "race_name")]


@register("basic_summary")
def q_basic_summary(spark, sf_dir):
    """A19."""
    return PR.basic_summary(clean_events(spark, sf_dir).select(*LAPS.fieldNames(), "is_sc_lap", "is_pit_lap",
                                                               "is_outlier", "track_status_label"))


@register("missing_values")
def q_missing_values(spark, sf_dir):
    """A20 over the raw lap columns of the (unfilled) adapter laps."""
    return PR.missing_values(laps_from_events(spark, sf_dir), columns=RAW_COLUMNS)


@register("laps_per_driver")
def q_laps_per_driver(spark, sf_dir):
    """A21."""
    return PR.laps_per_driver(clean_events(spark, sf_dir))


@register("lap_time_distribution")
def q_lap_time_distribution(spark, sf_dir):
    """A22."""
    return PR.lap_time_distribution(clean_events(spark, sf_dir))


@register("lap_time_histogram")
def q_lap_time_histogram(spark, sf_dir):
    """A23."""
    return PR.lap_time_histogram(clean_events(spark, sf_dir))


@register("temperature_summary")
def q_temperature_summary(spark, sf_dir):
    """A24."""
    return PR.temperature_summary(clean_events(spark, sf_dir))


def _lap_corr(spark, sf_dir):
    feats = FE.lap_features(clean_events(spark, sf_dir))
    return PR.correlation_matrix(feats, PR.LAP_CORR_COLUMNS)


@register("lap_correlations")
def q_lap_correlations(spark, sf_dir):
    """A25 correlation matrix of the lap feature table (upper triangle, long form)."""
    return _lap_corr(spark, sf_dir)


@register("lap_time_correlations")
def q_lap_time_correlations(spark, sf_dir):
    """A25 ranking of |r| against lap time."""
    return PR.lap_time_correlations(_lap_corr(spark, sf_dir))


def _feat_corr(spark, sf_dir):
    m = FE.driver_matrix(clean_lineitem(spark, sf_dir))
    return PR.correlation_matrix(m, MATRIX_NUMERIC)


@register("feature_correlations")
def q_feature_correlations(spark, sf_dir):
    """A26 over the median-imputed driver matrix (adapter B)."""
    return _feat_corr(spark, sf_dir)


@register("high_correlation_pairs")
def q_high_correlation_pairs(spark, sf_dir):
    """Pairs with |r| > 0.7."""
    return PR.high_correlation_pairs(_feat_corr(spark, sf_dir))


@register("preprocessing_summary")
def q_preprocessing_summary(spark, sf_dir):
    """A27."""
    return PR.preprocessing_summary(clean_events(spark, sf_dir), columns=RAW_COLUMNS)


@register("temperature_trend")
def q_temperature_trend(spark, sf_dir):
    """A28."""
    return PR.temperature_trend(clean_events(spark, sf_dir))


from lapstats.operators import evaluate as EV  # noqa: E402
from lapstats.operators import ml as ML  # noqa: E402
from lapstats.schema import KEY, MODEL_FEATURES  # noqa: E402


def _target_matrix(spark, sf_dir):
    """Driver matrix with the strong_performance label, checkpointed."""
    return materialize(FE.strong_performance(materialize(FE.driver_matrix(clean_events(spark, sf_dir)), "matrix")),
                       "target")


def _folds(spark, sf_dir):
    return ML.assign_folds(ML.model_input(_target_matrix(spark, sf_dir), KEY), KEY)


@register("cv_folds")
def q_cv_folds(spark, sf_dir):
    """Standardised model input with stratified fold numbers."""
    return _folds(spark, sf_dir)


def _knn_oof(spark, sf_dir):
    data = materialize(_folds(spark, sf_dir), "folds")
    train, test = ML.fold_sets(data, KEY)
    kf = list(KEY) + ["cv_fold"]
    kv = ML.knn_classify(train, test, kf, MODEL_FEATURES, k=5).select(
        *kf, "driver", F.col("pred").alias("pred_knn"), F.col("proba").alias("proba_knn"))
    return (test.select(*kf, "driver", "label", "fold", "n_folds").join(kv, kf + ["driver"], "left")
            .drop("cv_fold"))


@register("knn_oof")
def q_knn_oof(spark, sf_dir):
    """M9 + M14: exact 5-NN out-of-fold predictions (uniform vote)."""
    return _knn_oof(spark, sf_dir)


@register("knn_fold_scores")
def q_knn_fold_scores(spark, sf_dir):
    """M12, kNN alone: per-fold accuracy and macro precision / recall / F1."""
    return EV.fold_scores(materialize(_knn_oof(spark, sf_dir), "knn_oof"), KEY, models=("knn",))


@register("knn_errors")
def q_knn_errors(spark, sf_dir):
    """M15 + M20, kNN alone: confusion counts, error rates and AUC."""
    oof = materialize(_knn_oof(spark, sf_dir), "knn_oof")
    return EV.error_analysis(oof, KEY, models=("knn",)).join(EV.auc(oof, KEY, "proba_knn"), list(KEY), "left")


@register("knn_roc")
def q_knn_roc(spark, sf_dir):
    """M15, kNN alone: ROC points from the first threshold on, and whether a point is Youden's best."""
    roc = materialize(EV.roc_curve(materialize(_knn_oof(spark, sf_dir), "knn_oof"), KEY, "knn"), "roc")
    best = EV.best_threshold(roc, KEY).select(*KEY, "best_threshold")
    return (roc.where(F.col("threshold") < float("inf")).join(best, list(KEY))
            .withColumn("is_best", F.col("threshold") == F.col("best_threshold")).drop("best_threshold"))


@register("knn_holdout")
def q_knn_holdout(spark, sf_dir):
    """M9 on the hold-out split: accuracy, confusion and class report of kNN."""
    return EV.holdout_scores(_target_matrix(spark, sf_dir), KEY, models=("knn",))


@register("holdout_scores")
def q_holdout_scores(spark, sf_dir):
    """M8 + M9: hold-out accuracy, confusion and class report of both models."""
    return EV.holdout_scores(_target_matrix(spark, sf_dir), KEY)


def _oof(spark, sf_dir):
    return EV.cross_validate(_target_matrix(spark, sf_dir), KEY)


@register("cv_oof")
def q_cv_oof(spark, sf_dir):
    """M12 + M14: out-of-fold predictions of the tree and kNN."""
    return _oof(spark, sf_dir)


@register("cv_fold_scores")
def q_cv_fold_scores(spark, sf_dir):
    """Per-fold accuracy and macro precision / recall / F1 of both models."""
    return EV.fold_scores(_oof(spark, sf_dir), KEY)


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    """CV mean / std, macro metrics, training accuracy and gap, AUC, grid search's best, rules, best model."""
    target = _target_matrix(spark, sf_dir)
    oof, on_training_rows = EV.cross_validate_fitted(target, KEY)
    summary = EV.cv_summary(materialize(EV.fold_scores(oof, KEY), "scores"), oof, KEY, on_training_rows())
    return EV.comparison_table(summary, materialize(TU.grid_search(target, KEY), "grid"), KEY)


@register("roc_curve")
def q_roc_curve(spark, sf_dir):
    """ROC points of both models."""
    oof = _oof(spark, sf_dir)
    return EV.roc_curve(oof, KEY, "dt").unionByName(EV.roc_curve(oof, KEY, "knn"))


@register("error_analysis")
def q_error_analysis(spark, sf_dir):
    """Confusion counts and error rates."""
    return EV.error_analysis(_oof(spark, sf_dir), KEY)


@register("entity_errors")
def q_entity_errors(spark, sf_dir):
    """Per-driver correctness and common errors."""
    return EV.entity_errors(_oof(spark, sf_dir), KEY)


@register("model_tests")
def q_model_tests(spark, sf_dir):
    """McNemar, paired t, Wilcoxon and the vote."""
    oof = _oof(spark, sf_dir)
    return EV.model_tests(oof, materialize(EV.fold_scores(oof, KEY), "scores"), KEY)


@register("tree_importance")
def q_tree_importance(spark, sf_dir):
    """M8 + M23: per-race tree on all drivers, impurity importances."""
    data = ML.model_input(_target_matrix(spark, sf_dir), KEY)
    tree = ML.tree_fit(data, KEY, MODEL_FEATURES)
    return ML.tree_importance(tree, KEY, MODEL_FEATURES)


KMEANS_FEATURES = ["average_lap_time", "consistency_score", "tire_degradation_rate", "pit_stop_impact",
                   "sector_consistency"]


def _kmeans_points(spark, sf_dir):
    m = FE.driver_matrix(clean_lineitem(spark, sf_dir))
    return materialize(ML.model_input(m.withColumn("strong_performance", F.lit(0)), KEY, KMEANS_FEATURES), "km_pts")


@register("kmeans_clusters")
def q_kmeans_clusters(spark, sf_dir):
    """M1 + M3: K-Means (k=3) per race on the scaled features, labelled clusters."""
    return ML.labelled_clusters(_kmeans_points(spark, sf_dir), KEY, KMEANS_FEATURES)


@register("kmeans_elbow")
def q_kmeans_elbow(spark, sf_dir):
    """M2 + M4: inertia and squared-Euclidean silhouette for k = 2..7."""
    pts = _kmeans_points(spark, sf_dir)
    ks = range(2, 8)
    out = None
    # A race needs more rows than clusters.
    for k, (assign, _) in zip(ks, ML.kmeans_runs(pts, KEY, KMEANS_FEATURES, [(k, "distance") for k in ks], more_rows=True)):
        assign = materialize(assign, "km_assign")
        r = (ML.inertia(assign, KEY).join(ML.silhouette_sq(pts, assign, KEY, KMEANS_FEATURES), list(KEY))
             .withColumn("k", F.lit(k)))
        out = r if out is None else out.unionByName(r)
    return out


from lapstats.operators import joins as J  # noqa: E402
from lapstats.sources.adapters import weather_from_events  # noqa: E402

_WEATHERLESS = ["season", "race_name", "driver", "lap_number", "time_s"]


@register("weather_mean_attach")
def q_weather_mean_attach(spark, sf_dir):
    """Race-mean weather attached to laps that carry none."""
    laps = laps_from_events(spark, sf_dir).select(*_WEATHERLESS)
    return J.attach_weather_mean(laps, weather_from_events(spark, sf_dir))


@register("weather_asof")
def q_weather_asof(spark, sf_dir):
    """Nearest-in-time weather sample attached to each lap."""
    laps = laps_from_events(spark, sf_dir).select(*_WEATHERLESS)
    return J.attach_weather_asof(laps, weather_from_events(spark, sf_dir))


from lapstats.operators import insights as INS  # noqa: E402


def _analysis_tables(spark, sf_dir, with_ml: bool = False):
    laps = clean_events(spark, sf_dir)
    t = {
        "stability": A.driver_stability(laps),
        "compound_stats": A.compound_stats(laps),
        "degradation_curve": A.degradation_curve(laps),
        "pit": A.pit_stop_analysis(laps),
        "overview": A.race_overview(laps),
        "weather": A.weather_correlation(laps),
        "sectors": A.fastest_sector_drivers(laps),
    }
    if with_ml:
        target = _target_matrix(spark, sf_dir)
        data = ML.model_input(target, KEY)
        t["importance"] = ML.tree_importance(ML.tree_fit(data, KEY, MODEL_FEATURES), KEY, MODEL_FEATURES)
        oof = EV.cross_validate(target, KEY)
        t["comparison"] = EV.cv_summary(materialize(EV.fold_scores(oof, KEY), "scores"), oof, KEY)
        t["clusters"] = ML.labelled_clusters(materialize(ML.model_input(target, KEY, KMEANS_FEATURES), "km_pts"),
                                             KEY, KMEANS_FEATURES)
    return t


@register("race_findings")
def q_race_findings(spark, sf_dir):
    """Findings table from the per-race analyses."""
    return INS.race_findings(spark, _analysis_tables(spark, sf_dir))


@register("race_top5")
def q_race_top5(spark, sf_dir):
    """I8: top findings per race, the ML one among them."""
    return INS.top5(INS.race_findings(spark, _analysis_tables(spark, sf_dir, with_ml=True)))


@register("race_conclusions")
def q_race_conclusions(spark, sf_dir):
    """I5 + I10: findings including the ML ones, one conclusion row per race."""
    return INS.conclusions(INS.race_findings(spark, _analysis_tables(spark, sf_dir, with_ml=True)))


@register("pit_rating")
def q_pit_rating(spark, sf_dir):
    """Pit rating per driver."""
    return INS.pit_rating(A.pit_stop_analysis(clean_events(spark, sf_dir)))


from lapstats.operators import tuning as TU  # noqa: E402


@register("grid_search")
def q_grid_search(spark, sf_dir):
    """M13 + W5: inner-CV score of every tree and kNN configuration, ranked."""
    return TU.grid_search(_target_matrix(spark, sf_dir), KEY)


@register("complexity_sweep")
def q_complexity_sweep(spark, sf_dir):
    """M19 over every numeric matrix column: depth and k sweeps with train / validation gap."""
    return TU.complexity_sweep(_target_matrix(spark, sf_dir), KEY, MATRIX_NUMERIC)


@register("ablation_study")
def q_ablation_study(spark, sf_dir):
    """M18 over every numeric matrix column: drop-one-feature accuracy deltas."""
    return TU.ablation(_target_matrix(spark, sf_dir), KEY, MATRIX_NUMERIC)


@register("learning_curve")
def q_learning_curve(spark, sf_dir):
    """M17 over every numeric matrix column: learning curves of the depth-3 tree and 3-NN."""
    return TU.learning_curve(_target_matrix(spark, sf_dir), KEY, MATRIX_NUMERIC)


@register("holdout_split")
def q_holdout_split(spark, sf_dir):
    """M7: stratified hold-out assignment."""
    return TU.holdout_split(ML.model_input(_target_matrix(spark, sf_dir), KEY), KEY)


@register("kmeans_grid")
def q_kmeans_grid(spark, sf_dir):
    """M5: K-Means grid ranked by silhouette."""
    return TU.kmeans_grid(_kmeans_points(spark, sf_dir), KEY, KMEANS_FEATURES)


from lapstats.operators import explain as XP  # noqa: E402


def _fitted(spark, sf_dir):
    data = materialize(ML.model_input(_target_matrix(spark, sf_dir), KEY), "model_input")
    return data, ML.tree_fit(data, KEY, MODEL_FEATURES)


@register("permutation_importance")
def q_permutation_importance(spark, sf_dir):
    """Accuracy drop per shuffled feature (30 repeats)."""
    data, tree = _fitted(spark, sf_dir)
    return XP.permutation_importance(tree, data, KEY, MODEL_FEATURES)


@register("shap_importance")
def q_shap_importance(spark, sf_dir):
    """Mean |Shapley value| per feature, path-dependent."""
    data, tree = _fitted(spark, sf_dir)
    return XP.mean_abs_shap(XP.shapley_values(tree, data, KEY, MODEL_FEATURES), KEY)


@register("local_explanations")
def q_local_explanations(spark, sf_dir):
    """Per-driver prediction record."""
    data, tree = _fitted(spark, sf_dir)
    return XP.local_explanations(tree, data, KEY, MODEL_FEATURES)


@register("pca_projection")
def q_pca_projection(spark, sf_dir):
    """M6: 2-D PCA coordinates of every driver, with the explained variance ratios of the race."""
    pts, comps = XP.pca_2d(_kmeans_points(spark, sf_dir), KEY, KMEANS_FEATURES)
    ratio = lambda c: F.max(F.when(F.col("component") == c, F.col("explained_variance_ratio")))
    explained = comps.groupBy(*KEY).agg(ratio(1).alias("explained_1"), ratio(2).alias("explained_2"))
    return pts.join(explained, list(KEY), "left")


@register("model_winner")
def q_model_winner(spark, sf_dir):
    """Winning model per race, by hold-out accuracy."""
    return TU.model_winner(EV.holdout_scores(_target_matrix(spark, sf_dir), KEY), KEY)
