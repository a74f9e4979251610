"""Model evaluation (M12-M21) and the significance tests wired to it.

``cross_validate`` trains the decision tree and kNN for every (race, fold)
in one pass each and returns the out-of-fold table; all metrics below are
aggregates of that table, keyed by race.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapstats.functions.ranking import running_sums
from lapstats.operators import ml
from lapstats.operators import significance as S
from lapstats.operators import tuning
from lapstats.schema import MODEL_FEATURES
from lapstats.session import materialize

MODELS = ("dt", "knn")
#: The hold-out models also see the two temperatures.
HOLDOUT_FEATURES = MODEL_FEATURES + ("air_temp", "track_temp")
# ---- fixed values: margins of the comparison rules ----
AUC_MARGIN, OVERFIT_GAP = 0.05, 0.15
MODEL_NAMES = {"dt": "Decision Tree", "knn": "kNN"}


def cross_validate(matrix: DataFrame, key: Sequence[str], features: Sequence[str] = MODEL_FEATURES,
                   n_splits: int = 5, k: int = 5, max_depth: int = 5, metric: str = "euclidean",
                   weights: str = "uniform", label: str = "strong_performance") -> DataFrame:
    """M12 + M14: out-of-fold predictions of both models.

    Returns key, driver, label, fold, n_folds, pred_dt, proba_dt, pred_knn, proba_knn.
    """
    return cross_validate_fitted(matrix, key, features, n_splits, k, max_depth, metric, weights, label)[0]


def cross_validate_fitted(matrix: DataFrame, key: Sequence[str], features: Sequence[str] = MODEL_FEATURES,
                          n_splits: int = 5, k: int = 5, max_depth: int = 5, metric: str = "euclidean",
                          weights: str = "uniform", label: str = "strong_performance") -> tuple[DataFrame, Callable]:
    """The table of ``cross_validate``, and a function that gives the same models' accuracy on their own
    training rows: key, fold, train_acc_dt, train_acc_knn."""
    key = list(key)
    data = materialize(ml.assign_folds(ml.model_input(matrix, key, features, label), key, n_splits), "cv_data")
    train, test = ml.fold_sets(data, key)
    kf = key + ["cv_fold"]
    kv = ml.knn_classify(train, test, kf, features, k, metric, weights).select(
        *kf, "driver", F.col("pred").alias("pred_knn"), F.col("proba").alias("proba_knn"))
    tree = ml.tree_fit(train, kf, features, max_depth=max_depth)
    tp = ml.tree_predict(tree, test, kf, features).select(
        *kf, "driver", F.col("pred").alias("pred_dt"), F.col("proba").alias("proba_dt"))
    oof = (test.select(*kf, "driver", "label", "fold", "n_folds")
           .join(tp, kf + ["driver"], "left").join(kv, kf + ["driver"], "left").drop("cv_fold"))

    def on_training_rows() -> DataFrame:
        own = tuning.accuracy(ml.tree_predict(tree, train, kf, features), train, kf)
        knn = tuning.accuracy(ml.knn_classify(train, train, kf, features, k, metric, weights), train, kf)
        return materialize(own.withColumnRenamed("acc", "train_acc_dt")
                           .join(knn.withColumnRenamed("acc", "train_acc_knn"), kf)
                           .withColumnRenamed("cv_fold", "fold"), "cv_train")

    return materialize(oof, "cv_oof"), on_training_rows


def fold_scores(oof: DataFrame, key: Sequence[str], models: Sequence[str] = MODELS) -> DataFrame:
    """Per (race, fold): accuracy and macro precision / recall / F1 of each model.

    Macro averages run over the classes present in the fold's labels or
    predictions; an undefined precision or recall counts as 0.
    """
    key = list(key)
    out = None
    for m in models:
        p = F.col(f"pred_{m}")
        classes = oof.select(*key, "fold", F.col("label").alias("_c")).unionByName(
            oof.select(*key, "fold", p.alias("_c"))).distinct()
        j = oof.join(classes, key + ["fold"])
        per = j.groupBy(*key, "fold", "_c").agg(
            F.count_if((p == F.col("_c")) & (F.col("label") == F.col("_c"))).alias("_tp"),
            F.count_if(p == F.col("_c")).alias("_pp"), F.count_if(F.col("label") == F.col("_c")).alias("_ap"))
        prec = F.coalesce(F.try_divide(F.col("_tp"), F.col("_pp")), F.lit(0.0))
        rec = F.coalesce(F.try_divide(F.col("_tp"), F.col("_ap")), F.lit(0.0))
        f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
        macro = per.groupBy(*key, "fold").agg(F.avg(prec).alias(f"precision_{m}"), F.avg(rec).alias(f"recall_{m}"),
                                              F.avg(f1).alias(f"f1_{m}"))
        acc = oof.groupBy(*key, "fold").agg(F.avg((p == F.col("label")).cast("double")).alias(f"acc_{m}"))
        part = acc.join(macro, key + ["fold"])
        out = part if out is None else out.join(part, key + ["fold"])
    return out


def auc(oof: DataFrame, key: Sequence[str], score: str) -> DataFrame:
    """Area under ROC = Mann-Whitney statistic with average ranks (exact, tie-aware)."""
    key = list(key)
    per = oof.where(F.col(score).isNotNull()).groupBy(*key, score).agg(
        F.count_if(F.col("label") == 1).alias("_c1"), F.count_if(F.col("label") == 0).alias("_c0"),
        F.count("*").alias("_c"))
    # Rows of one score share the mean of their ranks: the last rank less half the others.
    r = running_sums(per, key, [F.col(score)], {"_last": "_c"})
    g = r.groupBy(*key).agg(F.sum("_c1").alias("_n1"), F.sum("_c0").alias("_n0"),
                            F.sum(F.when(F.col("_c1") > 0, F.col("_c1") * (F.col("_last") - (F.col("_c") - 1) / 2.0)))
                            .alias("_s1"))
    return g.select(*key, F.try_divide(F.col("_s1") - F.col("_n1") * (F.col("_n1") + 1) / 2.0,
                                       F.col("_n1") * F.col("_n0")).alias("auc"))


def roc_curve(oof: DataFrame, key: Sequence[str], model: str) -> DataFrame:
    """ROC points at every distinct threshold (desc) with TPR, FPR and Youden J.

    The curve starts at (0, 0), whose threshold is infinite.
    """
    key = list(key)
    s = f"proba_{model}"
    per = oof.where(F.col(s).isNotNull()).groupBy(*key, F.col(s).alias("threshold")).agg(
        F.count_if(F.col("label") == 1).alias("_tp"), F.count_if(F.col("label") == 0).alias("_fp"))
    start = per.select(*key).distinct().select(*key, F.lit(float("inf")).alias("threshold"),
                                               F.lit(0).cast("long").alias("_tp"), F.lit(0).cast("long").alias("_fp"))
    per = per.unionByName(start)
    c = running_sums(per, key, [F.desc("threshold")], {"_ctp": "_tp", "_cfp": "_fp"},
                     totals={"_p": "_tp", "_n": "_fp"})
    return c.select(*key, F.lit(model).alias("model"), "threshold",
                    F.try_divide(F.col("_ctp"), F.col("_p")).alias("tpr"),
                    F.try_divide(F.col("_cfp"), F.col("_n")).alias("fpr"),
                    (F.coalesce(F.try_divide(F.col("_ctp"), F.col("_p")), F.lit(0.0))
                     - F.coalesce(F.try_divide(F.col("_cfp"), F.col("_n")), F.lit(0.0))).alias("youden_j"))


def best_threshold(roc: DataFrame, key: Sequence[str]) -> DataFrame:
    """Youden-optimal threshold per key and model (first, i.e. highest, on ties)."""
    return roc.groupBy(*key, "model").agg(
        F.max_by("threshold", F.struct("youden_j", "threshold")).alias("best_threshold"),
        F.max("youden_j").alias("youden_j"))


def cv_summary(scores: DataFrame, oof: DataFrame, key: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """M12 + M16 core: per race and model, mean / population std of fold accuracy,
    mean macro precision / recall / F1, out-of-fold AUC; best model by accuracy.

    With the accuracies on training rows (``train``), also their mean and the overfit gap.
    """
    key = list(key)
    rows = []
    for m in MODELS:
        s = scores.groupBy(*key).agg(
            F.avg(f"acc_{m}").alias("cv_mean_acc"), F.stddev_pop(f"acc_{m}").alias("cv_std"),
            F.avg(f"precision_{m}").alias("cv_precision"), F.avg(f"recall_{m}").alias("cv_recall"),
            F.avg(f"f1_{m}").alias("cv_f1"), F.count("*").alias("n_folds"))
        if train is not None:
            s = s.join(train.groupBy(*key).agg(F.avg(f"train_acc_{m}").alias("train_mean_acc")), key, "left").withColumn(
                "overfit_gap", F.col("train_mean_acc") - F.col("cv_mean_acc"))
        rows.append(s.join(auc(oof, key, f"proba_{m}"), key, "left").withColumn("model", F.lit(MODEL_NAMES[m])))
    t = rows[0].unionByName(rows[1])
    best = t.groupBy(*key).agg(F.max_by("model", F.struct("cv_mean_acc", F.col("model") == MODEL_NAMES["dt"])).alias("_b"))
    return t.join(best, key).withColumn("is_best", F.col("model") == F.col("_b")).drop("_b")


def comparison_table(summary: DataFrame, grid: DataFrame, key: Sequence[str]) -> DataFrame:
    """The summary with the grid search's best score and parameters, and the two rules: which model
    has the clearly higher AUC (by more than 0.05), and whether a model's overfit gap exceeds 0.15."""
    key = list(key)
    best = tuning.best_params(grid, key).withColumnRenamed("best_score", "gs_best_score")
    of = lambda m: F.max(F.when(F.col("model") == MODEL_NAMES[m], F.coalesce("auc", F.lit(0.5))))
    rule = summary.groupBy(*key).agg((of("dt") - of("knn")).alias("_d")).select(*key, F.when(
        F.col("_d") > AUC_MARGIN, F.lit("tree_higher")).when(F.col("_d") < -AUC_MARGIN, F.lit("knn_higher"))
        .otherwise(F.lit("similar")).alias("auc_rule"))
    return (summary.join(best, key + ["model"], "left").join(rule, key, "left")
            .withColumn("overfit_risk", F.col("overfit_gap") > OVERFIT_GAP))


def holdout_scores(matrix: DataFrame, key: Sequence[str], features: Sequence[str] = HOLDOUT_FEATURES, k: int = 5,
                   max_depth: int = 5, models: Sequence[str] = MODELS) -> DataFrame:
    """M8 + M9: both models fitted on the hold-out split's training rows and scored on its test rows.

    Per race and model: rows, accuracy, confusion counts, and precision, recall and F1 of each class (0
    where undefined). A race without test rows has no row.
    """
    key = list(key)
    data = materialize(tuning.holdout_split(ml.model_input(matrix, key, features), key), "holdout")
    train, test = data.where(~F.col("is_test")), data.where("is_test")
    n_train = train.groupBy(*key).agg(F.count("*").alias("n_train"))
    pred = {}
    if "dt" in models:
        pred["dt"] = ml.tree_predict(ml.tree_fit(train, key, features, max_depth=max_depth), test, key, features)
    if "knn" in models:
        pred["knn"] = ml.knn_classify(train, test, key, features, k)
    out = None
    for m, p in pred.items():
        hit = lambda y, yp: F.count_if((F.col("label") == y) & (F.col("pred") == yp))
        c = (test.select(*key, "driver", "label").join(p.select(*key, "driver", "pred"), key + ["driver"]).groupBy(*key)
             .agg(F.count("*").alias("n_test"), hit(0, 0).alias("tn"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"),
                  hit(1, 1).alias("tp")))
        share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
        tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
        c = c.select(*key, F.lit(MODEL_NAMES[m]).alias("model"), "n_test", "tn", "fp", "fn", "tp",
                     ((tn + tp) / F.col("n_test")).alias("accuracy"),
                     share(tn, tn + fn).alias("precision_0"), share(tn, tn + fp).alias("recall_0"),
                     share(2 * tn, 2 * tn + fp + fn).alias("f1_0"), share(tp, tp + fp).alias("precision_1"),
                     share(tp, tp + fn).alias("recall_1"), share(2 * tp, 2 * tp + fp + fn).alias("f1_1"))
        out = c if out is None else out.unionByName(c)
    return n_train.join(out, key)


def error_analysis(oof: DataFrame, key: Sequence[str], high_conf: float = 0.7,
                   models: Sequence[str] = MODELS) -> DataFrame:
    """Per race and model confusion counts and error rate."""
    key = list(key)
    rows = []
    for m in models:
        p = F.col(f"pred_{m}")
        rows.append(oof.groupBy(*key).agg(
            F.lit(MODEL_NAMES[m]).alias("model"),
            F.count_if((p == 1) & (F.col("label") == 1)).alias("tp"), F.count_if((p == 1) & (F.col("label") == 0)).alias("fp"),
            F.count_if((p == 0) & (F.col("label") == 0)).alias("tn"), F.count_if((p == 0) & (F.col("label") == 1)).alias("fn"),
            F.avg((p != F.col("label")).cast("double")).alias("error_rate"),
            F.count_if((p != F.col("label"))
                       & (F.greatest(F.col(f"proba_{m}"), 1 - F.col(f"proba_{m}")) >= high_conf)).alias("high_conf_errors")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def entity_errors(oof: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per driver correctness of both models, error type, both-wrong flag."""
    ok_dt = F.col("pred_dt") == F.col("label")
    ok_knn = F.col("pred_knn") == F.col("label")
    kind = lambda p: F.when(F.col(p) == F.col("label"), F.lit(None)).when(F.col(p) == 1, F.lit("FP")).otherwise(F.lit("FN"))
    return oof.select(*key, "driver", F.col("label").alias("actual"), F.col("pred_dt").alias("predicted_dt"),
                      F.col("pred_knn").alias("predicted_knn"), ok_dt.alias("correct_dt"), ok_knn.alias("correct_knn"),
                      (~ok_dt & ~ok_knn).alias("both_wrong"), kind("pred_dt").alias("error_dt"),
                      kind("pred_knn").alias("error_knn"),
                      F.greatest(F.col("proba_dt"), 1 - F.col("proba_dt")).alias("confidence_dt"),
                      F.greatest(F.col("proba_knn"), 1 - F.col("proba_knn")).alias("confidence_knn"))


def model_tests(oof: DataFrame, scores: DataFrame, key: Sequence[str]) -> DataFrame:
    """T1-T4 on the evaluation outputs: one row per race and test, plus the vote."""
    key = list(key)
    mc = S.mcnemar(oof, key, "label", "pred_dt", "pred_knn")
    sc = scores.select(*key, "fold", F.col("acc_dt").alias("score_a"), F.col("acc_knn").alias("score_b"))
    tt = S.paired_t(sc, key)
    wx = S.wilcoxon(sc, key)
    vote = S.test_vote(mc, tt, wx, key)
    rows = (mc.select(*key, F.lit("mcnemar").alias("test"), F.col("chi2_stat").alias("statistic"), "p_value",
                      "significant")
            .unionByName(tt.select(*key, F.lit("paired_ttest").alias("test"), F.col("t_stat").alias("statistic"),
                                   "p_value", "significant"))
            .unionByName(wx.select(*key, F.lit("wilcoxon").alias("test"), F.col("stat").alias("statistic"),
                                   "p_value", "significant")))
    return rows.join(vote.select(*key, "verdict"), key, "left")
