"""Fold-level selection and metrics (J11, J13, J15) shared by training and fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.plans.evaluate import regression_metrics


def select_best(scores: DataFrame, fold_col: str = "walk_forward_fold") -> DataFrame:
    """Per fold the model with the lowest validation MAE (ties: earlier config order).

    ``scores``: (fold, model, model_order, mae, ...)."""
    return scores.groupBy(fold_col).agg(
        F.min_by(F.struct("model", "mae"), F.struct("mae", "model_order")).alias("_b")).select(
        fold_col, F.col("_b.model").alias("best_model"), F.col("_b.mae").alias("validation_mae"))


def fold_metrics(test_predictions: DataFrame, windows: DataFrame, best: DataFrame,
                 experiment_id: str, fold_col: str = "walk_forward_fold") -> DataFrame:
    """One row per fold: winner, MAE/RMSE/R2 on its test rows (R2 = 0 at n <= 1),
    sizes, time ranges and the metrics as JSON."""
    m = regression_metrics(test_predictions, "actual_pnl", "predicted_pnl", by=[fold_col], r2_single=0.0)
    out = (m.join(best.select(fold_col, "best_model"), fold_col)
            .join(windows, fold_col))
    return out.select(
        F.col(fold_col).alias("fold"), "best_model", "mae", "rmse", "r2", "train_size", "test_size",
        "train_start", "train_end", "test_start", "test_end",
        F.to_json(F.struct("mae", "rmse", "r2")).alias("metrics"),
        F.lit(experiment_id).alias("experiment_id"))


def training_summary(fold_results: DataFrame) -> DataFrame:
    """Mean MAE/RMSE/R2, population std of MAE, folds, how often each model won, and the most
    frequent winner (ties: the one that won first)."""
    wins = fold_results.groupBy("best_model").agg(F.count(F.lit(1)).alias("_w"), F.min("fold").alias("_f"))
    top = wins.agg(F.min_by("best_model", F.struct(-F.col("_w"), "_f")).alias("most_selected_model"),
                   F.to_json(F.map_from_entries(F.transform(
                       F.array_sort(F.collect_list(F.struct("_f", "best_model", "_w"))),     # one entry per model
                       lambda w: F.struct(w["best_model"], w["_w"])))).alias("model_selection_counts"))
    s = fold_results.agg(F.count(F.lit(1)).alias("folds"), F.avg("mae").alias("mean_mae"),
                         F.stddev_pop("mae").alias("std_mae"), F.avg("rmse").alias("mean_rmse"),
                         F.avg("r2").alias("mean_r2"))
    return s.join(top, how="inner", on=F.lit(True))  # one-row frames
