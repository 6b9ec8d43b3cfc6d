"""Diagnostics tables: long metrics, ranked and categorised importance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.functions.domain import feature_category

# metric label -> column of an evaluation row
METRIC_ROWS = {
    "Accuracy": "accuracy", "Precision": "precision", "Recall": "recall", "F1 Score": "f1",
    "ROC AUC": "roc_auc", "PR AUC": "pr_auc", "True Negative": "tn", "False Positive": "fp",
    "False Negative": "fn", "True Positive": "tp",
}


def training_samples(metrics: DataFrame, specs: DataFrame | None) -> int:
    """Rows of the specifications, or the confusion total where they are unavailable."""
    if specs is not None:
        return specs.count()
    return metrics.select(F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).first()[0]


def metrics_long(
    metrics: DataFrame,
    specs: DataFrame | None = None,
    importance: DataFrame | None = None,
    algorithm: str = P.ALGORITHM_NAME,
    model_version: str = P.MODEL_VERSION,
    search: str = P.SEARCH_NAME,
    folds: int = P.TRAIN.folds,
    stamped_at: Column | None = None,
) -> DataFrame:
    """(Metric, Value, Algorithm, Prediction Timestamp, Model Version), twelve metric rows and two search rows.

    ``metrics`` is one evaluation row; values are strings because counts, scores and names share the column.
    """
    counts = {
        "Training Samples": F.lit(training_samples(metrics, specs)).cast("long"),
        "Engineered Features": F.lit(importance.count() if importance is not None else 0).cast("long"),
    }
    cells = {label: F.col(column) for label, column in METRIC_ROWS.items()} | counts
    melted = metrics.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("Metric"), cell.cast("string").alias("Value")) for label, cell in cells.items()
    ])))
    search_rows = metrics.select(F.inline(F.array(
        F.struct(F.lit("Hyperparameter Search").alias("Metric"), F.lit(search).alias("Value")),
        F.struct(F.lit("CV Folds").alias("Metric"), F.lit(str(folds)).alias("Value")),
    )))
    return melted.unionByName(search_rows).withColumns({
        "Algorithm": F.lit(algorithm),
        "Prediction Timestamp": F.current_timestamp() if stamped_at is None else stamped_at,
        "Model Version": F.lit(model_version),
    })


def rank_importance(importance: DataFrame) -> DataFrame:
    """Dense ranks by falling importance, ties by name. One row per feature column, so the order is bounded."""
    order = W.orderBy(F.col("importance").desc(), F.col("feature"))
    return importance.select("feature", "importance", F.row_number().over(order).alias("rank"))


def importance_table(importance: DataFrame) -> DataFrame:
    """Re-ranked importance with dashboard names and categories."""
    return rank_importance(importance).select(
        F.col("feature").alias("Feature"), F.col("importance").alias("Importance"), F.col("rank").alias("Rank"),
        feature_category(F.col("feature")).alias("Category"),
    )


def top_features(ranked: DataFrame, k: int = 20) -> DataFrame:
    rank = "Rank" if "Rank" in ranked.columns else "rank"
    return ranked.orderBy(rank).limit(k)
