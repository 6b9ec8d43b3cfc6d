"""Model evaluation as relations: confusion counts, ranking metrics, reports, threshold sweep, model comparison.

Input rows carry an integer label, a 0/1 prediction and a probability. ``by`` columns (model, fold) evaluate many
prediction sets in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.functions.numeric import bucket_of, ratio_or_zero, round_even
from fleetlens.operators.running import quantile_boundaries, running_totals, with_range_bucket

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


def predict_at(df: DataFrame, threshold: float = 0.5, probability: str = "probability") -> DataFrame:
    return df.withColumn("predicted", (F.col(probability) >= F.lit(threshold)).cast("int"))


def confusion(df: DataFrame, by: Sequence[str] = (), label: str = P.LABEL, predicted: str = "predicted") -> DataFrame:
    """tn, fp, fn, tp and their total in one pass; unlabeled rows are left out."""
    y, z = F.col(label), F.col(predicted)
    counts = df.where(y.isNotNull()).groupBy(*by).agg(
        F.count_if((y == 0) & (z == 0)).alias("tn"),
        F.count_if((y == 0) & (z == 1)).alias("fp"),
        F.count_if((y == 1) & (z == 0)).alias("fn"),
        F.count_if((y == 1) & (z == 1)).alias("tp"),
    )
    return counts.withColumn("total", F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp"))


def _rates(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    return {
        "accuracy": ratio_or_zero(tp + tn, tn + fp + fn + tp),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }


def f2(fp: Column, fn: Column, tp: Column) -> Column:
    """5pr / (4p + r) written over counts; 0 where precision and recall are both 0."""
    return ratio_or_zero(5 * tp, 5 * tp + 4 * fn + fp)


def ranking_metrics(
    df: DataFrame,
    by: Sequence[str] = (),
    label: str = P.LABEL,
    probability: str = "probability",
    parts: int | None = None,
) -> DataFrame:
    """Exact, tie-aware ROC AUC and average precision per group; NULL where a class is absent.

    Rows are first collapsed to one per distinct score, so a hot score costs one row. Scores are then cut into
    ``parts`` ranges of equal row count (default: one per shuffle partition) and cumulated range by range.
    """
    by = list(by)
    rows = df.where(F.col(label).isNotNull())
    scores = rows.groupBy(*by, F.col(probability).alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    ranged = with_range_bucket(scores, "_score", quantile_boundaries(rows, probability, parts), "_range")
    curve = running_totals(
        ranged, by, F.col("_range"), [F.col("_score").desc()], {"_tp": "_pos", "_fp": "_neg"}, descending=True
    )
    area = F.sum(F.col("_neg") * (F.col("_tp") - F.col("_pos") / 2.0))
    gain = F.sum(F.col("_pos") * ratio_or_zero(F.col("_tp"), F.col("_tp") + F.col("_fp")))
    positives, negatives = F.sum("_pos"), F.sum("_neg")
    both = (positives > 0) & (negatives > 0)
    return curve.groupBy(*by).agg(
        F.when(both, area / (positives * negatives)).alias("roc_auc"),
        F.when(positives > 0, gain / positives).alias("pr_auc"),
    )


def evaluation(
    df: DataFrame,
    by: Sequence[str] = (),
    label: str = P.LABEL,
    predicted: str = "predicted",
    probability: str = "probability",
) -> DataFrame:
    """Six metrics and the confusion counts, one row per group; a NULL group is a group."""
    by = list(by)
    counts = confusion(df, by, label, predicted)
    rates = _rates(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])
    ranks = ranking_metrics(df, by, label, probability)
    same = F.lit(True)
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    joined = counts.join(ranks.withColumnsRenamed({k: f"_of_{k}" for k in by}), same, "inner")
    return joined.select(*by, *[c.alias(k) for k, c in rates.items()], "roc_auc", "pr_auc", "tn", "fp", "fn", "tp")


def evaluation_report(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Nested form of ``evaluation``: flat scores plus a ``confusion_matrix`` struct, as the JSON report holds it."""
    return metrics.select(
        *by, *METRICS,
        F.struct(
            F.col("tn").alias("true_negative"), F.col("fp").alias("false_positive"),
            F.col("fn").alias("false_negative"), F.col("tp").alias("true_positive"),
        ).alias("confusion_matrix"),
    )


def classification_report(df: DataFrame, label: str = P.LABEL, predicted: str = "predicted") -> DataFrame:
    """One row per class plus macro and weighted averages: precision, recall, f1_score, support.

    Computed from the one-row confusion counts.
    """
    counts = confusion(df, (), label, predicted)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def entry(name: str, own: Column, false_own: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            ratio_or_zero(own, own + false_own).alias("precision"),
            ratio_or_zero(own, own + missed).alias("recall"),
            ratio_or_zero(2 * own, 2 * own + false_own + missed).alias("f1_score"),
            (own + missed).alias("support"),
        )

    per_class = counts.select(
        "total", entry("0", tn, fn, fp).alias("a"), entry("1", tp, fp, fn).alias("b")
    )

    def average(name: str, weight_a: Column, weight_b: Column) -> Column:
        total = weight_a + weight_b
        return F.struct(
            F.lit(name).alias("class"),
            *[
                ratio_or_zero(F.col(f"a.{m}") * weight_a + F.col(f"b.{m}") * weight_b, total).alias(m)
                for m in ("precision", "recall", "f1_score")
            ],
            F.col("total").alias("support"),
        )

    return per_class.select(F.inline(F.array(
        F.col("a"), F.col("b"),
        average("macro avg", F.lit(1.0), F.lit(1.0)),
        average("weighted avg", F.col("a.support"), F.col("b.support")),
    )))


def full_report(test: DataFrame, folded: DataFrame) -> DataFrame:
    """One row: the nested report of the test scores, with its per-class part and the means over the folds.

    ``test`` are the scored hold-out rows, ``folded`` the out-of-fold rows with their ``fold``.
    """
    scores = evaluation_report(evaluation(test))
    names = ("precision", "recall", "f1_score", "support")
    classes = classification_report(test).agg(F.collect_list(F.struct("class", *names)).alias("classification_report"))
    means = evaluation(folded, by=["fold"]).agg(F.struct(*[F.avg(m).alias(m) for m in METRICS]).alias("cv_metrics"))
    return scores.crossJoin(classes).crossJoin(means)  # three relations of one row


def threshold_counts(
    df: DataFrame,
    thresholds: Sequence[float] = P.SWEEP_THRESHOLDS,
    by: Sequence[str] = (),
    label: str = P.LABEL,
    probability: str = "probability",
) -> DataFrame:
    """Confusion counts at every threshold from one pass, without repeating a row per threshold.

    Each row falls into the band between two thresholds; band counts are folded into a small array per group and
    summed from the top.
    """
    by = list(by)
    cuts = sorted(thresholds)
    bands = df.where(F.col(label).isNotNull()).groupBy(*by, bucket_of(F.col(probability), cuts).alias("_band")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    above = {f"_{kind}{i}": F.sum(F.when(F.col("_band") > i, F.col(f"_{kind}")).otherwise(F.lit(0)))
             for i in range(len(cuts)) for kind in ("pos", "neg")}
    folded = bands.groupBy(*by).agg(
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"), *[c.alias(k) for k, c in above.items()]
    )
    rows = [
        F.struct(
            F.lit(cut).alias("threshold"),
            (F.col("_n") - F.col(f"_neg{i}")).alias("tn"), F.col(f"_neg{i}").alias("fp"),
            (F.col("_p") - F.col(f"_pos{i}")).alias("fn"), F.col(f"_pos{i}").alias("tp"),
        )
        for i, cut in enumerate(cuts)
    ]
    return folded.select(*by, F.inline(F.array(*rows)))


def threshold_sweep(
    df: DataFrame,
    thresholds: Sequence[float] = P.SWEEP_THRESHOLDS,
    by: Sequence[str] = (),
    label: str = P.LABEL,
    probability: str = "probability",
) -> DataFrame:
    """Precision, recall, F1 and F2 at every threshold, rounded to four digits; ``f2_exact`` keeps the raw value."""
    fp, fn, tp = F.col("fp"), F.col("fn"), F.col("tp")
    rates = _rates(F.col("tn"), fp, fn, tp)
    return threshold_counts(df, thresholds, by, label, probability).select(
        *by, "threshold", "tn", "fp", "fn", "tp",
        round_even(rates["precision"], 4).alias("precision"),
        round_even(rates["recall"], 4).alias("recall"),
        round_even(rates["f1"], 4).alias("f1"),
        round_even(f2(fp, fn, tp), 4).alias("f2"),
        f2(fp, fn, tp).alias("f2_exact"),
    )


def best_threshold(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The lowest threshold with the highest F2; 0.5 and NULL metrics where no threshold reaches F2 > 0."""
    useful = F.col("f2_exact") > 0
    chosen = F.max(F.when(useful, F.struct(
        "f2_exact", (-F.col("threshold")).alias("_lowest"), "threshold", "f2", "precision", "recall", "f1"
    )))
    return sweep.groupBy(*by).agg(chosen.alias("_best")).select(
        *by,
        F.coalesce(F.col("_best.threshold"), F.lit(0.5)).alias("opt_threshold"),
        F.col("_best.f2").alias("opt_f2"), F.col("_best.precision").alias("opt_precision"),
        F.col("_best.recall").alias("opt_recall"), F.col("_best.f1").alias("opt_f1"),
    )


# --- model comparison: one row per model, so a single-task order is bounded ------------------------


def mean_over_folds(fold_metrics: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    return fold_metrics.groupBy("model").agg(*[F.avg(m).alias(m) for m in metrics])


def rank_models(metrics: DataFrame) -> DataFrame:
    order = W.orderBy(F.col("roc_auc").desc(), F.col("model"))
    return metrics.withColumn("rank", F.row_number().over(order))


def deltas_to_best(metrics: DataFrame, compared: Sequence[str] = METRICS) -> DataFrame:
    """Each model's metrics minus those of the model with the highest ROC AUC."""
    order = W.orderBy(F.col("roc_auc").desc(), F.col("model"))
    return metrics.select("model", *[(F.col(m) - F.first(m).over(order)).alias(f"delta_{m}") for m in compared])


def best_model(metrics: DataFrame, by: str = "opt_f2") -> DataFrame:
    """The row of the model with the highest value; ties go to the first name."""
    return metrics.orderBy(F.col(by).desc_nulls_last(), F.col("model")).limit(1)
