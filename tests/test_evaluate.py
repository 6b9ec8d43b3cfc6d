import math
import random

import pytest
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.operators import evaluate as E
from fleetlens.operators import splits as S

SCHEMA = "vehicle_id long, in_study_repair int, probability double, predicted int"


def scored(spark, actual, predicted, probability=None):
    probability = probability or [float(p) for p in predicted]
    return spark.createDataFrame(list(zip(range(len(actual)), actual, probability, predicted)), SCHEMA)


def test_confusion(spark):
    row = E.confusion(scored(spark, [0, 0, 0, 1, 1, 1], [0, 1, 0, 1, 0, 1])).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"], row["total"]) == (2, 1, 1, 2, 6)


def test_perfect_wrong_and_silent_models(spark):
    perfect = E.evaluation(scored(spark, [0, 0, 1, 1], [0, 0, 1, 1])).first()
    assert perfect["accuracy"] == perfect["f1"] == perfect["roc_auc"] == perfect["pr_auc"] == 1.0
    wrong = E.evaluation(scored(spark, [0, 0, 1, 1], [1, 1, 0, 0])).first()
    assert wrong["accuracy"] == 0.0 and wrong["roc_auc"] == 0.0
    silent = E.evaluation(scored(spark, [0, 1], [0, 0])).first()
    assert silent["precision"] == silent["recall"] == silent["f1"] == 0.0 and silent["roc_auc"] == 0.5
    single = E.evaluation(scored(spark, [0, 0], [0, 1])).first()
    assert single["roc_auc"] is None and single["pr_auc"] is None


def brute_ranking(rows):
    positive = [p for y, p in rows if y == 1]
    negative = [p for y, p in rows if y == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in positive for b in negative) / (len(positive) * len(negative))
    precision_sum, before = 0.0, 0.0
    for t in sorted({p for _, p in rows}, reverse=True):
        tp, fp = sum(p >= t for p in positive), sum(p >= t for p in negative)
        precision_sum += (tp / len(positive) - before) * tp / (tp + fp)
        before = tp / len(positive)
    return auc, precision_sum


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_ranking_metrics_against_brute_force(spark, parts):
    """Half of the rows share one score."""
    rng = random.Random(11)
    rows = [(int(rng.random() < 0.3), 0.25 if i % 2 else round(rng.random(), 2)) for i in range(400)]
    df = spark.createDataFrame([(i, y, p, 0) for i, (y, p) in enumerate(rows)], SCHEMA).repartition(8)
    found = E.ranking_metrics(df, parts=parts).first()
    auc, ap = brute_ranking(rows)
    assert math.isclose(found["roc_auc"], auc, abs_tol=1e-12) and math.isclose(found["pr_auc"], ap, abs_tol=1e-12)


def test_classification_report(spark):
    rows = {r["class"]: r for r in E.classification_report(scored(spark, [0, 0, 0, 1], [0, 0, 1, 1])).collect()}
    assert set(rows) == {"0", "1", "macro avg", "weighted avg"}
    assert rows["0"]["precision"] == 1.0 and rows["0"]["recall"] == pytest.approx(2 / 3) and rows["0"]["support"] == 3
    assert rows["1"]["precision"] == 0.5 and rows["1"]["recall"] == 1.0
    assert rows["macro avg"]["precision"] == 0.75 and rows["macro avg"]["support"] == 4
    assert rows["weighted avg"]["precision"] == pytest.approx(0.875)


def test_threshold_sweep_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.4), rng.choice([0.05, 0.07, 0.3, 0.53, round(rng.random(), 3)])) for _ in range(300)]
    df = spark.createDataFrame([(i, y, p, 0) for i, (y, p) in enumerate(rows)], SCHEMA)
    found = {r["threshold"]: r for r in E.threshold_sweep(df).collect()}
    assert sorted(found) == list(P.SWEEP_THRESHOLDS) and len(found) == 25
    scores = {}
    for t in P.SWEEP_THRESHOLDS:
        tp = sum(y == 1 and p >= t for y, p in rows)
        fp = sum(y == 0 and p >= t for y, p in rows)
        fn = sum(y == 1 and p < t for y, p in rows)
        assert (found[t]["tp"], found[t]["fp"], found[t]["fn"]) == (tp, fp, fn)
        p, r = (tp / (tp + fp) if tp + fp else 0), tp / (tp + fn)
        scores[t] = 5 * p * r / (4 * p + r) if p + r else 0
        assert found[t]["f2_exact"] == pytest.approx(scores[t])
    best = E.best_threshold(E.threshold_sweep(df)).first()
    assert best["opt_threshold"] == min(t for t in scores if scores[t] == max(scores.values()))


def test_sweep_without_any_hit(spark):
    best = E.best_threshold(E.threshold_sweep(scored(spark, [0, 1], [0, 0], [0.9, 0.01]))).first()
    assert best["opt_threshold"] == 0.5 and best["opt_f2"] is None


@pytest.mark.parametrize("actual, predicted, score", [
    ([0, 1], [0, 1], 1.0), ([0, 1], [1, 0], 0.0), ([0, 1], [0, 0], 0.0),
])
def test_f2(spark, actual, predicted, score):
    counts = E.confusion(scored(spark, actual, predicted))
    assert counts.select(E.f2(F.col("fp"), F.col("fn"), F.col("tp"))).first()[0] == score


@pytest.mark.parametrize("ys, ratio", [([0, 0, 0, 0, 1], 4.0), ([0, 0, 0], 15.0), ([0, 0, 1, 1], 1.0)])
def test_class_ratio(spark, ys, ratio):
    assert S.class_ratio(spark.createDataFrame([(y,) for y in ys], "in_study_repair int")).first()[0] == ratio


def test_split_and_folds(spark):
    rows = [(i, int(i % 9 == 0)) for i in range(900)]
    df = spark.createDataFrame(rows, "vehicle_id long, in_study_repair int").repartition(8)
    split = S.stratified_split(df)
    assert {(r["in_study_repair"], r["is_test"]): r["count"] for r in split.groupBy("in_study_repair", "is_test").count().collect()} == {
        (0, True): 160, (0, False): 640, (1, True): 20, (1, False): 80}
    folds = S.stratified_folds(df)
    assert {r["count"] for r in folds.where("in_study_repair = 1").groupBy("fold").count().collect()} == {20}
    assert folds.count() == 900 and folds.select("vehicle_id").distinct().count() == 900
    again = S.stratified_folds(df.repartition(3))
    assert folds.exceptAll(again.select(folds.columns)).count() == 0


def test_hash_positions_equal_row_number(spark):
    from pyspark.sql import Window as W

    df = spark.range(500).select(F.col("id").alias("vehicle_id"), (F.col("id") % 2).cast("int").alias("in_study_repair"))
    plain = df.withColumn("position", F.row_number().over(
        W.partitionBy("in_study_repair").orderBy(F.md5(F.col("vehicle_id").cast("string")), "vehicle_id")))
    for digits in (1, 3):
        mine = S.class_positions(df, hex_digits=digits).select("vehicle_id", "in_study_repair", F.col("position").cast("int"))
        assert mine.exceptAll(plain).count() == 0 and mine.count() == 500


def test_model_comparison(spark):
    rows = [("a", 0.7, 0.5), ("b", 0.9, 0.4), ("c", 0.8, 0.6)]
    metrics = spark.createDataFrame(rows, "model string, roc_auc double, opt_f2 double")
    assert [r["model"] for r in E.rank_models(metrics).orderBy("rank").collect()] == ["b", "c", "a"]
    deltas = {r["model"]: r["delta_roc_auc"] for r in E.deltas_to_best(metrics, ["roc_auc"]).collect()}
    assert deltas["b"] == 0.0 and deltas["a"] == pytest.approx(-0.2)
    assert E.best_model(metrics).first()["model"] == "c"
