import pytest
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.operators import reports as D
from fleetlens.operators import scoring as G


def fleet(spark, probabilities, labels=None):
    labels = labels or [0] * len(probabilities)
    rows = list(zip(range(len(probabilities)), labels, probabilities))
    return spark.createDataFrame(rows, "vehicle_id long, in_study_repair int, probability double")


def test_fleet_scores(spark):
    row = G.fleet_scores(fleet(spark, [0.123456]), scored_at=F.lit("t")).first()
    assert row["failure_probability"] == 0.1235 and row["risk_percentage"] == 12.35
    assert row["expected_breakdown_cost_jpy"] == 61728.0 and row["maintenance_roi_jpy"] == 31728.0
    assert row["net_savings_jpy"] == 31728.0 and row["expected_co2_saved_kg"] == 43.21
    assert row["expected_materials_saved_kg"] == 5.56 and row["model_version"] == "1.0.0"
    low = G.fleet_scores(fleet(spark, [0.01])).first()
    assert low["net_savings_jpy"] == 0.0 and low["maintenance_roi_jpy"] == -25000.0 and "T" in low["prediction_timestamp"]


def test_operational_metrics(spark):
    df = spark.createDataFrame(
        [(1, 100.0, 200.0, 120.0, 220.0), (2, None, 50.0, None, None)],
        "vehicle_id long, s_397_0_mean double, s_397_1_mean double, s_397_0_max double, s_397_1_max double",
    )
    out = G.operational_metrics(df)
    rows = {r["vehicle_id"]: r for r in out.collect()}
    assert rows[1]["avg_exhaust_temperature_c"] == 150.0 and rows[1]["peak_exhaust_temperature_c"] == 220.0
    assert rows[2]["avg_exhaust_temperature_c"] == 50.0 and rows[2]["peak_exhaust_temperature_c"] is None
    assert "avg_engine_soot_mass_index" not in out.columns
    assert G.operational_metrics(df.select("vehicle_id")).columns == ["vehicle_id"]
    single = G.operational_metrics(df.select("vehicle_id", "s_397_0_max")).where("vehicle_id = 1").first()
    assert single["peak_exhaust_temperature_c"] == 120.0


def test_predictions_extract(spark):
    rows = G.predictions_extract(fleet(spark, [0.2, 0.9], [None, 0]), scored_at=F.lit("t")).orderBy("Vehicle Id").collect()
    assert rows[0].asDict() == {
        "Vehicle Id": 0, "Actual": -1, "Predicted": 0, "Failure Probability": 0.2,
        "Maintenance Priority": P.TIER_CRITICAL, "Model Version": "1.0.0", "Prediction Timestamp": "t"}
    counts = G.misclassified(G.predictions_extract(fleet(spark, [0.2, 0.9, 0.1], [None, 0, 1]))).first()
    assert (counts["false_positives"], counts["false_negatives"]) == (1, 1)


def test_risk_tier_summary(spark):
    rows = G.risk_tier_summary(G.fleet_scores(fleet(spark, [0.01, 0.04, 0.2, 0.3]))).collect()
    assert [r["Priority"] for r in rows] == [P.TIER_CRITICAL, P.TIER_PREVENTATIVE, P.TIER_STABLE]
    assert rows[0]["Vehicle Count"] == 2 and rows[0]["Average Probability"] == 0.25


def test_fleet_risk_summary(spark):
    row = G.fleet_risk_summary(G.fleet_scores(fleet(spark, [0.01, 0.03, 0.049999, 0.2]))).first()
    assert row["high_risk_vehicles"] == 2 and row["medium_risk_vehicles"] == 1  # 4.9999 % is published as 5.0 %


def test_importance_flag_and_projection(spark):
    importance = spark.createDataFrame([("a", 0.1), ("b", 0.3), ("c", 0.2)], "feature string, importance double")
    ranked = D.rank_importance(importance)
    assert [(r["feature"], r["rank"]) for r in ranked.orderBy("rank").collect()] == [("b", 1), ("c", 2), ("a", 3)]
    scored = G.fleet_scores(fleet(spark, [0.2]))
    assert G.flag_importance(scored, ranked).first()["top_model_feature"] == "b"
    assert G.flag_importance(scored, ranked.limit(0)).first()["feature_importance_rank"] == -1
    assert G.flag_importance(scored, None).first()["feature_importance_rank"] == -1
    extract = G.dashboard_extract(scored, ranked)
    assert extract.columns == [c for c in P.DASHBOARD_COLUMNS if c in extract.columns] and extract.count() == 1
    assert len(P.DASHBOARD_COLUMNS) == 23


def test_fill_missing_columns(spark):
    df = spark.createDataFrame([(1,), (2,)], "num1 int")
    filled = G.fill_missing_columns(df, {"cat1": "string", "num1": "double", "num2": "double"})
    assert [tuple(r) for r in filled.select("num1", "cat1", "num2").collect()] == [(1, "0", 0.0), (2, "0", 0.0)]
    assert G.fill_missing_columns(df, ["num1"]).columns == ["num1"]


def test_metrics_long(spark):
    metrics = spark.createDataFrame(
        [(0.857, 0.889, 0.8, 0.842, 0.9, 0.91, 100, 10, 20, 80)],
        "accuracy double, precision double, recall double, f1 double, roc_auc double, pr_auc double, "
        "tn long, fp long, fn long, tp long",
    )
    rows = {r["Metric"]: r for r in D.metrics_long(metrics).collect()}
    assert len(rows) == 14 and rows["Accuracy"]["Value"] == "0.857" and rows["True Negative"]["Value"] == "100"
    assert rows["Training Samples"]["Value"] == "210" and rows["Engineered Features"]["Value"] == "0"
    assert rows["CV Folds"]["Value"] == "5" and rows["Recall"]["Model Version"] == "1.0.0"
    specs = spark.range(7)
    assert {r["Metric"]: r["Value"] for r in D.metrics_long(metrics, specs).collect()}["Training Samples"] == "7"


def test_importance_table(spark):
    importance = spark.createDataFrame([("s_397_0_mean", 0.2), ("s_100_0_trend_slope", 0.5)], "feature string, importance double")
    rows = D.top_features(D.importance_table(importance), 1).collect()
    assert [tuple(r) for r in rows] == [("s_100_0_trend_slope", 0.5, 1, "Trend")]
    assert pytest.approx(0.7) == sum(r["Importance"] for r in D.importance_table(importance).collect())
