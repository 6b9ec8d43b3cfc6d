"""Scoring arithmetic, tiers, roll-ups and extracts. Everything before a roll-up is one narrow projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.functions.domain import maintenance_priority
from fleetlens.functions.numeric import round_even


def fleet_scores(
    df: DataFrame,
    risk: P.RiskParams = P.RISK,
    probability: str = "probability",
    model_version: str = P.MODEL_VERSION,
    scored_at: Column | None = None,
) -> DataFrame:
    """Add every score column next to the raw ``probability``; tiers use the raw value, published numbers are rounded."""
    p = F.col(probability)
    cost = p * F.lit(risk.breakdown_cost_jpy)
    saving = cost - F.lit(risk.maintenance_cost_jpy)
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX") if scored_at is None else scored_at
    return df.withColumns({
        "failure_probability": round_even(p, 4),
        "risk_percentage": round_even(p * F.lit(100.0), 2),
        "maintenance_priority": maintenance_priority(p, risk),
        "expected_breakdown_cost_jpy": round_even(cost, 0),
        "preventative_maintenance_cost_jpy": F.lit(risk.maintenance_cost_jpy),
        "maintenance_roi_jpy": round_even(saving, 0),
        "net_savings_jpy": round_even(F.greatest(saving, F.lit(0.0)), 0),
        "expected_co2_saved_kg": round_even(p * F.lit(risk.co2_per_failure_kg), 2),
        "expected_materials_saved_kg": round_even(p * F.lit(risk.materials_per_failure_kg), 2),
        "expected_repair_avoided": round_even(p, 4),
        "model_version": F.lit(model_version),
        "prediction_timestamp": stamp,
    })


def _row_mean(columns: list[str]) -> Column:
    cells = [F.col(f"`{c}`") for c in columns]
    total, present = F.lit(0.0), F.lit(0)
    for cell in cells:
        total = total + F.coalesce(cell, F.lit(0.0))
        present = present + cell.isNotNull().cast("int")
    return F.when(present > 0, total / present)


def _row_max(columns: list[str]) -> Column:
    cells = [F.col(f"`{c}`") for c in columns]
    return F.greatest(*cells) if len(cells) > 1 else cells[0]


def operational_metrics(df: DataFrame, metrics: Mapping[str, tuple[str, str]] = P.OPERATIONAL_METRICS) -> DataFrame:
    """Add average and peak of each mapped sensor family; a family without columns adds nothing."""
    added = {}
    for family, (average, peak) in metrics.items():
        means = [c for c in df.columns if c.startswith(f"s_{family}_") and c.endswith("_mean")]
        maxima = [c for c in df.columns if c.startswith(f"s_{family}_") and c.endswith("_max")]
        if means:
            added[average] = round_even(_row_mean(means), 2)
        if maxima:
            added[peak] = round_even(_row_max(maxima), 2)
    return df.withColumns(added) if added else df


def rename_for_dashboard(df: DataFrame, aliases: Mapping[str, str] = P.DASHBOARD_ALIASES) -> DataFrame:
    return df.withColumnsRenamed({source: alias for alias, source in aliases.items() if source in df.columns})


def select_available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def top_feature(importance: DataFrame) -> DataFrame:
    """One row: the best-ranked feature, NULL for an empty table."""
    return importance.agg(F.min_by("feature", F.struct("rank", "feature")).alias("top_model_feature"))


def flag_importance(df: DataFrame, importance: DataFrame | None) -> DataFrame:
    """Add the top feature and a rank flag of 1; without a usable importance table the feature is NULL, the flag -1.

    The top feature is a scalar subquery: it runs when the result is read, and not where nobody reads it.
    """
    if importance is None:
        return df.withColumn("feature_importance_rank", F.lit(-1))
    joined = df.withColumn("top_model_feature", top_feature(importance).scalar())
    flag = F.when(F.col("top_model_feature").isNotNull(), F.lit(1)).otherwise(F.lit(-1))
    return joined.withColumn("feature_importance_rank", flag)


def dashboard_extract(scored: DataFrame, importance: DataFrame | None = None) -> DataFrame:
    """Renamed, flagged and projected fleet for the dashboard."""
    flagged = flag_importance(rename_for_dashboard(scored), importance)
    return select_available(flagged, P.DASHBOARD_COLUMNS)


def predictions_extract(
    df: DataFrame,
    risk: P.RiskParams = P.RISK,
    threshold: float = 0.5,
    probability: str = "probability",
    model_version: str = P.MODEL_VERSION,
    scored_at: Column | None = None,
) -> DataFrame:
    """Seven-column extract; an unknown actual is -1."""
    p = F.col(probability)
    return df.select(
        F.col(P.ID).alias("Vehicle Id"),
        F.coalesce(F.col(P.LABEL), F.lit(-1)).cast("int").alias("Actual"),
        (p >= F.lit(threshold)).cast("int").alias("Predicted"),
        round_even(p, 4).alias("Failure Probability"),
        maintenance_priority(p, risk).alias("Maintenance Priority"),
        F.lit(model_version).alias("Model Version"),
        (F.current_timestamp() if scored_at is None else scored_at).alias("Prediction Timestamp"),
    )


def misclassified(extract: DataFrame) -> DataFrame:
    """False positive and false negative counts of an extract; unknown actuals match neither."""
    actual, predicted = F.col("Actual"), F.col("Predicted")
    return extract.agg(
        F.count_if((actual == 0) & (predicted == 1)).alias("false_positives"),
        F.count_if((actual == 1) & (predicted == 0)).alias("false_negatives"),
    )


def risk_tier_summary(scored: DataFrame) -> DataFrame:
    """Per tier: vehicles and means of the rounded scores, highest mean probability first."""
    summary = scored.groupBy(F.col("maintenance_priority").alias("Priority")).agg(
        F.count(P.ID).alias("Vehicle Count"),
        round_even(F.avg("failure_probability"), 4).alias("Average Probability"),
        round_even(F.avg("expected_breakdown_cost_jpy"), 0).alias("Average Expected Breakdown Cost JPY"),
        round_even(F.avg("net_savings_jpy"), 0).alias("Average Net Savings JPY"),
        round_even(F.avg("expected_co2_saved_kg"), 2).alias("Average Expected CO2 Saved KG"),
    )
    return summary.orderBy(F.col("Average Probability").desc())


def scoring_export(scored: DataFrame, approximate: bool, risk: P.RiskParams = P.RISK, threshold: float = 0.5,
                   scored_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The predictions extract and the tier summary of one scored fleet.

    ``approximate`` says that the fleet came from specifications alone, with sensor columns filled in; every row of
    the extract then carries the flag.
    """
    extract = predictions_extract(scored, risk, threshold, scored_at=scored_at).withColumn("Approximate", F.lit(approximate))
    return extract, risk_tier_summary(fleet_scores(scored, risk, scored_at=scored_at))


def fleet_risk_summary(scored: DataFrame, risk: P.RiskParams = P.RISK) -> DataFrame:
    """Fleet totals; tier counts here use the rounded percentage."""
    percentage = F.col("risk_percentage")
    high, medium = F.lit(risk.high * 100), F.lit(risk.medium * 100)
    return scored.agg(
        F.avg(percentage).alias("average_risk_percentage"),
        F.count_if(percentage >= high).alias("high_risk_vehicles"),
        F.count_if((percentage >= medium) & (percentage < high)).alias("medium_risk_vehicles"),
        F.sum("expected_co2_saved_kg").alias("expected_co2_saved_kg"),
        F.sum("net_savings_jpy").alias("net_savings_jpy"),
    )


def fill_missing_columns(df: DataFrame, expected: Mapping[str, str] | Iterable[str]) -> DataFrame:
    """Add each expected but absent column as 0 (``"0"`` for strings); present columns stay as they are.

    ``expected`` maps column to Spark type name; a plain iterable means numeric columns.
    """
    types = dict(expected) if isinstance(expected, Mapping) else dict.fromkeys(expected, "double")
    absent = {c: F.lit(0).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df
