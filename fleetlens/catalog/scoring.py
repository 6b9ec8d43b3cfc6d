"""Fleet scores, extracts and roll-ups over a deterministic stand-in probability."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.catalog.features import long_statistics_sql
from fleetlens.catalog.fleet import _FEATURES_SQL, accounts, features, vehicles
from fleetlens.catalog.registry import query, rounded, rounded_sql
from fleetlens.operators import features as X
from fleetlens.operators import joins as J
from fleetlens.operators import reports as D
from fleetlens.operators import scoring as G
from fleetlens.sources import roles
from fleetlens.sources.materialize import written
from fleetlens.sources.roles import table

STAMP = "2024-01-01T00:00:00+00:00"


def scored_at():
    return F.lit(STAMP)


_TIER = f"""CASE WHEN probability >= 0.05 THEN '{P.TIER_CRITICAL}'
  WHEN probability >= 0.03 THEN '{P.TIER_PREVENTATIVE}' ELSE '{P.TIER_STABLE}' END"""

SCORES_SQL = f"""
  SELECT *, round_even(probability, 4) AS failure_probability,
         round_even(probability * 100.0, 2) AS risk_percentage,
         {_TIER} AS maintenance_priority,
         round_even(probability * 500000.0, 0) AS expected_breakdown_cost_jpy,
         CAST(30000.0 AS DOUBLE) AS preventative_maintenance_cost_jpy,
         round_even(probability * 500000.0 - 30000.0, 0) AS maintenance_roi_jpy,
         round_even(greatest(probability * 500000.0 - 30000.0, 0.0), 0) AS net_savings_jpy,
         round_even(probability * 350.0, 2) AS expected_co2_saved_kg,
         round_even(probability * 45.0, 2) AS expected_materials_saved_kg,
         round_even(probability, 4) AS expected_repair_avoided,
         '{P.MODEL_VERSION}' AS model_version, '{STAMP}' AS prediction_timestamp
  FROM ({{relation}})"""


def fleet_scores_of(df):
    return G.fleet_scores(df, scored_at=scored_at())


@query("fleet_scores", SCORES_SQL.format(relation=roles.SCORED))
def fleet_scores(spark, sf_dir):
    return fleet_scores_of(roles.scored(table(spark, sf_dir, "customer")))


@query("scored_now", "SELECT c_custkey AS vehicle_id, true AS of_this_run FROM customer")
def scored_now(spark, sf_dir):
    """The stamp of a run without a given one: the same for every vehicle, and between the run's start and its end."""
    now = lambda: spark.sql("SELECT date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\")").first()[0]
    begun = now()
    scores = written(G.fleet_scores(roles.scored(table(spark, sf_dir, "customer"))), "scored-now")
    ended = now()
    stamp = F.to_timestamp("prediction_timestamp")
    one = scores.agg(F.count_distinct("prediction_timestamp").alias("stamps"))
    within = stamp.between(F.to_timestamp(F.lit(begun)), F.to_timestamp(F.lit(ended)))
    return scores.crossJoin(F.broadcast(one)).select("vehicle_id", (within & (F.col("stamps") == 1)).alias("of_this_run"))


def _row_mean_sql(columns) -> str:
    cells = ", ".join(f'"{c}"' for c in columns)
    return f"round_even(list_avg(list_filter([{cells}], lambda x: x IS NOT NULL)), 2)"


_METRIC_SQL = ", ".join(
    f'{_row_mean_sql([f"s_{s}_mean" for s in roles.SENSORS if s.startswith(family)])} AS {average}, '
    f'round_even(greatest({", ".join(f"s_{s}_max" for s in roles.SENSORS if s.startswith(family))}), 2) AS {peak}'
    for family, (average, peak) in P.OPERATIONAL_METRICS.items()
)


@query("operational_metrics", f"SELECT vehicle_id, {_METRIC_SQL} FROM ({_FEATURES_SQL})")
def operational_metrics(spark, sf_dir):
    metrics = G.operational_metrics(features(spark, sf_dir))
    return metrics.select("vehicle_id", *[c for pair in P.OPERATIONAL_METRICS.values() for c in pair])


# --- importance stand-in: relation of every engineered feature to the label -----------------------

_STAT_NAMES = [s for s in P.STATISTICS if s != "missing_count"]


def importance(spark, sf_dir):
    """(feature, importance) derived from the data: absolute correlation of a feature with the label."""
    statistics = X.long_statistics(roles.readouts_long(table(spark, sf_dir, "events")))
    cells = statistics.unpivot(["vehicle_id", "sensor"], _STAT_NAMES, "statistic", "value")
    labels = roles.labels(table(spark, sf_dir, "customer")).where(F.col(P.LABEL).isNotNull())
    named = cells.join(labels, P.ID, "inner").select(
        F.concat(F.lit("s_"), "sensor", F.lit("_"), "statistic").alias("feature"), "value", F.col(P.LABEL).cast("double")
    )
    relation = F.abs(F.corr("value", P.LABEL))
    found = named.groupBy("feature").agg(F.coalesce(F.nanvl(relation, F.lit(0.0)), F.lit(0.0)).alias("importance"))
    return rounded(found)


_STAT_LIST = ", ".join('"%s"' % s for s in _STAT_NAMES)
IMPORTANCE_SQL = f"""
  SELECT 's_' || u.sensor || '_' || statistic AS feature,
         round_even(coalesce(CASE WHEN isnan(abs(corr(value, CAST(l.in_study_repair AS DOUBLE)))) THEN 0.0
                    ELSE abs(corr(value, CAST(l.in_study_repair AS DOUBLE))) END, 0.0), 6) AS importance
  FROM (SELECT * FROM ({long_statistics_sql()}) AS s
        UNPIVOT INCLUDE NULLS (value FOR statistic IN ({_STAT_LIST}))) u
  JOIN ({roles.LABELS}) l ON u.vehicle_id = l.vehicle_id WHERE l.in_study_repair IS NOT NULL
  GROUP BY 1"""

RANKED_SQL = f"""
  SELECT feature, importance, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank
  FROM ({IMPORTANCE_SQL})"""

_MAPPED = "CASE " + " ".join(
    f"WHEN contains(f, '{k}') THEN '{v}'" for k, v in P.FEATURE_CATEGORIES.items()
) + " END"
CATEGORY_SQL = f"""
  SELECT feature AS "Feature", importance AS "Importance", rank AS "Rank",
         CASE WHEN contains(f, 'trend_slope') THEN coalesce({_MAPPED}, 'Trend')
              WHEN regexp_matches(f, 'mean|max|std') THEN coalesce({_MAPPED}, 'Other')
              ELSE 'Other' END AS "Category"
  FROM (SELECT *, lower(feature) AS f FROM ({RANKED_SQL}))"""


@query("importance_ranked", RANKED_SQL)
def importance_ranked(spark, sf_dir):
    return D.rank_importance(importance(spark, sf_dir))


@query("importance_categories", CATEGORY_SQL)
def importance_categories(spark, sf_dir):
    return D.importance_table(importance(spark, sf_dir))


@query("importance_top20", f'SELECT * FROM ({CATEGORY_SQL}) ORDER BY "Rank" LIMIT 20')
def importance_top20(spark, sf_dir):
    return D.top_features(D.importance_table(importance(spark, sf_dir)), 20)


@query("top_feature", f"SELECT feature AS top_model_feature FROM ({RANKED_SQL}) WHERE rank = 1")
def top_feature(spark, sf_dir):
    return G.top_feature(D.rank_importance(importance(spark, sf_dir)))


_FLEET_SQL = f"""
  SELECT p.vehicle_id, p.probability, p.in_study_repair, l.length_of_study_time_step, v.vehicle_age_years,
         a.company_name, a.operating_prefecture, z.fleet_size, f.* EXCLUDE (vehicle_id), m.* EXCLUDE (vehicle_id)
  FROM ({roles.SCORED}) p JOIN ({roles.LABELS}) l ON p.vehicle_id = l.vehicle_id
  LEFT JOIN ({_FEATURES_SQL}) f ON p.vehicle_id = f.vehicle_id
  LEFT JOIN (SELECT vehicle_id, {_METRIC_SQL} FROM ({_FEATURES_SQL})) m ON p.vehicle_id = m.vehicle_id
  JOIN ({roles.VEHICLES}) v ON p.vehicle_id = v.vehicle_id
  LEFT JOIN ({roles.ACCOUNTS}) a ON v.account_id = a.account_id
  LEFT JOIN (SELECT account_id, count(DISTINCT vehicle_id) AS fleet_size FROM ({roles.VEHICLES}) GROUP BY 1) z
    ON v.account_id = z.account_id"""

_DASHBOARD_SQL = f"""
  SELECT vehicle_id, company_name, operating_prefecture, fleet_size, vehicle_age_years,
         failure_probability, risk_percentage, maintenance_priority, expected_breakdown_cost_jpy, net_savings_jpy,
         expected_co2_saved_kg, expected_materials_saved_kg, expected_repair_avoided,
         1 AS feature_importance_rank, model_version, prediction_timestamp,
         length_of_study_time_step AS total_operating_hours,
         avg_exhaust_temperature_c, peak_exhaust_temperature_c, avg_dpf_differential_pressure_kpa,
         peak_dpf_differential_pressure_kpa, avg_engine_soot_mass_index, peak_engine_soot_mass_index
  FROM ({SCORES_SQL.format(relation=_FLEET_SQL)})"""


def whole_fleet(spark, sf_dir):
    """Labelled features joined with master data and the stand-in probability."""
    customer = table(spark, sf_dir, "customer")
    assembled = X.assemble(roles.specs(customer), roles.labels(customer), features(spark, sf_dir))
    sized = J.accounts_with_size(accounts(spark, sf_dir), vehicles(spark, sf_dir))
    fleet = G.operational_metrics(J.fleet_master(assembled, vehicles(spark, sf_dir), sized))
    return fleet.withColumn("probability", roles.probability_stand_in(F.col("vehicle_id")))


@query("dashboard_extract", _DASHBOARD_SQL)
def dashboard_extract(spark, sf_dir):
    ranked = D.rank_importance(importance(spark, sf_dir))
    return G.dashboard_extract(fleet_scores_of(whole_fleet(spark, sf_dir)), ranked)


@query("dashboard_rename", f"""
  SELECT vehicle_id, {", ".join(f'"{s}" AS "{a}"' for a, s in P.DASHBOARD_ALIASES.items()
                                if s.startswith("s_") and s[2:7] in roles.SENSORS)}
  FROM (SELECT * REPLACE ({", ".join(f'round_even("{s}", 6) AS "{s}"' for s in P.DASHBOARD_ALIASES.values()
                                     if s.startswith("s_") and s[2:7] in roles.SENSORS)}) FROM ({_FEATURES_SQL}))""")
def dashboard_rename(spark, sf_dir):
    renamed = G.rename_for_dashboard(features(spark, sf_dir))
    return rounded(G.select_available(renamed, ["vehicle_id", *P.DASHBOARD_ALIASES]))


_EXTRACT_SQL = f"""
  SELECT vehicle_id AS "Vehicle Id", CAST(coalesce(in_study_repair, -1) AS INTEGER) AS "Actual",
         CAST(probability >= 0.05 AS INTEGER) AS "Predicted", round_even(probability, 4) AS "Failure Probability",
         {_TIER} AS "Maintenance Priority", '{P.MODEL_VERSION}' AS "Model Version",
         '{STAMP}' AS "Prediction Timestamp"
  FROM ({roles.SCORED})"""


def extract(spark, sf_dir):
    """The stand-in never reaches 0.5, so the label threshold is the high-risk one here."""
    return G.predictions_extract(
        roles.scored(table(spark, sf_dir, "customer")), threshold=P.RISK.high, scored_at=scored_at()
    )


@query("predictions_extract", _EXTRACT_SQL)
def predictions_extract(spark, sf_dir):
    return extract(spark, sf_dir)


@query("scoring_export", f"""
  SELECT e."Vehicle Id", e."Failure Probability", e."Maintenance Priority", true AS "Approximate", t.n AS "Tier Vehicles"
  FROM ({_EXTRACT_SQL}) e JOIN (
    SELECT "Maintenance Priority" AS tier, count(*) AS n FROM ({_EXTRACT_SQL}) GROUP BY 1) t
  ON e."Maintenance Priority" = t.tier""")
def scoring_export(spark, sf_dir):
    """Extract and tier summary of one export, side by side: every vehicle with the size of its tier."""
    scored = roles.scored(table(spark, sf_dir, "customer"))
    rows, summary = G.scoring_export(scored, True, threshold=P.RISK.high, scored_at=scored_at())
    tiers = summary.select(F.col("Priority").alias("Maintenance Priority"), F.col("Vehicle Count").alias("Tier Vehicles"))
    return rows.join(tiers, "Maintenance Priority").select(
        "Vehicle Id", "Failure Probability", "Maintenance Priority", "Approximate", "Tier Vehicles")


@query("misclassified", f"""
  SELECT count(*) FILTER (WHERE "Actual" = 0 AND "Predicted" = 1) AS false_positives,
         count(*) FILTER (WHERE "Actual" = 1 AND "Predicted" = 0) AS false_negatives
  FROM ({_EXTRACT_SQL})""")
def misclassified(spark, sf_dir):
    return G.misclassified(extract(spark, sf_dir))


@query("risk_tier_summary", f"""
  SELECT maintenance_priority AS "Priority", count(vehicle_id) AS "Vehicle Count",
         round_even(avg(failure_probability), 4) AS "Average Probability",
         round_even(avg(expected_breakdown_cost_jpy), 0) AS "Average Expected Breakdown Cost JPY",
         round_even(avg(net_savings_jpy), 0) AS "Average Net Savings JPY",
         round_even(avg(expected_co2_saved_kg), 2) AS "Average Expected CO2 Saved KG"
  FROM ({SCORES_SQL.format(relation=roles.SCORED)}) GROUP BY 1 ORDER BY 3 DESC""")
def risk_tier_summary(spark, sf_dir):
    return G.risk_tier_summary(fleet_scores_of(roles.scored(table(spark, sf_dir, "customer"))))


@query("fleet_risk_summary", rounded_sql(f"""
  SELECT avg(risk_percentage) AS average_risk_percentage,
         count(*) FILTER (WHERE risk_percentage >= 5.0) AS high_risk_vehicles,
         count(*) FILTER (WHERE risk_percentage >= 3.0 AND risk_percentage < 5.0) AS medium_risk_vehicles,
         sum(expected_co2_saved_kg) AS expected_co2_saved_kg, sum(net_savings_jpy) AS net_savings_jpy
  FROM ({SCORES_SQL.format(relation=roles.SCORED)})""",
    ("average_risk_percentage", "expected_co2_saved_kg", "net_savings_jpy")))
def fleet_risk_summary(spark, sf_dir):
    return rounded(G.fleet_risk_summary(fleet_scores_of(roles.scored(table(spark, sf_dir, "customer")))))
