"""Master data: joins, key checks, account assignment, label handling, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.catalog.features import double_features, wide_statistics_sql
from fleetlens.catalog.registry import query, rounded, rounded_sql
from fleetlens.operators import features as X
from fleetlens.operators import joins as J
from fleetlens.operators import scoring as G
from fleetlens.operators import splits as S
from fleetlens.sources import roles
from fleetlens.sources.roles import table

_FEATURES_SQL = wide_statistics_sql(roles.READOUTS_WIDE, roles.SENSORS)


def features(spark, sf_dir):
    return X.wide_features(roles.readouts_wide(table(spark, sf_dir, "events")))


def vehicles(spark, sf_dir):
    return roles.vehicles(table(spark, sf_dir, "customer"))


def renumbered(df, key, other, by=1000):
    """Every row, with keys moved where ``other`` holds, so that both matched and unmatched keys reach a join."""
    return df.withColumn(key, F.when(other, F.col(key) + by).otherwise(F.col(key)))


def accounts(spark, sf_dir):
    return roles.accounts(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))


@query("specs_with_labels",
       f"SELECT s.*, l.* EXCLUDE (vehicle_id) FROM ({roles.SPECS}) s JOIN ({roles.LABELS}) l USING (vehicle_id)")
def specs_with_labels(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return X.rename_specs(J.specs_with_labels(roles.specs(customer), roles.labels(customer)))


@query("fleet_master", rounded_sql(f"""
  SELECT f.*, v.account_id, v.vehicle_age_years, a.company_name, a.operating_prefecture
  FROM ({_FEATURES_SQL}) f JOIN ({roles.VEHICLES}) v ON f.vehicle_id = v.vehicle_id
  LEFT JOIN (SELECT * REPLACE (CASE WHEN account_id < 20 THEN account_id ELSE account_id + 1000 END AS account_id)
             FROM ({roles.ACCOUNTS})) a ON v.account_id = a.account_id
  """, double_features(roles.SENSORS)))
def fleet_master(spark, sf_dir):
    """Accounts of the last five nations have other ids here, so their vehicles keep NULL account columns."""
    known = renumbered(accounts(spark, sf_dir), P.ACCOUNT, F.col(P.ACCOUNT) >= 20)
    return rounded(J.fleet_master(features(spark, sf_dir), vehicles(spark, sf_dir), known))


@query("local_fleet", f"""
  SELECT s.vehicle_id, s.spec_0, CAST(coalesce(l.in_study_repair, 0) AS INTEGER) AS in_study_repair,
         l.length_of_study_time_step
  FROM ({roles.SPECS}) s LEFT JOIN (
    SELECT * REPLACE (CASE WHEN vehicle_id % 3 = 0 THEN vehicle_id + 1000000000000 ELSE vehicle_id END AS vehicle_id)
    FROM ({roles.LABELS})) l
  ON s.vehicle_id = l.vehicle_id""")
def local_fleet(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    partial = renumbered(roles.labels(customer), P.ID, F.col(P.ID) % 3 == 0, 10**12)
    return X.rename_specs(J.local_fleet(roles.specs(customer), partial))


@query("local_fleet_unlabeled",
       f"SELECT vehicle_id, spec_0, 0 AS in_study_repair, 0 AS length_of_study_time_step FROM ({roles.SPECS})")
def local_fleet_unlabeled(spark, sf_dir):
    """The label file lacks the label column."""
    customer = table(spark, sf_dir, "customer")
    return X.rename_specs(J.local_fleet(roles.specs(customer), roles.labels(customer).drop(P.LABEL)))


@query("fleet_size", f"""
  SELECT account_id, count(DISTINCT vehicle_id) AS fleet_size FROM ({roles.VEHICLES})
  WHERE account_id IS NOT NULL GROUP BY account_id""")
def fleet_size(spark, sf_dir):
    return J.fleet_sizes(vehicles(spark, sf_dir))


@query("accounts_with_size", f"""
  SELECT a.*, f.fleet_size FROM ({roles.ACCOUNTS}) a LEFT JOIN (
    SELECT CASE WHEN account_id % 6 = 0 THEN account_id + 1000 ELSE account_id END AS account_id,
           count(DISTINCT vehicle_id) AS fleet_size FROM ({roles.VEHICLES}) GROUP BY 1) f ON a.account_id = f.account_id""")
def accounts_with_size(spark, sf_dir):
    """Every sixth account has no vehicle here; its vehicles belong to accounts that are not listed."""
    some = renumbered(vehicles(spark, sf_dir), P.ACCOUNT, F.col(P.ACCOUNT) % 6 == 0)
    return J.accounts_with_size(accounts(spark, sf_dir), some)


@query("active_accounts", f"SELECT count(DISTINCT account_id) AS active_accounts FROM ({roles.VEHICLES})")
def active_accounts(spark, sf_dir):
    return J.active_accounts(vehicles(spark, sf_dir))


@query("orphan_vehicles", f"""
  SELECT * FROM ({roles.VEHICLES}) WHERE account_id IS NOT NULL
  AND account_id NOT IN (
    SELECT CASE WHEN account_id < 20 THEN account_id ELSE account_id + 1000 END FROM ({roles.ACCOUNTS}))""")
def orphan_vehicles(spark, sf_dir):
    known = renumbered(accounts(spark, sf_dir), P.ACCOUNT, F.col(P.ACCOUNT) >= 20)
    return J.orphans(vehicles(spark, sf_dir), known, P.ACCOUNT)


@query("duplicate_keys", """
  SELECT l_suppkey, l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
  GROUP BY ALL HAVING count(*) > 1 OR l_suppkey IS NULL OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def duplicate_keys(spark, sf_dir):
    return J.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_orderkey", "l_linenumber")


@query("distinct_ids", f"SELECT DISTINCT vehicle_id FROM ({roles.READOUTS_LONG}) ORDER BY vehicle_id")
def distinct_ids(spark, sf_dir):
    return J.distinct_ids(roles.readouts_long(table(spark, sf_dir, "events")))


@query("weighted_assignment", f"""
  WITH w AS (
    SELECT c_nationkey AS account_id, count(*) AS weight FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1),
  i AS (
    SELECT account_id, CAST(sum(weight) OVER (ORDER BY account_id) - weight AS DOUBLE) / sum(weight) OVER () AS low,
           CAST(sum(weight) OVER (ORDER BY account_id) AS DOUBLE) / sum(weight) OVER () AS high FROM w),
  v AS (
    SELECT c_custkey AS vehicle_id,
           CAST(CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u
    FROM customer)
  SELECT v.vehicle_id, i.account_id FROM v JOIN i ON v.u >= i.low AND v.u < i.high""")
def weighted_assignment(spark, sf_dir):
    """An account's weight is its number of orders."""
    ordered = table(spark, sf_dir, "orders").join(vehicles(spark, sf_dir), F.col("o_custkey") == F.col(P.ID))
    weights = ordered.groupBy(P.ACCOUNT).agg(F.count(F.lit(1)).alias("weight"))
    ids = vehicles(spark, sf_dir).select("vehicle_id")
    return J.assign_accounts(ids, J.account_intervals(weights))


# --- labels ---------------------------------------------------------------------------------------


@query("label_cleaning", f"""
  SELECT vehicle_id, CAST(in_study_repair AS INTEGER) AS in_study_repair, length_of_study_time_step
  FROM ({roles.LABELS}) WHERE in_study_repair IS NOT NULL""")
def label_cleaning(spark, sf_dir):
    return S.drop_unlabeled(roles.labels(table(spark, sf_dir, "customer")))


@query("label_default", f"""
  SELECT vehicle_id, CAST(coalesce(in_study_repair, 0) AS INTEGER) AS in_study_repair, length_of_study_time_step
  FROM ({roles.LABELS})""")
def label_default(spark, sf_dir):
    return J.default_label(roles.labels(table(spark, sf_dir, "customer")))


@query("fill_missing_columns", f"""
  SELECT vehicle_id, spec_0, CAST(0 AS DOUBLE) AS s_397_0_mean, '0' AS spec_1 FROM ({roles.SPECS})""")
def fill_missing_columns(spark, sf_dir):
    specs = X.rename_specs(roles.specs(table(spark, sf_dir, "customer")))
    return G.fill_missing_columns(specs, {"spec_0": "string", "s_397_0_mean": "double", "spec_1": "string"})


@query("target_distribution",
       f"SELECT in_study_repair, count(*) AS samples FROM ({roles.LABELS}) GROUP BY 1 ORDER BY 1 NULLS FIRST")
def target_distribution(spark, sf_dir):
    return S.target_distribution(roles.labels(table(spark, sf_dir, "customer")))


@query("class_ratio", f"""
  SELECT CAST(coalesce(count(*) FILTER (WHERE in_study_repair = 0)
         / nullif(count(*) FILTER (WHERE in_study_repair = 1), 0), 15.0) AS DOUBLE) AS scale_pos_weight
  FROM ({roles.LABELS})""")
def class_ratio(spark, sf_dir):
    return S.class_ratio(roles.labels(table(spark, sf_dir, "customer")))


@query("class_weights", f"""
  SELECT in_study_repair, samples, sum(samples) OVER () / (count(*) OVER () * samples) AS weight FROM (
    SELECT in_study_repair, count(*) AS samples FROM ({roles.LABELS}) WHERE in_study_repair IS NOT NULL GROUP BY 1)""")
def class_weights(spark, sf_dir):
    return S.balanced_weights(roles.labels(table(spark, sf_dir, "customer")))


_POSITIONS = f"""
  SELECT vehicle_id, in_study_repair,
         row_number() OVER (PARTITION BY in_study_repair ORDER BY md5(CAST(vehicle_id AS VARCHAR)), vehicle_id) AS r,
         count(*) OVER (PARTITION BY in_study_repair) AS n
  FROM ({roles.LABELS}) WHERE in_study_repair IS NOT NULL"""


def labelled(spark, sf_dir):
    return S.drop_unlabeled(roles.labels(table(spark, sf_dir, "customer"))).select(P.ID, P.LABEL)


@query("stratified_split", f"SELECT vehicle_id, in_study_repair, r <= ceil(CAST(0.2 AS DOUBLE) * n) AS is_test FROM ({_POSITIONS})")
def stratified_split(spark, sf_dir):
    return S.stratified_split(labelled(spark, sf_dir))


@query("stratified_folds", f"SELECT vehicle_id, in_study_repair, CAST(r % 5 AS INTEGER) AS fold FROM ({_POSITIONS})")
def stratified_folds(spark, sf_dir):
    return S.stratified_folds(labelled(spark, sf_dir))
