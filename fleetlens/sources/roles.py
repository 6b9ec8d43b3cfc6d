"""Roles of the entities (readouts, specifications, labels, accounts) played by the TPC-H-like tables.

Each role exists twice: as a DataFrame and as the SQL text of the same relation, which the oracle queries use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SENSORS = {"click": "397_0", "error": "397_1", "view": "459_0", "purchase": "291_0", "signup": "100_0"}
SENSORS = ("100_0", "291_0", "397_0", "397_1", "459_0")
FLEET_SENSOR_COUNT = 105
_BENCH_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
# A factor with many digits keeps the means of two-digit prices off the rounding ties of the comparison.
_GAIN = 0.73105857863


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readouts_long(events: DataFrame) -> DataFrame:
    """Every eleventh reading is missing."""
    sensor = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_SENSORS.items()])
    return events.select(
        F.col("user_id").alias("vehicle_id"),
        F.col("event_id").cast("double").alias("time_step"),
        sensor.alias("sensor"),
        F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("value"),
    )


def readouts_wide(events: DataFrame) -> DataFrame:
    """One column per sensor; an event fills one of them and leaves the others missing."""
    by_sensor = {v: k for k, v in EVENT_SENSORS.items()}
    present = F.col("event_id") % 11 != 0
    return events.select(
        F.col("user_id").alias("vehicle_id"),
        F.col("event_id").cast("double").alias("time_step"),
        *[F.when(present & (F.col("event_type") == by_sensor[s]), F.col("value")).alias(s) for s in SENSORS],
    )


def fleet_sensors(count: int = FLEET_SENSOR_COUNT) -> list[str]:
    """Sensor names of the production-width readouts: eight bins per family."""
    return [f"{100 + i // 8}_{i % 8}" for i in range(count)]


def fleet_measures(count: int = FLEET_SENSOR_COUNT) -> dict[str, Column]:
    """The ``count`` sensors over the columns of ``fleet_rows``: four measures, scaled."""
    measures = {}
    for i, name in enumerate(fleet_sensors(count)):
        measure = F.col(_BENCH_MEASURES[i % 4]) / F.lit(1000.0 if i % 4 == 1 else 1.0)
        measures[name] = F.when((F.col("l_partkey") + i) % 11 != 0, measure * F.lit(_GAIN * (1.0 + i)))
    return measures


def fleet_rows(lineitem: DataFrame) -> DataFrame:
    """Suppliers as vehicles, and what their sensors are worked out from.

    Line numbers repeat within an order, so part and quantity complete the time to a key.
    """
    return lineitem.select(
        F.col("l_suppkey").alias("vehicle_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber") + F.col("l_partkey") / F.lit(1048576.0)
         + F.col("l_quantity") / F.lit(1073741824.0)).alias("time_step"),
        "l_partkey", *_BENCH_MEASURES,
    )


def fleet_readouts(lineitem: DataFrame, count: int = FLEET_SENSOR_COUNT) -> DataFrame:
    """Production-width readouts: every sensor a column."""
    return fleet_rows(lineitem).select(
        "vehicle_id", "time_step", *[cell.alias(name) for name, cell in fleet_measures(count).items()])


def fleet_readouts_sql(count: int = FLEET_SENSOR_COUNT) -> str:
    columns = []
    for i, name in enumerate(fleet_sensors(count)):
        divisor = "1000.0" if i % 4 == 1 else "1.0"
        measure = f"({_BENCH_MEASURES[i % 4]} / CAST({divisor} AS DOUBLE)) * CAST({_GAIN * (1.0 + i)!r} AS DOUBLE)"
        columns.append(f'CASE WHEN (l_partkey + {i}) % 11 <> 0 THEN {measure} END AS "{name}"')
    return (
        "SELECT l_suppkey AS vehicle_id, l_orderkey * 10 + l_linenumber "
        "+ CAST(l_partkey AS DOUBLE) / CAST(1048576.0 AS DOUBLE) "
        "+ l_quantity / CAST(1073741824.0 AS DOUBLE) AS time_step, "
        + ", ".join(columns) + " FROM lineitem"
    )


def specs(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").alias("vehicle_id"), F.col("c_mktsegment").alias("Spec_0"))


def labels(customer: DataFrame) -> DataFrame:
    repaired = F.when(F.col("c_acctbal") < 0, F.lit(1)).otherwise(F.lit(0))
    return customer.select(
        F.col("c_custkey").alias("vehicle_id"),
        F.when(F.col("c_custkey") % 50 != 0, repaired).alias("in_study_repair"),
        F.abs(F.col("c_acctbal")).alias("length_of_study_time_step"),
    )


def vehicles(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("vehicle_id"),
        F.col("c_nationkey").alias("account_id"),
        (F.col("c_custkey") % 15 + 1).cast("double").alias("vehicle_age_years"),
    )


def accounts(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "inner").select(
        F.col("n_nationkey").alias("account_id"),
        F.col("n_name").alias("company_name"),
        F.col("r_name").alias("operating_prefecture"),
    )


def probability_stand_in(vehicle_id):
    """Deterministic probability in [0, 0.1) that straddles both risk thresholds."""
    return ((vehicle_id * 7919) % 10007) / F.lit(100070.0)


def scored(customer: DataFrame) -> DataFrame:
    """(vehicle_id, in_study_repair, probability)."""
    return labels(customer).select(
        "vehicle_id", "in_study_repair", probability_stand_in(F.col("vehicle_id")).alias("probability")
    )


# --- the same roles as SQL ----------------------------------------------------------------------

_SENSOR_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_SENSORS.items()) + " END"

READOUTS_LONG = f"""
  SELECT user_id AS vehicle_id, CAST(event_id AS DOUBLE) AS time_step, {_SENSOR_CASE} AS sensor,
         CASE WHEN event_id % 11 <> 0 THEN value END AS value
  FROM events"""

READOUTS_WIDE = "\n  SELECT user_id AS vehicle_id, CAST(event_id AS DOUBLE) AS time_step, " + ", ".join(
    f"CASE WHEN event_id % 11 <> 0 AND event_type = '{k}' THEN value END AS \"{v}\""
    for v, k in sorted((v, k) for k, v in EVENT_SENSORS.items())
) + " FROM events"

SPECS = "SELECT c_custkey AS vehicle_id, c_mktsegment AS spec_0 FROM customer"

LABELS = """
  SELECT c_custkey AS vehicle_id,
         CASE WHEN c_custkey % 50 <> 0 THEN CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END END AS in_study_repair,
         abs(c_acctbal) AS length_of_study_time_step
  FROM customer"""

VEHICLES = """
  SELECT c_custkey AS vehicle_id, c_nationkey AS account_id,
         CAST(c_custkey % 15 + 1 AS DOUBLE) AS vehicle_age_years
  FROM customer"""

ACCOUNTS = """
  SELECT n_nationkey AS account_id, n_name AS company_name, r_name AS operating_prefecture
  FROM nation JOIN region ON n_regionkey = r_regionkey"""

PROBABILITY = "CAST((c_custkey * 7919) % 10007 AS DOUBLE) / CAST(100070.0 AS DOUBLE)"

SCORED = f"""
  SELECT c_custkey AS vehicle_id,
         CASE WHEN c_custkey % 50 <> 0 THEN CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END END AS in_study_repair,
         {PROBABILITY} AS probability
  FROM customer"""
