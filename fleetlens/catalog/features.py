"""Sensor statistics, wide features and sensor profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.catalog.registry import query, rounded, rounded_sql
from fleetlens.operators import features as X
from fleetlens.operators import profile as R
from fleetlens.sources import roles
from fleetlens.sources.roles import table

_DOUBLES = ("mean", "max", "min", "std", "last", "range", "trend_slope", "coeff_variation")


def statistics_cells(value: str = "value", time: str = "time_step") -> dict[str, str]:
    """SQL of the nine statistics of one value column."""
    valid_time = f"CASE WHEN {value} IS NOT NULL THEN {time} END"
    spread = f"stddev_pop({value})"
    return {
        "mean": f"avg({value})",
        "max": f"max({value})",
        "min": f"min({value})",
        "std": spread,
        "last": f"arg_max({value}, {time}) FILTER (WHERE {value} IS NOT NULL)",
        "range": f"max({value}) - min({value})",
        "missing_count": f"CAST(CASE WHEN count({value}) > 0 THEN count(*) - count({value}) ELSE 0 END AS BIGINT)",
        "trend_slope": (
            f"CASE WHEN count({value}) >= 2 AND count({value}) * count({value}) * var_pop({valid_time}) >= 1e-12 "
            f"THEN covar_pop({value}, {time}) / var_pop({valid_time}) ELSE 0.0 END"
        ),
        "coeff_variation": (
            f"CASE WHEN count({value}) > 0 THEN CASE WHEN abs(avg({value})) > 1e-10 "
            f"THEN {spread} / abs(avg({value})) ELSE 0.0 END END"
        ),
    }


def long_statistics_sql(relation: str = roles.READOUTS_LONG) -> str:
    cells = ", ".join(f'{sql} AS "{name}"' for name, sql in statistics_cells().items())
    return (
        f"SELECT vehicle_id, sensor, count(value) AS n, {cells} FROM ({relation}) "
        "WHERE vehicle_id IS NOT NULL GROUP BY vehicle_id, sensor"
    )


def wide_statistics_sql(relation: str, sensors: Sequence[str]) -> str:
    cells = []
    for sensor in sensors:
        cells += [
            f'{sql} AS "{X.feature_name(sensor, name)}"' for name, sql in statistics_cells(f'"{sensor}"').items()
        ]
    return f"SELECT vehicle_id, {', '.join(cells)} FROM ({relation}) GROUP BY vehicle_id"


def pivoted_statistics_sql(sensors: Sequence[str]) -> str:
    """Wide features from long readouts: a vehicle without rows for a sensor reads as never valid."""
    cells = []
    for sensor in sensors:
        for stat in P.STATISTICS:
            picked = f"max(\"{stat}\") FILTER (WHERE sensor = '{sensor}')"
            if stat == "missing_count":
                picked = f"CAST(coalesce({picked}, 0) AS BIGINT)"
            elif stat == "trend_slope":
                picked = f"coalesce({picked}, 0.0)"
            cells.append(f'{picked} AS "{X.feature_name(sensor, stat)}"')
    return f"SELECT vehicle_id, {', '.join(cells)} FROM ({long_statistics_sql()}) GROUP BY vehicle_id"


def double_features(sensors: Sequence[str]) -> list[str]:
    return [X.feature_name(s, stat) for s in sensors for stat in P.STATISTICS if stat != "missing_count"]


@query("sensor_stats_long", rounded_sql(long_statistics_sql(), _DOUBLES))
def sensor_stats_long(spark, sf_dir):
    return rounded(X.long_statistics(roles.readouts_long(table(spark, sf_dir, "events"))))


@query("sensor_state_merge", rounded_sql(long_statistics_sql(), _DOUBLES, 7))
def sensor_state_merge(spark, sf_dir):
    """States of two halves of the readouts, merged, equal the statistics of the whole."""
    long = roles.readouts_long(table(spark, sf_dir, "events"))
    even = X.running_state(long.where(F.col("time_step") % 2 == 0))
    odd = X.running_state(long.where(F.col("time_step") % 2 != 0))
    return rounded(X.finish_states(X.merge_states(even.unionByName(odd))), 7)


@query("sensor_running_state", rounded_sql("""
  SELECT vehicle_id, sensor, count(value) AS "count", coalesce(sum(value), 0.0) AS "sum",
         coalesce(sum(value * value), 0.0) AS sum_sq, min(value) AS "min", max(value) AS "max",
         count(*) - count(value) AS missing,
         coalesce(sum(CASE WHEN value IS NOT NULL THEN time_step END), 0.0) AS sum_x,
         coalesce(sum(time_step * value), 0.0) AS sum_xy,
         coalesce(sum(CASE WHEN value IS NOT NULL THEN time_step * time_step END), 0.0) AS sum_x_sq,
         max(CASE WHEN value IS NOT NULL THEN time_step END) AS last_time,
         arg_max(value, time_step) FILTER (WHERE value IS NOT NULL) AS last_val
  FROM (""" + roles.READOUTS_LONG + """) GROUP BY vehicle_id, sensor""",
    ("sum", "sum_sq", "min", "max", "sum_x", "sum_xy", "sum_x_sq", "last_time", "last_val"), 3))
def sensor_running_state(spark, sf_dir):
    """The published sums; the moments beside them are checked through the statistics they give."""
    state = X.running_state(roles.readouts_long(table(spark, sf_dir, "events")))
    return rounded(state.drop("mean", "mean_x", "m2", "m2_x", "c_xy"), 3)


@query("sensor_state_epoch", f"""
  SELECT vehicle_id, sensor, round_even(stddev_pop(value), 3) AS std,
         round_even(CASE WHEN count(value) >= 2 THEN coalesce(regr_slope(value, time_step), 0.0) ELSE 0.0 END, 3) AS slope
  FROM ({roles.READOUTS_LONG}) GROUP BY vehicle_id, sensor""")
def sensor_state_epoch(spark, sf_dir):
    """Merged states at times in epoch milliseconds and values near 1e9: deviations and slopes stay what they were."""
    shifted = roles.readouts_long(table(spark, sf_dir, "events")).withColumns({
        "time_step": F.col("time_step") * 1000.0 + F.lit(1.7e12), "value": F.col("value") + F.lit(1e9)})
    parts = [X.running_state(shifted.where(F.floor(F.col("time_step") / 1000) % 3 == k)) for k in range(3)]
    merged = X.finish_states(X.merge_states(parts[0].unionByName(parts[1]).unionByName(parts[2])))
    return rounded(merged.select("vehicle_id", "sensor", "std", (F.col("trend_slope") * 1000.0).alias("slope")), 3)


@query("unpivot_readouts", f"""
  SELECT vehicle_id, time_step, sensor, value FROM ({roles.READOUTS_WIDE}) AS w
  UNPIVOT INCLUDE NULLS (value FOR sensor IN ({', '.join(f'"{s}"' for s in roles.SENSORS)}))""")
def unpivot_readouts(spark, sf_dir):
    return X.to_long(roles.readouts_wide(table(spark, sf_dir, "events")))


@query("sensor_families", f"""
  SELECT regexp_extract(sensor, '^(\\d+)_(\\d+)$', 1) AS family,
         count(DISTINCT CAST(regexp_extract(sensor, '^(\\d+)_(\\d+)$', 2) AS INTEGER)) AS n_bins
  FROM ({roles.READOUTS_LONG}) WHERE regexp_matches(sensor, '^(\\d+)_(\\d+)$') GROUP BY 1""")
def sensor_families(spark, sf_dir):
    return X.families_in(roles.readouts_long(table(spark, sf_dir, "events")))


@query("family_columns", f'SELECT vehicle_id, time_step, "397_0", "397_1" FROM ({roles.READOUTS_WIDE})')
def family_columns(spark, sf_dir):
    return X.select_family(roles.readouts_wide(table(spark, sf_dir, "events")), "397")


@query("sensor_order", f"""
  SELECT sensor, family, bin, row_number() OVER (ORDER BY family, bin) AS position FROM (
    SELECT DISTINCT sensor, CAST(regexp_extract(sensor, '^(\\d+)_(\\d+)$', 1) AS INTEGER) AS family,
           CAST(regexp_extract(sensor, '^(\\d+)_(\\d+)$', 2) AS INTEGER) AS bin
    FROM ({roles.READOUTS_LONG}))""")
def sensor_order(spark, sf_dir):
    """Sensors present, in numeric family and bin order; as many rows as there are sensor columns."""
    from pyspark.sql import Window as W

    sensor = F.col("sensor")
    found = roles.readouts_long(table(spark, sf_dir, "events")).select("sensor").distinct().select(
        sensor, X.family_of(sensor).cast("int").alias("family"), X.bin_of(sensor).alias("bin")
    )
    return found.withColumn("position", F.row_number().over(W.orderBy("family", "bin")))


@query("sensor_features_wide", rounded_sql(f"""
  SELECT s.*, l.in_study_repair, l.length_of_study_time_step, f.* EXCLUDE (vehicle_id)
  FROM ({roles.SPECS}) s JOIN ({roles.LABELS}) l ON s.vehicle_id = l.vehicle_id
  LEFT JOIN ({wide_statistics_sql(roles.READOUTS_WIDE, roles.SENSORS)}) f ON s.vehicle_id = f.vehicle_id
  """, double_features(roles.SENSORS)))
def sensor_features_wide(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    features = X.wide_features(roles.readouts_wide(table(spark, sf_dir, "events")))
    return rounded(X.assemble(roles.specs(customer), roles.labels(customer), features))


@query("sensor_features_from_long", rounded_sql(pivoted_statistics_sql(roles.SENSORS), double_features(roles.SENSORS)))
def sensor_features_from_long(spark, sf_dir):
    return rounded(X.features_from_long(roles.readouts_long(table(spark, sf_dir, "events")), roles.SENSORS))


@query("fleet_sensor_features", rounded_sql(
    wide_statistics_sql(roles.fleet_readouts_sql(), roles.fleet_sensors()), double_features(roles.fleet_sensors()), 3))
def fleet_sensor_features(spark, sf_dir):
    """Production width: 105 sensors, 945 feature columns per vehicle."""
    return rounded(X.wide_features(
        roles.fleet_rows(table(spark, sf_dir, "lineitem")), measures=roles.fleet_measures()), 3)


_DIFFERENCES = f"""
  SELECT vehicle_id, sensor, time_step, difference FROM (
    SELECT vehicle_id, sensor, time_step,
           value - lag(value) OVER (PARTITION BY vehicle_id, sensor ORDER BY time_step) AS difference,
           row_number() OVER (PARTITION BY vehicle_id, sensor ORDER BY time_step) AS r
    FROM ({roles.READOUTS_LONG})) WHERE r > 1"""

_MONOTONICITY = f"""
  SELECT s.sensor, coalesce(m.monotonicity, 0.0) AS monotonicity
  FROM (SELECT DISTINCT sensor FROM ({roles.READOUTS_LONG})) s LEFT JOIN (
    SELECT sensor, avg(share) AS monotonicity FROM (
      SELECT vehicle_id, sensor, avg(CASE WHEN difference >= 0 THEN 1.0 ELSE 0.0 END) AS share
      FROM ({_DIFFERENCES}) WHERE difference IS NOT NULL GROUP BY vehicle_id, sensor)
    GROUP BY sensor) m ON s.sensor = m.sensor"""


def profile_sql(monotonicity: str) -> str:
    family = "regexp_extract(sensor, '^(\\d+)_(\\d+)$', 1)"
    return f"""
      SELECT family, n_bins, round_even(m, 6) AS monotonicity,
             CASE WHEN m > 0.95 THEN '{P.ROLE_COUNTER}' WHEN n_bins >= 16 THEN '{P.ROLE_FINE}'
                  WHEN n_bins >= 10 THEN '{P.ROLE_MEDIUM}' WHEN n_bins >= 5 THEN '{P.ROLE_COARSE}'
                  ELSE '{P.ROLE_GAUGE}' END AS role, sensors
      FROM (SELECT {family} AS family, count(*) AS n_bins, avg(monotonicity) AS m,
                   string_agg(sensor, ',' ORDER BY sensor) AS sensors
            FROM ({monotonicity}) GROUP BY 1)"""


@query("step_differences", rounded_sql(_DIFFERENCES, ("difference",)))
def step_differences(spark, sf_dir):
    return rounded(R.step_differences(roles.readouts_long(table(spark, sf_dir, "events"))))


@query("monotonicity", rounded_sql(_MONOTONICITY, ("monotonicity",)))
def monotonicity(spark, sf_dir):
    long = roles.readouts_long(table(spark, sf_dir, "events"))
    return rounded(R.sensor_monotonicity(R.step_differences(long), long.select("sensor").distinct()))


@query("sensor_profile", profile_sql(_MONOTONICITY))
def sensor_profile(spark, sf_dir):
    profile = R.sensor_profile(roles.readouts_long(table(spark, sf_dir, "events")))
    return rounded(profile.withColumn("sensors", F.concat_ws(",", "sensors")))


_FLEET_NAMES = ", ".join(f'"{s}"' for s in roles.fleet_sensors())
_FLEET_MONOTONICITY = f"""
  SELECT s.sensor, coalesce(m.monotonicity, 0.0) AS monotonicity
  FROM (SELECT unnest([{', '.join(f"'{s}'" for s in roles.fleet_sensors())}]) AS sensor) s LEFT JOIN (
    SELECT sensor, avg(share) AS monotonicity FROM (
      SELECT vehicle_id, sensor, avg(CASE WHEN difference >= 0 THEN 1.0 ELSE 0.0 END) AS share
      FROM (SELECT vehicle_id, sensor,
                   value - lag(value) OVER (PARTITION BY vehicle_id, sensor ORDER BY time_step) AS difference
            FROM (SELECT * FROM ({roles.fleet_readouts_sql()}) AS w
                  UNPIVOT INCLUDE NULLS (value FOR sensor IN ({_FLEET_NAMES}))))
      WHERE difference IS NOT NULL GROUP BY vehicle_id, sensor)
    GROUP BY sensor) m ON s.sensor = m.sensor"""


@query("fleet_sensor_profile", profile_sql(_FLEET_MONOTONICITY))
def fleet_sensor_profile(spark, sf_dir):
    profile = R.wide_sensor_profile(roles.fleet_rows(table(spark, sf_dir, "lineitem")), measures=roles.fleet_measures())
    return rounded(profile.withColumn("sensors", F.concat_ws(",", "sensors")))


@query("first_readouts", f"SELECT * FROM ({roles.READOUTS_WIDE}) ORDER BY time_step, vehicle_id LIMIT 5000")
def first_readouts(spark, sf_dir):
    """The row-limited scan itself: the first 5 000 readouts in time order."""
    return R.first_rows(roles.readouts_wide(table(spark, sf_dir, "events")), 5_000)


@query("inf_to_null", """
  SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 5 = 0 OR event_id % 3 = 0 THEN NULL ELSE value END AS value
  FROM events""")
def inf_to_null(spark, sf_dir):
    value = (
        F.when(F.col("event_id") % 7 == 0, F.lit(float("inf")))
        .when(F.col("event_id") % 5 == 0, F.lit(float("-inf")))
        .when(F.col("event_id") % 3 == 0, F.lit(float("nan")))
        .otherwise(F.col("value"))
    )
    return X.infinities_to_null(table(spark, sf_dir, "events").select("event_id", value.alias("value")))
