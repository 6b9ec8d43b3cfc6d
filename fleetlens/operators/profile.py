"""Sensor profiling: step differences, monotonicity and inferred role."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.functions.domain import sensor_role
from fleetlens.functions.naming import family_of, sensor_columns
from fleetlens.functions.numeric import finite_or_null
from fleetlens.operators.running import (
    default_parts, heavy_groups, quantile_boundaries, with_previous, with_range_bucket,
)


def first_rows(readouts: DataFrame, n: int) -> DataFrame:
    """The first ``n`` readouts; Spark has no file order, so time and id define it."""
    return readouts.orderBy(P.TIME, P.ID).limit(n)


def _paired(rows: DataFrame, by: Sequence[str], value: Column, segments: int | None) -> DataFrame:
    """(by, time, value, previous): rows with their predecessors' value.

    Rows are moved and sorted before ``value`` is worked out, so they may be narrower than it. The rows of a vehicle
    lie together, but for vehicles with more than a segment.
    """
    parts = segments or default_parts(rows)
    heavy = heavy_groups(rows, P.ID, parts)
    boundaries = quantile_boundaries(rows, P.TIME, parts) if heavy else []
    order, cells = [*by, P.TIME], [*by, P.TIME, value.alias("value")]
    if not boundaries:
        together = rows.repartition(default_parts(rows), P.ID).sortWithinPartitions(*order)
        return with_previous(together.select(cells), by, [P.TIME], "value")
    ranged = with_range_bucket(rows, P.TIME, boundaries, "_segment").withColumn(
        "_segment", F.when(F.col(P.ID).isin(heavy), F.col("_segment")).otherwise(F.lit(0.0)))
    dealt = ranged.repartition(default_parts(rows), P.ID, "_segment").sortWithinPartitions(*by, "_segment", P.TIME)
    return with_previous(dealt.select(*cells, "_segment"), by, [P.TIME], "value", F.col("_segment")).drop("_segment")


def step_differences(long: DataFrame, segments: int | None = None) -> DataFrame:
    """(vehicle_id, sensor, time_step, difference) between consecutive rows of one series.

    NULL where either side is missing; missing rows are not skipped. A vehicle with more rows than a segment has on
    average is cut into ``segments`` time ranges of equal row count (default: one per shuffle partition), so one
    vehicle with a third of all rows is not one task.
    """
    rows = long.where(F.col(P.ID).isNotNull()).select(P.ID, "sensor", P.TIME, "value")
    paired = _paired(rows, [P.ID, "sensor"], finite_or_null(F.col("value").cast("double")), segments)
    return paired.select(P.ID, "sensor", P.TIME, (F.col("value") - F.col("previous")).alias("difference"))


def wide_step_differences(
    wide: DataFrame, sensors: Sequence[str] | None = None, segments: int | None = None,
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``step_differences`` of wide readouts: one look-back per readout for all sensors, unfolded afterwards.

    With ``measures`` the sensors are its names, worked out from the other columns of ``wide`` once its rows are in
    place, so that rows of few columns are moved and sorted.
    """
    if not sensors:
        sensors = measures if measures is not None else sensor_columns(wide.columns)
    sensors = list(sensors)
    kept = [c for c in wide.columns if c not in (P.ID, P.TIME)] if measures is not None else sensors
    cells = [measures[s] if measures is not None else F.col(f"`{s}`") for s in sensors]
    rows = wide.where(F.col(P.ID).isNotNull()).select(P.ID, P.TIME, *[F.col(f"`{c}`") for c in kept])
    paired = _paired(rows, [P.ID], F.array(*[c.cast("double") for c in cells]), segments)
    names = F.array(*[F.lit(s) for s in sensors])
    return (
        paired.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(sensors) - 1))).alias("_i"))
        .select(
            P.ID, P.TIME, names[F.col("_i")].alias("sensor"),
            F.col("value")[F.col("_i")].alias("_value"), F.col("previous")[F.col("_i")].alias("_before"),
        )
        .select(P.ID, P.TIME, "sensor", (finite_or_null(F.col("_value")) - finite_or_null(F.col("_before"))).alias("difference"))
    )


def sensor_monotonicity(differences: DataFrame, sensors: DataFrame) -> DataFrame:
    """(sensor, monotonicity): mean over vehicles of the share of differences >= 0.

    Vehicles without any difference do not count; a sensor without any such vehicle scores 0.0.
    """
    shares = (
        differences.where(F.col("difference").isNotNull())
        .groupBy(P.ID, "sensor")
        .agg(F.avg((F.col("difference") >= 0).cast("double")).alias("share"))
        .groupBy("sensor").agg(F.avg("share").alias("monotonicity"))
    )
    return sensors.join(shares, "sensor", "left").fillna(0.0, ["monotonicity"])


def _profile(differences: DataFrame, sensors: DataFrame) -> DataFrame:
    per_family = (
        sensor_monotonicity(differences, sensors)
        .withColumn("family", family_of(F.col("sensor")))
        .groupBy("family").agg(
            F.count(F.lit(1)).alias("n_bins"),
            F.avg("monotonicity").alias("monotonicity"),
            F.sort_array(F.collect_set("sensor")).alias("sensors"),
        )
    )
    return per_family.select(
        "family", "n_bins", "monotonicity",
        sensor_role(F.col("n_bins"), F.col("monotonicity")).alias("role"), "sensors",
    ).orderBy(F.col("family").cast("int"))


def sensor_profile(long: DataFrame, segments: int | None = None) -> DataFrame:
    """One row per family: bins, mean monotonicity over bins, role and its sensors (a handful per family)."""
    return _profile(step_differences(long, segments), long.select("sensor").distinct())


def wide_sensor_profile(
    wide: DataFrame, segments: int | None = None, measures: Mapping[str, Column] | None = None
) -> DataFrame:
    sensors = list(measures) if measures is not None else sensor_columns(wide.columns)
    listed = wide.sparkSession.createDataFrame([(s,) for s in sensors], "sensor string")
    return _profile(wide_step_differences(wide, sensors, segments, measures), listed)
