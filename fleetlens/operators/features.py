"""Per-vehicle, per-sensor statistics and the wide feature table.

Wide readouts are folded into long form by a *numbered* sensor, aggregated once per (vehicle, sensor) with a
map-side combine, and pivoted against an explicit list. A hot vehicle therefore costs one partial row per sensor
and task, whatever share of the rows it has. The (vehicle_id, time_step) pair is the key of a readout
(``joins.duplicate_keys`` checks it); pass ``tie_break`` where it is not.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.functions.naming import bin_of, family_of, feature_name, sensor_columns
from fleetlens.functions.numeric import finite_or_null
from fleetlens.operators.running import default_parts, heavy_groups

_MIN_DENOMINATOR = 1e-12
_MIN_MEAN = 1e-10
_POSITION = "_sensor_position"


def to_long(wide: DataFrame, sensors: Sequence[str] | None = None) -> DataFrame:
    """(vehicle_id, time_step, sensor, value), missing values kept."""
    sensors = list(sensors) if sensors else sensor_columns(wide.columns)
    return wide.unpivot([P.ID, P.TIME], sensors, "sensor", "value")


def families_in(long: DataFrame) -> DataFrame:
    """Sensor families present in long readouts with their bin count, in numeric order."""
    return (
        long.select("sensor").distinct()
        .withColumn("family", family_of(F.col("sensor")))
        .where(F.col("family") != "")
        .groupBy("family").agg(F.countDistinct(bin_of(F.col("sensor"))).alias("n_bins"))
        .orderBy(F.col("family").cast("int"))
    )


def select_family(df: DataFrame, family: str) -> DataFrame:
    """Ids plus the sensor columns of one family, in bin order; ids alone when the family is unknown."""
    ids = [c for c in (P.ID, P.TIME) if c in df.columns]
    return df.select(*ids, *sensor_columns(df.columns, family))


def _together(rows: DataFrame) -> DataFrame:
    """Rows of a vehicle in one partition and next to each other.

    Vehicles with more than an even share of the rows are dealt by time over all partitions, and the aggregation that
    follows combines theirs where they lie. Of all others no partial result is ever shuffled, however many partitions.
    """
    heavy, by = heavy_groups(rows, P.ID), [P.ID]
    if heavy:
        by.append(F.when(F.col(P.ID).isin(heavy), F.xxhash64(P.TIME)).otherwise(F.lit(0).cast("long")))
    return rows.repartition(default_parts(rows), *by).sortWithinPartitions(P.ID)


def _numbered(
    wide: DataFrame, sensors: Sequence[str], measures: Mapping[str, Column] | None, *carried: str
) -> DataFrame:
    """One row per readout and sensor position.

    What is moved and sorted is one row per readout, as wide as the columns that ``measures`` are worked out from and
    not as the sensors. Sorted rows let the hash aggregation that follows touch one vehicle's entries at a time.
    """
    cells = [measures[s] if measures else F.col(f"`{s}`") for s in sensors]
    kept = [c for c in wide.columns if c not in (P.ID, P.TIME, *carried)] if measures else sensors
    rows = _together(wide.where(F.col(P.ID).isNotNull()).select(P.ID, P.TIME, *carried, *[F.col(f"`{c}`") for c in kept]))
    packed = rows.select(P.ID, P.TIME, *carried, F.array(*[c.cast("double") for c in cells]).alias("_values"))
    return (
        packed.select(
            P.ID, P.TIME, *carried, "_values",
            F.explode(F.sequence(F.lit(0), F.lit(len(sensors) - 1))).alias(_POSITION),
        )
        .select(P.ID, P.TIME, *carried, _POSITION, F.col("_values")[F.col(_POSITION)].alias("value"))
    )


def _aggregates(tie_break: Sequence[str] = ()) -> list[Column]:
    value = F.col("value")
    valid_time = F.when(value.isNotNull(), F.col(P.TIME))
    if tie_break:
        latest = F.max(F.when(value.isNotNull(), F.struct(P.TIME, *tie_break, "value")))["value"]
    else:
        latest = F.max_by(value, valid_time)
    return [
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
        F.stddev_pop(value).alias("std"),
        latest.alias("last"),
        F.count_if(value.isNull()).alias("missing"),
        F.covar_pop(value, valid_time).alias("covariance"),
        F.var_pop(valid_time).alias("time_variance"),
    ]


def _finish(n: Column, col: Callable[[str], Column]) -> dict[str, Column]:
    """The nine published statistics from aggregated columns ``col(name)``.

    A sensor that was never valid reports no missing rows and a flat trend.
    """
    mean = col("total") / n
    determined = (n >= 2) & (n * n * col("time_variance") >= F.lit(_MIN_DENOMINATOR))
    return {
        "mean": mean,
        "max": col("max"),
        "min": col("min"),
        "std": col("std"),
        "last": col("last"),
        "range": col("max") - col("min"),
        "missing_count": F.when(n > 0, col("missing")).otherwise(F.lit(0)).cast("long"),
        "trend_slope": F.when(determined, col("covariance") / col("time_variance")).otherwise(F.lit(0.0)),
        "coeff_variation": F.when(n > 0, F.when(F.abs(mean) > F.lit(_MIN_MEAN), col("std") / F.abs(mean))
                                  .otherwise(F.lit(0.0))),
    }


def _finished(aggregated: DataFrame, *keys: str | Column) -> DataFrame:
    return aggregated.select(P.ID, *keys, "n", *[c.alias(k) for k, c in _finish(F.col("n"), F.col).items()])


def _pivoted(statistics: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Finished long statistics, keyed by ``_prefix`` = ``s_<sensor>``, to ``s_<sensor>_<statistic>`` columns.

    Statistics are finished before the pivot, so the wide plan holds nothing but column references. Their narrow
    rows are brought together by vehicle first: the pivot is then local, instead of shuffling one full-width,
    mostly empty row per vehicle and sensor. The result stays partitioned by vehicle for the joins that follow.
    """
    prefixes = [feature_name(s, "")[:-1] for s in sensors]
    together = statistics.select(P.ID, "_prefix", *P.STATISTICS).repartition(P.ID)
    return together.groupBy(P.ID).pivot("_prefix", prefixes).agg(*[F.first(s).alias(s) for s in P.STATISTICS])


def long_statistics(long: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per (vehicle_id, sensor): valid count ``n`` and the nine statistics."""
    aggregated = (
        long.where(F.col(P.ID).isNotNull())
        .withColumn("value", finite_or_null(F.col("value").cast("double")))
        .groupBy(P.ID, "sensor").agg(*_aggregates(tie_break))
    )
    return _finished(aggregated, "sensor")


def features_from_long(long: DataFrame, sensors: Sequence[str], tie_break: Sequence[str] = ()) -> DataFrame:
    """Wide feature table from long readouts, for an explicit sensor list.

    A vehicle without any row for a sensor reads as if the sensor was never valid: no missing rows, flat trend.
    """
    sensors = list(sensors)
    if not sensors:
        return long.select(P.ID).limit(0)
    return features_of_statistics(long_statistics(long, tie_break), sensors)


def features_of_statistics(statistics: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Wide feature table from long statistics, for an explicit sensor list."""
    statistics = statistics.withColumn("_prefix", F.concat(F.lit("s_"), "sensor"))
    absent = {feature_name(s, "missing_count"): 0 for s in sensors} | {
        feature_name(s, "trend_slope"): 0.0 for s in sensors
    }
    return _pivoted(statistics, sensors).fillna(absent)


def wide_statistics(
    wide: DataFrame, sensors: Sequence[str] | None = None, tie_break: Sequence[str] = (),
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``long_statistics`` of wide readouts."""
    if not sensors:
        sensors = measures if measures is not None else sensor_columns(wide.columns)
    sensors = list(sensors)
    aggregated = (
        _numbered(wide, sensors, measures, *tie_break)
        .withColumn("value", finite_or_null(F.col("value")))
        .groupBy(P.ID, _POSITION).agg(*_aggregates(tie_break))
    )
    return _finished(aggregated, F.array(*[F.lit(s) for s in sensors])[F.col(_POSITION)].alias("sensor"))


def wide_features(
    wide: DataFrame, sensors: Sequence[str] | None = None, tie_break: Sequence[str] = (),
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Wide feature table, one row per vehicle and nine columns per sensor, from wide readouts.

    ``sensors`` defaults to every ``<family>_<bin>`` column. Without any sensor the result is empty and has
    ``vehicle_id`` only. With ``measures`` the sensors are its names, worked out from the other columns of ``wide``
    once its rows are in place, so that rows of few columns are moved and sorted.
    """
    if sensors is None:
        sensors = measures if measures is not None else sensor_columns(wide.columns)
    sensors = list(sensors)
    if not sensors:
        return wide.select(P.ID).limit(0)
    statistics = wide_statistics(wide, sensors, tie_break, measures)
    return _pivoted(statistics.withColumn("_prefix", F.concat(F.lit("s_"), "sensor")), sensors)


def rename_specs(df: DataFrame, count: int = 8) -> DataFrame:
    """``Spec_i`` to ``spec_i``; absent columns are ignored."""
    return df.withColumnsRenamed({f"Spec_{i}": f"spec_{i}" for i in range(count)})


def infinities_to_null(df: DataFrame) -> DataFrame:
    """Replace infinities and NaN by NULL in every floating-point column."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: finite_or_null(F.col(f"`{c}`")) for c in floats})


def assemble(specs: DataFrame, labels: DataFrame, features: DataFrame) -> DataFrame:
    """Specifications that have a label row, with their features; one join for all families."""
    base = specs.join(labels, P.ID, "inner")
    return rename_specs(base.join(features, P.ID, "left"))


# --- mergeable state ----------------------------------------------------------------------------


def running_state(long: DataFrame) -> DataFrame:
    """Mergeable state per (vehicle_id, sensor) of one batch of long readouts.

    Beside the published sums it holds means and centred moments. Those, not the sums, are what statistics come
    from: sums of squares of epoch times or large values lose every digit of a deviation.
    """
    value = F.col("value")
    time = F.when(value.isNotNull(), F.col(P.TIME))
    n = F.count(value)
    return (
        long.where(F.col(P.ID).isNotNull())
        .withColumn("value", finite_or_null(F.col("value").cast("double")))
        .groupBy(P.ID, "sensor").agg(
            n.alias("count"),
            F.coalesce(F.sum(value), F.lit(0.0)).alias("sum"),
            F.coalesce(F.sum(value * value), F.lit(0.0)).alias("sum_sq"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.count_if(value.isNull()).alias("missing"),
            F.coalesce(F.sum(time), F.lit(0.0)).alias("sum_x"),
            F.coalesce(F.sum(time * value), F.lit(0.0)).alias("sum_xy"),
            F.coalesce(F.sum(time * time), F.lit(0.0)).alias("sum_x_sq"),
            F.max(time).alias("last_time"),
            F.max_by(value, time).alias("last_val"),
            F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
            F.coalesce(F.avg(time), F.lit(0.0)).alias("mean_x"),
            F.coalesce(F.var_pop(value) * n, F.lit(0.0)).alias("m2"),
            F.coalesce(F.var_pop(time) * n, F.lit(0.0)).alias("m2_x"),
            F.coalesce(F.covar_pop(value, time) * n, F.lit(0.0)).alias("c_xy"),
        )
    )


def merge_states(states: DataFrame) -> DataFrame:
    """Fold any number of states per (vehicle_id, sensor) into one.

    The common means come first, then every state's moments are moved to them; both steps share one shuffle.
    """
    added = ("count", "sum", "sum_sq", "missing", "sum_x", "sum_xy", "sum_x_sq")
    together = W.partitionBy(P.ID, "sensor")
    n, total = F.col("count"), F.sum("count").over(together)
    def common(mean: str, base: str) -> Column:
        """The mean of all states: one of theirs, and what the others differ from it."""
        apart = F.sum(n * (F.col(mean) - F.col(base))).over(together) / F.nullif(F.col("_total"), F.lit(0))
        return F.coalesce(F.col(base) + apart, F.lit(0.0))

    centred = states.withColumns({
        "_base": F.max(F.when(n > 0, F.col("mean"))).over(together),
        "_base_x": F.max(F.when(n > 0, F.col("mean_x"))).over(together),
        "_total": total,
    }).withColumns({
        "_mean": common("mean", "_base"), "_mean_x": common("mean_x", "_base_x"),
    })
    dv, dx = F.col("mean") - F.col("_mean"), F.col("mean_x") - F.col("_mean_x")
    return centred.groupBy(P.ID, "sensor").agg(
        *[F.sum(c).alias(c) for c in added],
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.max_by("last_val", "last_time").alias("last_val"),
        F.max("last_time").alias("last_time"),
        F.max("_mean").alias("mean"),
        F.max("_mean_x").alias("mean_x"),
        F.sum(F.col("m2") + n * dv * dv).alias("m2"),
        F.sum(F.col("m2_x") + n * dx * dx).alias("m2_x"),
        F.sum(F.col("c_xy") + n * dv * dx).alias("c_xy"),
    )


def finish_states(states: DataFrame) -> DataFrame:
    """Statistics of merged states, shaped like ``long_statistics``."""
    n = F.col("count")
    valid = lambda c: F.when(n > 0, c)
    derived = states.select(
        P.ID, "sensor", n.alias("n"), valid(F.col("mean") * n).alias("total"), "max", "min",
        F.col("last_val").alias("last"), "missing",
        valid(F.sqrt(F.col("m2") / n)).alias("std"), valid(F.col("c_xy") / n).alias("covariance"),
        valid(F.col("m2_x") / n).alias("time_variance"),
    )
    return _finished(derived, "sensor")
