"""Master-data joins, key checks and the weighted account assignment.

No join carries a broadcast hint: master tables grow with the fleet, so Catalyst's size threshold and adaptive
execution decide, and adaptive skew handling splits a hot account when the join has to shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.functions.numeric import unit_hash
from fleetlens.operators.running import default_parts, quantile_boundaries, running_totals, with_range_bucket


def specs_with_labels(specs: DataFrame, labels: DataFrame) -> DataFrame:
    return specs.join(labels, P.ID, "inner")


def fleet_master(features: DataFrame, vehicles: DataFrame, accounts: DataFrame) -> DataFrame:
    """Features of known vehicles; an unknown account leaves its columns NULL.

    The narrow master tables meet first, so the wide rows move once, by vehicle, if they are not there already.
    """
    master = vehicles.join(accounts, P.ACCOUNT, "left")
    ordered = [P.ID, P.ACCOUNT, *[c for c in master.columns if c not in (P.ID, P.ACCOUNT)]]
    return features.join(master.select(ordered), P.ID, "inner")


def local_fleet(specs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Fleet without engineered features: specifications plus label columns, unknown labels read as 0."""
    if labels is None or P.LABEL not in labels.columns:
        return specs.withColumns({P.LABEL: F.lit(0), P.STUDY_LENGTH: F.lit(0)})
    projected = labels.select(P.ID, P.LABEL, P.STUDY_LENGTH)
    return default_label(specs.join(projected, P.ID, "left"))


def default_label(df: DataFrame, value: int = 0) -> DataFrame:
    return df.withColumn(P.LABEL, F.coalesce(F.col(P.LABEL), F.lit(value)).cast("int"))


def fleet_sizes(vehicles: DataFrame) -> DataFrame:
    """Distinct vehicles per account; an account with a third of the fleet is deduplicated by vehicle first."""
    return (
        vehicles.where(F.col(P.ACCOUNT).isNotNull())
        .groupBy(P.ACCOUNT).agg(F.countDistinct(P.ID).alias("fleet_size"))
    )


def accounts_with_size(accounts: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Every account; NULL size where it has no vehicle."""
    return accounts.join(fleet_sizes(vehicles), P.ACCOUNT, "left")


def active_accounts(fleet: DataFrame) -> DataFrame:
    return fleet.agg(F.countDistinct(P.ACCOUNT).alias("active_accounts"))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null key is unknown to the parent."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once, or are NULL, with their row count."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    return counted.where((F.col("occurrences") > 1) | any_null)


def distinct_ids(df: DataFrame, key: str = P.ID) -> DataFrame:
    return df.select(key).distinct().orderBy(key)


def account_intervals(weights: DataFrame, buckets: int | None = None) -> DataFrame:
    """(account_id, low, high): the share of [0, 1) each account owns, in account order.

    ``weights`` has integer ``weight`` so the cumulative sum is exact in any order of addition.
    """
    positive = weights.where(F.col("weight") > 0).withColumn("_w", F.col("weight").cast("long"))
    total = positive.agg(F.sum("_w")).first()[0]
    ranged = with_range_bucket(positive, P.ACCOUNT, quantile_boundaries(positive, P.ACCOUNT, buckets), "_range")
    cumulated = running_totals(ranged, [], F.col("_range"), [F.col(P.ACCOUNT)], {"upper": "_w"})
    return cumulated.select(
        P.ACCOUNT,
        ((F.col("upper") - F.col("_w")) / F.lit(total)).alias("low"),
        (F.col("upper") / F.lit(total)).alias("high"),
    )


def assign_accounts(ids: DataFrame, intervals: DataFrame, position: Column | None = None, parts: int | None = None) -> DataFrame:
    """Give every id the account whose interval contains its hashed position; ids outside all intervals go.

    Ids and interval starts are put in one order of position, and every id takes the last start before it. The order
    is cut into equal cells: a cell is worked through by one task, and the account in force at its start comes from
    the cells before it, one row each. The work is linear in ids and accounts, however many accounts there are.
    """
    place = unit_hash(F.col(P.ID)) if position is None else position
    cells = parts or 4 * default_parts(ids)
    start = F.struct("low", "high", P.ACCOUNT).alias("_start")
    none = F.lit(None).cast(intervals.select(start).schema[0].dataType)
    points = (
        ids.select(F.struct(*ids.columns).alias("_row"), place.alias("_at"), none.alias("_start"))
        .unionByName(intervals.select(F.lit(None).cast(ids.select(F.struct(*ids.columns)).schema[0].dataType).alias("_row"),
                                      F.col("low").alias("_at"), start))
        .withColumn("_cell", F.floor(F.col("_at") * cells))
    )
    # one row per cell that has a start: the last one
    lasts = points.where("_start IS NOT NULL").groupBy("_cell").agg(F.max("_start").alias("_start"))
    every = ids.sparkSession.range(cells + 1).select(F.col("id").alias("_cell"))
    before = W.orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    carried = every.join(lasts, "_cell", "left").select("_cell", F.last("_start", True).over(before).alias("_carried"))
    inside = W.partitionBy("_cell").orderBy("_at", F.col("_start").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    found = points.withColumn("_last", F.last("_start", True).over(inside)).where("_row IS NOT NULL") \
        .join(carried, "_cell", "left").withColumn("_last", F.coalesce("_last", "_carried"))
    held = (F.col("_at") >= F.col("_last.low")) & (F.col("_at") < F.col("_last.high"))
    return found.where(held).select("_row.*", F.col(f"_last.{P.ACCOUNT}").alias(P.ACCOUNT))
