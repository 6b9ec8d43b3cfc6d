"""Feature statistics over arriving readout files.

Two sinks give the same result after every batch:

* ``run_statistics`` keeps the aggregation buffers in Spark's state store and writes the rows that changed.
* ``run_state_deltas`` keeps nothing between batches: each batch writes its additive state, and the reader folds
  the states of all batches. It suits fleets whose (vehicle, sensor) state would not fit the executors.

Both write one folder per batch and overwrite it on a retry, so a replayed batch is not counted twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import params as P
from fleetlens.operators.features import (
    features_of_statistics, finish_states, long_statistics, merge_states, running_state,
)
from fleetlens.sources.readers import exists


def _arriving(spark: SparkSession, source: str, schema: T.StructType, files_per_batch: int, kind: str) -> DataFrame:
    """Arriving files of one kind, ``parquet`` or ``csv``; CSV files have a header, which must be the schema's."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if kind == "csv":
        reader = reader.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    return reader.format(kind).load(source)


def _batch_folder(target: str, batch_id: int) -> str:
    return f"{target}/batch_id={batch_id}"


def run_statistics(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    to_long: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    files_per_batch: int = 1,
    kind: str = "parquet",
) -> None:
    """Process everything available with a stateful aggregation, then stop."""

    def write_changed(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(_batch_folder(target, batch_id))

    statistics = long_statistics(to_long(_arriving(spark, source, schema, files_per_batch, kind)))
    query = (
        statistics.writeStream.outputMode("update").foreachBatch(write_changed)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def latest_statistics(spark: SparkSession, target: str) -> DataFrame:
    """The newest row of every (vehicle_id, sensor)."""
    written = spark.read.parquet(target)
    values = [c for c in written.columns if c not in (P.ID, "sensor", "batch_id")]
    newest = F.max_by(F.struct(*values), "batch_id").alias("_row")
    return written.groupBy(P.ID, "sensor").agg(newest).select(P.ID, "sensor", "_row.*")


def run_state_deltas(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    to_long: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    files_per_batch: int = 1,
    kind: str = "parquet",
) -> None:
    """Process everything available, writing one additive state per batch, then stop."""

    def write_state(batch: DataFrame, batch_id: int) -> None:
        running_state(to_long(batch)).write.mode("overwrite").parquet(_batch_folder(target, batch_id))

    query = (
        _arriving(spark, source, schema, files_per_batch, kind).writeStream.foreachBatch(write_state)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _states(spark: SparkSession, target: str) -> DataFrame:
    """States of the batches that no compaction holds, and of the newest compaction."""
    batches = spark.read.option("basePath", target).parquet(f"{target}/batch_id=*")
    if not exists(spark, f"{target}/base"):
        return batches.drop("batch_id")
    base = spark.read.parquet(f"{target}/base")
    last = base.agg(F.max("upto")).first()[0]
    newest = base.where(F.col("upto") == last).drop("upto")
    return newest.unionByName(batches.where(F.col("batch_id") > last).drop("batch_id"))


def compact_states(spark: SparkSession, target: str) -> None:
    """Fold all batches written so far into one base state, so that a read does not fold every batch again.

    The base is a new folder named by the last batch it holds; batches after it are added at read time.
    """
    last = spark.read.option("basePath", target).parquet(f"{target}/batch_id=*").agg(F.max("batch_id")).first()[0]
    merge_states(_states(spark, target)).write.mode("overwrite").parquet(f"{target}/base/upto={last}")


def states_so_far(spark: SparkSession, target: str) -> DataFrame:
    """Statistics from the states of all batches written so far."""
    return finish_states(merge_states(_states(spark, target)))


def features_so_far(spark: SparkSession, target: str, sensors: Sequence[str]) -> DataFrame:
    """The wide feature table of all batches written so far, equal to ``features_from_long`` of their rows."""
    return features_of_statistics(states_so_far(spark, target), sensors)
