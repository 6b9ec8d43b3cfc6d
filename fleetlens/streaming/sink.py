"""A feature table that arriving batches update in place, vehicle bucket by vehicle bucket.

A vehicle belongs to one of a fixed number of buckets by a hash of its id. A batch rewrites only the buckets it has
readouts for: their states and their features go to a folder of that batch, and then one small record says for every
bucket which batch wrote it last. Readers follow the newest record, so they see a batch whole or not at all, and buckets
a batch did not touch keep their files. A replayed batch starts from the record before it and writes the same again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import params as P
from fleetlens.operators.features import features_of_statistics, finish_states, merge_states, running_state
from fleetlens.sources.materialize import written
from fleetlens.sources.readers import exists
from fleetlens.streaming.incremental import _arriving

BUCKETS = 64


class FeatureSink:
    """States and features below ``target``, dealt into ``buckets`` buckets; the number must stay the same."""

    def __init__(self, spark: SparkSession, target: str, sensors: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.target, self.sensors, self.buckets = spark, target, list(sensors), buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(P.ID).cast("long")), F.lit(self.buckets)).cast("int")

    def _records(self) -> dict[int, dict[int, int]]:
        """Per batch, which batch wrote each bucket last. A record has an entry per bucket at most."""
        if not exists(self.spark, f"{self.target}/records"):
            return {}
        rows = self.spark.read.option("basePath", f"{self.target}/records").text(f"{self.target}/records/batch_id=*")
        return {r["batch_id"]: {int(b): n for b, n in json.loads(r["value"]).items()} for r in rows.collect()}

    def _folders(self, kind: str, record: dict[int, int]) -> list[str]:
        return [f"{self.target}/{kind}/batch_id={batch}/bucket={bucket}" for bucket, batch in sorted(record.items())]

    def upsert(self, states: DataFrame, batch_id: int) -> list[int]:
        """Add the additive states of one batch; the buckets that were rewritten. A batch before the newest is in already."""
        records = self._records()
        if records and batch_id < max(records):
            return []
        before = records[max(b for b in records if b < batch_id)] if any(b < batch_id for b in records) else {}
        arrived = written(states.withColumn("bucket", self._bucket()), "sink-batch")
        touched = sorted(r[0] for r in arrived.select("bucket").distinct().collect())
        if not touched:
            return []
        known = self._folders("states", {b: before[b] for b in touched if b in before})
        everything = arrived.drop("bucket")
        if known:
            everything = everything.unionByName(self.spark.read.schema(everything.schema).parquet(*known))
        self._write("states", merge_states(everything), batch_id)
        merged = self.spark.read.schema(everything.schema).parquet(
            *self._folders("states", dict.fromkeys(touched, batch_id)))
        self._write("features", features_of_statistics(finish_states(merged), self.sensors), batch_id)
        record = json.dumps({**before, **dict.fromkeys(touched, batch_id)})
        self.spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{self.target}/records/batch_id={batch_id}")
        return touched

    def _write(self, kind: str, rows: DataFrame, batch_id: int) -> None:
        rows.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.target}/{kind}/batch_id={batch_id}")

    def files(self) -> list[str]:
        """The folders that hold the feature table now."""
        records = self._records()
        return self._folders("features", records[max(records)]) if records else []

    def features(self) -> DataFrame:
        """The wide feature table of all batches so far."""
        if not (folders := self.files()):
            raise FileNotFoundError(f"no batch has been written to {self.target}")
        return self.spark.read.parquet(*folders)


def run_features(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    to_long: Callable[[DataFrame], DataFrame],
    sink: FeatureSink,
    checkpoint: str,
    files_per_batch: int = 1,
    kind: str = "parquet",
) -> None:
    """Process everything available, updating the sink batch by batch, then stop."""
    query = (
        _arriving(spark, source, schema, files_per_batch, kind).writeStream
        .foreachBatch(lambda batch, batch_id: sink.upsert(running_state(to_long(batch)), batch_id) and None)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
