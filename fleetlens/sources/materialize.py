"""Materialised feature tables that are rebuilt when a source is newer."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.session import cores, scratch_path
from fleetlens.sources.readers import exists, modified_at

_RECORDS = "_builds"


def _listing(spark: SparkSession, path: str) -> list[int]:
    """Number of files below a path and their bytes; the contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return [int(x or 0) for x in files.agg(F.count(F.lit(1)), F.sum("length")).first()]


def _source_times(spark: SparkSession, sources: Sequence[str]) -> dict[str, str] | None:
    """Newest modification time of every source, None if one is missing."""
    times = {s: str(modified_at(spark, s)) for s in sources if exists(spark, s)}
    return times if len(times) == len(set(sources)) else None


def _last_build(spark: SparkSession, target: str) -> dict | None:
    """The newest completion record of a target."""
    if not exists(spark, f"{target}/{_RECORDS}"):
        return None
    return json.loads(spark.read.text(f"{target}/{_RECORDS}").agg(F.max_by(
        "value", F.get_json_object("value", "$.number").cast("long"))).first()[0])


def is_fresh(spark: SparkSession, target: str, sources: Sequence[str]) -> bool:
    """True when the newest build is complete and the sources are what they were when it began."""
    build, now = _last_build(spark, target), _source_times(spark, sources)
    if build is None or now is None or build["sources"] != now or not exists(spark, build["folder"]):
        return False
    return _listing(spark, build["folder"]) == build["files"]


def load_or_build(
    spark: SparkSession,
    target: str,
    sources: Sequence[str],
    build: Callable[[], DataFrame],
    force: bool = False,
) -> DataFrame:
    """The Parquet table at ``target``, rebuilt first if forced or stale.

    Every build writes a folder of its own and then a completion record, which holds the times the sources had before
    it began and the size of what was written. A build that breaks off leaves no record and is never served; a source
    that changes during a build makes the next call build again.
    """
    if force or not is_fresh(spark, target, sources):
        last, times = _last_build(spark, target), _source_times(spark, sources)
        folder = f"{target}/build-{uuid.uuid4().hex[:12]}"
        build().write.parquet(folder)
        record = {
            "number": (last["number"] if last else 0) + 1, "folder": folder, "sources": times or {},
            "files": _listing(spark, folder),
        }
        spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("append").text(f"{target}/{_RECORDS}")
    return spark.read.parquet(_last_build(spark, target)["folder"])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For relations that are passed over many times: later passes start from the written columns, so a lost executor
    costs a re-read, not a recomputation, and iterative training ships short task descriptions.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df``, a written relation, is read from."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.sum("file_size")).first()[0] or 0


def laid_out(df: DataFrame, name: str, least_bytes: int, most_bytes: int) -> DataFrame:
    """``written``, read back in even partitions of ``least_bytes`` or more, up to one for every core.

    Where every core has ``most_bytes``, there are as many times more partitions, or what reading gives by itself. For
    relations that very many short jobs pass over: a job over a small relation is one task, not one per file, and
    one over a large relation has the same work for every core, with as few partial results as that allows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    read = lambda folder: spark.read.schema(df.schema).parquet(folder)
    size, at_once = _listing(spark, path)[1], cores(spark)
    wanted = max(1, min(at_once, -(-size // least_bytes)), at_once * (size // (at_once * most_bytes)))
    if 1 < wanted and read(path).rdd.getNumPartitions() < 2 * wanted:
        # Too few files, or too unlike each other, for even partitions.
        even = scratch_path(spark, name)
        read(path).repartition(wanted).write.parquet(even)
        path = even
    return read(path).coalesce(wanted)
