"""Bundles: folders of several parts that appear at once, under numbers that no two writers share.

A bundle is written to a folder of its own; it counts once the record with its number is there. A record is one small
file whose creation fails if the file exists, so of two writers that want the same number one gets it and the other
sees that it did not.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from fleetlens.sources.readers import exists

_RECORDS = "records"


class Conflict(RuntimeError):
    """Another bundle was published in between."""


@dataclass(frozen=True)
class Record:
    number: int
    folder: str
    note: dict = field(default_factory=dict)


def records(spark: SparkSession, path: str) -> list[Record]:
    """Records of the complete bundles below ``path``, oldest first."""
    if not exists(spark, f"{path}/{_RECORDS}"):
        return []
    found = [json.loads(r[0]) for r in spark.read.text(f"{path}/{_RECORDS}", wholetext=True).collect()]
    return sorted((Record(r["number"], r["folder"], r["note"]) for r in found), key=lambda r: r.number)


def latest(spark: SparkSession, path: str) -> Record | None:
    return max(records(spark, path), key=lambda r: r.number, default=None)


def _created(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with the text; False if it is there already.

    The text goes to a file of its own first, which is then renamed: a reader sees the whole record or none.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(conf)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    # The claim is a file that only one writer can create; the rename then cannot meet another one.
    try:
        files.create(jvm.org.apache.hadoop.fs.Path(f"{path.rsplit('/', 1)[0]}/.claim-{path.rsplit('/', 1)[1]}"), False).close()
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise
    if not files.rename(draft, target):
        raise OSError(f"{path} could not be written")
    return True


def publish(
    spark: SparkSession, path: str, write: Callable[[str], None], note: dict | None = None, expected: int | None = None
) -> Record:
    """Write a bundle with ``write(folder)`` and publish it as the newest below ``path``.

    With ``expected`` it becomes the bundle after that number or none: ``Conflict`` if the newest is another one, before
    writing or at the end. Without, it takes the next number that is free. If ``write`` fails, nothing is published.
    """
    if expected is not None and (newest := latest(spark, path)) is not None and newest.number != expected:
        raise Conflict(f"{path} is at {newest.number}, not at {expected}")
    folder = f"{path}/bundle-{uuid.uuid4().hex[:12]}"
    write(folder)
    newest = latest(spark, path)
    number = (expected if expected is not None else newest.number if newest else 0) + 1
    while not _created(spark, f"{path}/{_RECORDS}/{number:010d}.json", json.dumps({"number": number, "folder": folder, "note": note or {}})):
        if expected is not None:
            raise Conflict(f"{path} has a bundle {number} already")
        number += 1
    return Record(number, folder, note or {})
