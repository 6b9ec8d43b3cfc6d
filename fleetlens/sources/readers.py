"""Readers for telemetry files, master tables, reports and models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import params as P
from fleetlens.functions.naming import parse_sensor, sensor_families
from fleetlens.operators.features import infinities_to_null

_ID_TYPES = {P.ID: T.LongType(), P.TIME: T.DoubleType(), P.LABEL: T.IntegerType(), P.STUDY_LENGTH: T.DoubleType()}
# Whole numbers are read as decimals, for nullable columns are often written as 1.0.
_WHOLE = T.DecimalType(38, 6)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path holds any file, for every file system Spark can list."""
    try:
        return modified_at(spark, path) is not None
    except AnalysisException:
        return False


def modified_at(spark: SparkSession, path: str):
    """Newest modification time below a path. Only file listings are read, not contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.max("modificationTime")).first()[0]


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file; with inference off Spark reads the header line only."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def csv_families(spark: SparkSession, path: str) -> list[str]:
    return sensor_families(header(spark, path))


def telemetry_schema(columns: list[str]) -> T.StructType:
    """Ids and labels typed, sensors as doubles, everything else as strings."""
    return T.StructType([
        T.StructField(c, _ID_TYPES.get(c, T.DoubleType() if parse_sensor(c) else T.StringType())) for c in columns
    ])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A readouts, specifications or labels file; blanks are NULL and non-finite values become NULL.

    A file of the folder with another header, and a cell that is not of its column's type, end the read with an error
    instead of wrong or missing values. Labels and ids may be written as whole decimals.
    """
    schema = telemetry_schema(header(spark, path))
    whole = [f.name for f in schema.fields if isinstance(f.dataType, (T.LongType, T.IntegerType))]
    loose = T.StructType([T.StructField(f.name, _WHOLE if f.name in whole else f.dataType) for f in schema.fields])
    rows = (
        spark.read.schema(loose).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    )
    typed = {n: F.col(f"`{n}`").cast(schema[n].dataType) for n in whole}
    fraction = F.lit(False)
    for n in whole:
        fraction = fraction | (F.coalesce(F.col(f"`{n}`") % 1, F.lit(0)) != 0)
    if whole:
        typed[whole[0]] = F.when(~fraction, typed[whole[0]]).otherwise(
            F.raise_error(F.lit("an id or label is not a whole number")).cast(schema[whole[0]].dataType))
    return infinities_to_null(rows.withColumns(typed))


_SCAN = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def read_table(
    spark: SparkSession, name: str, jdbc: Mapping[str, str] | None = None, single_task: bool = False
) -> DataFrame:
    """A master or feature table from the catalog, or over JDBC when connection options are given.

    A JDBC scan needs ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``; without them the
    whole table would be one task, which ``single_task`` allows for small tables.
    """
    if jdbc is None:
        return spark.table(name)
    if not single_task and not all(k in jdbc for k in _SCAN):
        raise ValueError(f"a JDBC scan needs {', '.join(_SCAN)}, or single_task=True for a small table")
    return spark.read.format("jdbc").options(**jdbc).option("dbtable", name).load()


def read_importance(spark: SparkSession, path: str) -> DataFrame | None:
    """(feature, importance, rank), None where the file is absent."""
    if not exists(spark, path):
        return None
    schema = "feature string, importance double, rank int"
    return spark.read.schema(schema).option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)
