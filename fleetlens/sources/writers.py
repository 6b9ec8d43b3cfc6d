"""Sinks: catalog and JDBC tables, CSV extracts, JSON reports.

Extracts are written as folders by all tasks; nothing is squeezed into one file.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fleetlens.operators.features import infinities_to_null


def _save(df: DataFrame, name: str, mode: str, jdbc: Mapping[str, str] | None, batch: int, path: str | None) -> None:
    if jdbc is not None:
        df.write.format("jdbc").options(**jdbc).option("dbtable", name).option("batchsize", batch).mode(mode).save()
        return
    writer = df.write.mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def append_table(
    df: DataFrame, name: str, jdbc: Mapping[str, str] | None = None, batch: int = 100, path: str | None = None
) -> None:
    """Append rows, in insert batches of ``batch`` over JDBC."""
    _save(df, name, "append", jdbc, batch, path)


def replace_table(
    df: DataFrame, name: str, jdbc: Mapping[str, str] | None = None, batch: int = 100, path: str | None = None
) -> None:
    """Replace a table by ``df`` with its schema; non-finite numbers become NULL."""
    _save(infinities_to_null(df), name, "overwrite", jdbc, batch, path)


def create_master_tables(
    spark: SparkSession, accounts: str, vehicles: str, features: str, telemetry: str, location: str | None = None
) -> None:
    """Drop the four tables and create the two master tables empty.

    Spark tables carry no keys; ``joins.duplicate_keys`` and ``joins.orphans`` check them.
    """
    for name in (features, vehicles, accounts, telemetry):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = {
        accounts: "account_id INT, company_name STRING, industry STRING, operating_prefecture STRING, fleet_size INT",
        vehicles: "vehicle_id INT, account_id INT, vehicle_age_years DOUBLE, vehicle_model STRING, "
                  "engine_family STRING, manufacture_year INT",
    }
    for name, ddl in columns.items():
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{place}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
