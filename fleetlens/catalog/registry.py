"""Registration of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Every double column rounded, so that the order of parallel sums does not show."""
    scale = "1" + "0" * digits + "D"
    return df.selectExpr(*[
        f"rint(`{f.name}` * {scale}) / {scale} AS `{f.name}`" if f.dataType.typeName() == "double" else f"`{f.name}`"
        for f in df.schema.fields
    ])


def rounded_sql(relation: str, doubles: Iterable[str], digits: int = 6) -> str:
    """SQL counterpart of ``rounded`` for a relation text."""
    cells = ", ".join(f'round_even("{c}", {digits}) AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({cells}) FROM ({relation})"
