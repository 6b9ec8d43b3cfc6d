"""Run registered queries next to their SQL in DuckDB and compare the values.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else (value + 0.0 if value != 0 else 0.0)
    if hasattr(value, "as_integer_ratio") and not isinstance(value, int):
        return float(value)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(table, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


def compare(spark, connection, name, query, sql, sf_dir) -> str:
    """Empty string when equal, else a description of the first difference."""
    frame = query(spark, sf_dir)
    columns, rows = _sorted_rows(frame.columns, frame.collect())
    result = connection.execute(sql)
    wanted_columns, wanted = _sorted_rows([d[0] for d in result.description], result.fetchall())
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows != {len(wanted)}"
    differing = [(a, b) for a, b in zip(rows, wanted) if a != b]
    if differing:
        a, b = differing[0]
        cells = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y]
        return f"{len(differing)} rows differ, first: {cells[:4]}"
    return ""


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name in oracles:
                problem = compare(spark, connection, name, query, oracles[name], sf_dir)
                kind = "value"
            else:
                problem, kind = "", f"rows={query(spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001
            problem, kind = f"{type(error).__name__}: {str(error)[:600]}", "error"
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.time() - started:6.1f}s {kind} {problem}", flush=True)
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
