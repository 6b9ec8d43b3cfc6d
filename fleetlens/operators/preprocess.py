"""Imputation, scaling and category capping, fitted with relational passes.

Fitted parameters are one number per column or at most ``max_categories`` values per column; only these reach
the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import params as P

MISSING = "missing"
POOLED = "infrequent"


def column_kinds(df: DataFrame, exclude: Sequence[str] = P.NON_FEATURES) -> tuple[list[str], list[str]]:
    """(categorical, numeric) feature columns by type; other types belong to neither."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    categorical = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return categorical, numeric


def feature_columns(df: DataFrame, strict: bool = True) -> DataFrame:
    """Drop id and label columns. ``strict`` requires them to be there, as training does; scoring is lenient."""
    absent = [c for c in P.NON_FEATURES if c not in df.columns]
    if strict and absent:
        raise ValueError(f"columns not found: {absent}")
    return df.drop(*P.NON_FEATURES)


def _folded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column position, value) for every non-missing cell."""
    cells = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    return (
        df.select(F.posexplode(cells).alias("position", "value"))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )


# Cells a bracket is counted in, and rows that are few enough to be put in order.
CELLS = 64
ORDERED = 1_000
_LARGEST = 1.7976931348623157e308


@dataclass(frozen=True)
class _Bracket:
    """Where the values of some ranks of a column lie; ranks count from 1 inside it. ``whole`` also counts what is outside."""

    position: int
    low: float
    high: float
    ranks: tuple[int, ...] = ()
    whole: bool = False


def fit_medians(df: DataFrame, columns: Sequence[str], error: float = 0.001) -> dict[str, float | None]:
    """Exact medians, None for an all-missing column.

    A quantile sketch brackets each median. Every pass counts the rows of all brackets in CELLS cells, with the
    smallest and the largest value of each cell, and goes on with the cells that hold the middle ranks, until a cell is
    one value or has at most ORDERED rows, which are put in order. The first pass also counts what is outside, so a
    sketch that misses costs passes and no exactness. What is shuffled and brought to the driver is at most CELLS + 2
    rows per column and task.
    """
    columns = list(columns)
    numeric = df.select(*[F.col(f"`{c}`").cast("double").alias(str(i)) for i, c in enumerate(columns)])
    sketch = numeric.approxQuantile([str(i) for i in range(len(columns))], [0.5 - 2 * error, 0.5 + 2 * error], error)
    pending = [_Bracket(i, q[0], q[1], whole=True) for i, q in enumerate(sketch) if q]
    found: dict[int, list[float]] = {b.position: [] for b in pending}
    few: list[_Bracket] = []
    while pending:
        going: list[_Bracket] = []
        for bracket, cells in zip(pending, _counted_cells(df, columns, pending)):
            total = sum(n for _, n, _, _ in cells)
            if not total:
                continue
            ranks = bracket.ranks or ((total + 1) // 2, (total + 2) // 2)
            passed = 0
            for _, n, low, high in sorted(cells):
                inside = tuple(r - passed for r in ranks if passed < r <= passed + n)
                passed += n
                if not inside:
                    continue
                if low == high:
                    found[bracket.position] += [low] * len(inside)
                else:
                    (few if n <= ORDERED else going).append(_Bracket(bracket.position, low, high, inside))
        pending = going
    for bracket, values in zip(few, _ordered_values(df, columns, few)):
        found[bracket.position] += values
    medians: dict[str, float | None] = dict.fromkeys(columns)
    for position, values in found.items():
        if values and math.isfinite(middle := (min(values) + max(values)) / 2.0):
            medians[columns[position]] = middle
    return medians


def _in_brackets(df: DataFrame, columns: Sequence[str], brackets: Sequence[_Bracket]) -> DataFrame:
    """(bracket, value, low, high) of the cells in each bracket."""
    rows = [(k, b.position, b.low, b.high, b.whole) for k, b in enumerate(brackets)]
    bounds = df.sparkSession.createDataFrame(rows, "bracket int, position int, low double, high double, whole boolean")
    used = sorted({b.position for b in brackets})
    number = {p: k for k, p in enumerate(used)}
    bounds = bounds.replace(number, subset=["position"]) if used != list(range(len(columns))) else bounds
    cells = _folded(df, [columns[p] for p in used])
    # Two brackets per column of the table at most.
    return cells.join(F.broadcast(bounds), "position").where(F.col("whole") | F.col("value").between(F.col("low"), F.col("high")))


def _counted_cells(df: DataFrame, columns: Sequence[str], brackets: Sequence[_Bracket]) -> list[list[tuple]]:
    """Per bracket (cell, rows, smallest, largest) of its cells that have rows; -1 and CELLS are what is outside."""
    value = F.col("value")
    low, high = F.greatest(F.col("low"), F.lit(-_LARGEST)), F.least(F.col("high"), F.lit(_LARGEST))
    # Halves, as the distance of two large values may be too large for a double.
    at = F.floor(F.try_divide(value / 2 - low / 2, high / 2 - low / 2) * CELLS)
    # The ends are in different cells however close they are, so every pass splits a bracket.
    cell = (
        F.when(value < low, -1).when(value > high, CELLS).when(value == low, 0).when(value == high, CELLS - 1)
        .otherwise(F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), at))).cast("int"))
    counted = _in_brackets(df, columns, brackets).groupBy("bracket", cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("smallest"), F.max("value").alias("largest"))
    found: list[list[tuple]] = [[] for _ in brackets]
    for r in counted.collect():
        found[r["bracket"]].append((r["cell"], r["n"], r["smallest"], r["largest"]))
    return found


def _ordered_values(df: DataFrame, columns: Sequence[str], brackets: Sequence[_Bracket]) -> list[list[float]]:
    """Per bracket the values of its ranks; a bracket has at most ORDERED rows."""
    if not brackets:
        return []
    listed = _in_brackets(df, columns, brackets).groupBy("bracket").agg(F.sort_array(F.collect_list("value")).alias("values"))
    wanted = df.sparkSession.createDataFrame(
        [(k, list(b.ranks)) for k, b in enumerate(brackets)], "bracket int, ranks array<int>")
    picked = listed.join(F.broadcast(wanted), "bracket").select(
        "bracket", F.transform("ranks", lambda r: F.element_at("values", r)).alias("values"))
    found = {r["bracket"]: list(r["values"]) for r in picked.collect()}
    return [found[k] for k in range(len(brackets))]


def impute(df: DataFrame, medians: Mapping[str, float | None], categorical: Sequence[str] = ()) -> DataFrame:
    """Fill numeric gaps (NULL or NaN) with medians and categorical gaps with ``missing``.

    A column without any value stays NULL.
    """
    filled = {
        c: F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")), F.lit(m))
        for c, m in medians.items() if m is not None
    }
    filled |= {c: F.coalesce(F.col(f"`{c}`"), F.lit(MISSING)) for c in categorical}
    return df.withColumns(filled) if filled else df


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """column -> (mean, population standard deviation); a constant column gets deviation 1."""
    rows = _folded(df, columns).groupBy("position").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    ).collect()
    return {columns[r["position"]]: (r["mean"], r["std"] or 1.0) for r in rows}


def scale(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(f"`{c}`") - F.lit(m)) / F.lit(s) for c, (m, s) in scaler.items()})


def fit_category_cap(df: DataFrame, columns: Sequence[str], max_categories: int = 50) -> dict[str, list[str]]:
    """Columns with more than ``max_categories`` values -> the values kept (one slot is left for the pooled rest).

    Most frequent first, ties by name. The ranking filter is applied map-side per column.
    """
    pairs = df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit(MISSING)).alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counts = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy("column").orderBy(F.col("n").desc(), F.col("value"))
    top = counts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= max_categories + 1)
    kept: dict[str, list[str]] = {}
    for row in top.orderBy("column", "r").collect():
        kept.setdefault(row["column"], []).append(row["value"])
    return {c: values[: max_categories - 1] for c, values in kept.items() if len(values) > max_categories}


def cap_categories(df: DataFrame, kept: Mapping[str, Sequence[str]]) -> DataFrame:
    """Pool every value that was not kept; columns without an entry are untouched."""
    capped = {
        c: F.when(F.coalesce(F.col(f"`{c}`"), F.lit(MISSING)).isin(*values), F.coalesce(F.col(f"`{c}`"), F.lit(MISSING)))
            .otherwise(F.lit(POOLED))
        for c, values in kept.items()
    }
    return df.withColumns(capped) if capped else df
