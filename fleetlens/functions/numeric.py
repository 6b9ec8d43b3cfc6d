"""Numeric column helpers; all stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int) -> Column:
    """Half-to-even on the scaled double. Spark's ``round``/``bround`` go through decimals and differ on ties."""
    if digits == 0:
        return F.rint(value)
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def finite_or_null(value: Column) -> Column:
    """NaN and both infinities become NULL, so they neither win ``max`` nor poison ``avg``."""
    infinite = F.abs(value) == F.lit(float("inf"))
    return F.when(value.isNotNull() & ~F.isnan(value) & ~infinite, value)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, 0.0 where the denominator is 0."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


def hash_order(key: Column) -> Column:
    """Portable pseudo-random order of a key."""
    return F.md5(key.cast("string"))


def unit_hash(key: Column) -> Column:
    """Portable uniform value in [0, 1) derived from a key."""
    head = F.conv(F.substring(hash_order(key), 1, 8), 16, 10).cast("double")
    return head / F.lit(float(2**32))


def bucket_of(value: Column, boundaries: Sequence[float]) -> Column:
    """How many of the ascending ``boundaries`` are <= value, as a balanced tree of comparisons.

    log2(len) comparisons per row, inside generated code, with no UDF.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(boundaries[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(boundaries))
