"""Ordered running totals and predecessor look-ups that never put one ordered group into one task.

An ordered window over a large group (one label, one vehicle, the whole table) runs in a single task.
Both operators here cut the order into buckets first, work inside the buckets in parallel, and stitch the
buckets together through a relation with one or two rows per bucket. Results equal the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_BUCKET = "_bucket"


def default_parts(df: DataFrame) -> int:
    """As many ranges as the session shuffles into, so ranges grow with the cluster the job was sized for."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def quantile_boundaries(df: DataFrame, column: str, parts: int | None = None) -> list[float]:
    """At most ``parts - 1`` ascending cut points holding about equal row counts between them.

    Rows are what is balanced, so a vehicle with a third of all rows is cut into about a third of the parts.
    Only the cut points reach the driver.
    """
    parts = parts or default_parts(df)
    if parts <= 1:
        return []
    probabilities = [i / parts for i in range(1, parts)]
    numeric = df.select(F.col(column).cast("double").alias(column))
    return sorted(set(numeric.approxQuantile(column, probabilities, min(0.001, 0.25 / parts))))


def heavy_groups(df: DataFrame, column: str, parts: int | None = None) -> list:
    """Values of the column with more rows than an even share of the parts; there are fewer of them than parts.

    All other values can be brought together by hash without one task holding more than about two shares.
    """
    parts = parts or default_parts(df)
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    whole = counts.agg(F.sum("_rows").alias("_all"))
    heavy = counts.crossJoin(F.broadcast(whole)).where(F.col("_rows") * F.lit(parts) > F.col("_all"))
    return [row[0] for row in heavy.select(column).collect()]


def with_range_bucket(df: DataFrame, column: str, boundaries: Sequence[float], output: str) -> DataFrame:
    """Add the number of ``boundaries`` at or below the column."""
    if not boundaries:
        return df.withColumn(output, F.lit(0.0))
    infinity = float("inf")
    return Bucketizer(
        splits=[-infinity, *boundaries, infinity], inputCol=column, outputCol=output, handleInvalid="keep"
    ).transform(df)


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    bucket: Column,
    order: Sequence[Column],
    totals: dict[str, str],
    descending: bool = False,
    whole: dict[str, str] | None = None,
) -> DataFrame:
    """Add inclusive running sums ``{output: input}`` within ``by``, along ``order``; a NULL group is a group.

    ``whole`` adds sums over the entire group, from the same relation of one row per group and bucket.

    ``bucket`` must be monotone in ``order`` (falling when ``descending``). The offsets relation has one row per
    group and bucket.
    """
    by = list(by)
    keyed = df.withColumn(_BUCKET, bucket)
    whole = whole or {}
    sums = keyed.groupBy(*by, _BUCKET).agg(
        *[F.sum(src).alias(f"_t_{out}") for out, src in totals.items()],
        *[F.sum(src).alias(f"_w_{out}") for out, src in whole.items()])
    bucket_order = F.col(_BUCKET).desc() if descending else F.col(_BUCKET).asc()
    before = W.partitionBy(*by).orderBy(bucket_order).rowsBetween(W.unboundedPreceding, -1)
    group = W.partitionBy(*by)
    keys = [*by, _BUCKET]
    offsets = sums.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)).alias(f"_o_{out}") for out in totals],
        *[F.sum(f"_w_{out}").over(group).alias(out) for out in whole],
    )
    inside = W.partitionBy(*by, _BUCKET).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = keyed.join(offsets, same, "inner")
    return joined.withColumns(
        {out: F.col(f"_o_{out}") + F.sum(src).over(inside) for out, src in totals.items()}
    ).drop(_BUCKET, *[f"_o_{out}" for out in totals], *[f"_k{i}" for i in range(len(keys))])


def with_previous(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    payload: str,
    bucket: Column | None = None,
    output: str = "previous",
) -> DataFrame:
    """Rows that have a predecessor within ``by`` along ``order``, with the predecessor's payload added.

    ``bucket`` must rise with ``order``. Rows inside a bucket find their predecessor there; the first row of each
    bucket finds it among the first and last rows of all buckets, at most two per group and bucket.
    """
    by, order = list(by), list(order)
    if bucket is None:
        whole = W.partitionBy(*by).orderBy(*order)
        return (
            df.withColumns({output: F.lag(payload).over(whole), "_n": F.row_number().over(whole)})
            .where("_n > 1").drop("_n")
        )
    part = W.partitionBy(*by, _BUCKET).orderBy(*order)
    marked = df.withColumn(_BUCKET, bucket).withColumns({
        output: F.lag(payload).over(part),
        "_first": F.row_number().over(part) == 1,
        "_last": F.lead(F.lit(True)).over(part).isNull(),
    })
    inner = marked.where(~F.col("_first"))
    across = W.partitionBy(*by).orderBy(*order)
    edges = (
        marked.where(F.col("_first") | F.col("_last"))
        .withColumns({output: F.lag(payload).over(across), "_n": F.row_number().over(across)})
        .where(F.col("_first") & (F.col("_n") > 1)).drop("_n")
    )
    return inner.unionByName(edges).drop(_BUCKET, "_first", "_last")
