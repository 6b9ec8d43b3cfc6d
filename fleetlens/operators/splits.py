"""Stratified hold-out and folds from a portable hash order.

The position of a row within its class equals ``row_number()`` over (class, md5(id), id). It is computed per
(class, hash bucket), so the majority class is not ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.functions.numeric import hash_order
from fleetlens.operators.running import running_totals


def class_positions(df: DataFrame, label: str = P.LABEL, key: str = P.ID, hex_digits: int = 3) -> DataFrame:
    """Add ``position`` (1..n within the class) and ``class_size``; rows without a label are a class of their own.

    ``hex_digits`` leading digits of the hash give 16^digits buckets per class. Rows move once, by class and bucket;
    class sizes come with the offsets of the buckets.
    """
    order = hash_order(F.col(key))
    bucket = F.conv(F.substring(order, 1, hex_digits), 16, 10).cast("int")
    numbered = running_totals(
        df.withColumns({"_order": order, "_one": F.lit(1)}),
        [label], bucket, [F.col("_order"), F.col(key)], {"position": "_one"}, whole={"class_size": "_one"},
    )
    return numbered.drop("_order", "_one")


def stratified_split(df: DataFrame, test_size: float = P.TRAIN.test_size, label: str = P.LABEL, key: str = P.ID) -> DataFrame:
    """Add ``is_test``: the first ceil(test_size * n) rows of each class in hash order."""
    cut = F.ceil(F.lit(test_size) * F.col("class_size"))
    return class_positions(df, label, key).withColumn("is_test", F.col("position") <= cut).drop("position", "class_size")


def stratified_folds(df: DataFrame, folds: int = P.TRAIN.folds, label: str = P.LABEL, key: str = P.ID) -> DataFrame:
    """Add ``fold`` in 0..folds-1 with equal class shares."""
    numbered = class_positions(df, label, key)
    return numbered.withColumn("fold", (F.col("position") % folds).cast("int")).drop("position", "class_size")


def drop_unlabeled(df: DataFrame, label: str = P.LABEL) -> DataFrame:
    return df.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("int"))


def target_distribution(df: DataFrame, label: str = P.LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("samples")).orderBy(label)


def class_ratio(df: DataFrame, label: str = P.LABEL, default: float = P.TRAIN.default_class_ratio) -> DataFrame:
    """One row: negatives per positive, ``default`` without positives."""
    negative, positive = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(
        F.coalesce(negative / F.nullif(positive, F.lit(0)), F.lit(default)).cast("double").alias("scale_pos_weight")
    )


def balanced_weights(df: DataFrame, label: str = P.LABEL) -> DataFrame:
    """(label, weight) with weight = n / (classes * n_class); one row per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("samples"))
    everything = W.partitionBy()
    return counts.select(
        label, "samples",
        (F.sum("samples").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("samples"))).alias("weight"),
    )
