"""Newest rows per group and overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spark limits each group before the shuffle only up to this rank
# (spark.sql.optimizer.windowGroupLimitThreshold).
_GROUP_LIMIT = 1000
_SALTS = 256


def _ranked(df: DataFrame, keys: list[Column], order: list[Column], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).where(F.col("__place") <= k).drop("__place")


def latest_per_group(
    df: DataFrame, group: list[str], order: list[Column], k: int
) -> DataFrame:
    """The first ``k`` rows of each group in the given order.

    Up to rank 1000 Spark keeps at most ``k`` rows per group and task before the shuffle.
    Beyond that a first pass over salted groups does the same, so a hot group never meets
    in one task whole.
    """
    keys = [F.col(c) for c in group]
    if k > _GROUP_LIMIT:
        # Salting by task spreads even identical copies of one row.
        salted = df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
        df = _ranked(salted, [*keys, F.col("__salt")], order, k).drop("__salt")
    return _ranked(df, keys, order, k)


def latest_overall(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows in the given order."""
    return df.orderBy(*order).limit(k)


def latest_batch(df: DataFrame, batch: str) -> DataFrame:
    """Only the rows of the newest batch.

    The newest value is read first, so that it reaches the scan as a literal.
    """
    kind = df.schema[batch].dataType
    newest = df.agg(F.max(batch).cast("string")).first()[0]
    return df.where(F.col(batch) == F.lit(newest).cast(kind))
