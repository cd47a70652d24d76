"""Unions and counts."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def union_all(frames: Iterable[DataFrame | None]) -> DataFrame:
    """Union by column name of the frames that are there."""
    return reduce(lambda a, b: a.unionByName(b), [f for f in frames if f is not None])


def union_or_empty(spark: SparkSession, frames: Iterable[DataFrame], schema: StructType) -> DataFrame:
    """As ``union_all``; without any frame, no rows of the given schema."""
    frames = list(frames)
    return union_all(frames) if frames else spark.createDataFrame([], schema)


def count_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: both row counts and how far they are apart.

    Both counts are aggregates of one job; nothing is brought to the driver.
    """
    tagged = left.select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = tagged.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"), F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows")
    )
    return counts.withColumn("difference", F.abs(F.col("left_rows") - F.col("right_rows")))
