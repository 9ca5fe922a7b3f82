"""Ranges of a 64-bit key with near equal row counts, fixed before a shuffle so that a retried task sees the same ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, which a deployment sizes to its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def split_points(df: DataFrame, key: Column, ranges: int) -> list[int]:
    """At most ``ranges - 1`` ascending keys; a mergeable sketch, so no sort and a bounded result."""
    if ranges < 2:
        return []
    got = df.select(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 10 * ranges + 1000)).first()[0]
    return sorted(set(got or []))


def range_of(key: Column, splits: list[int]) -> Column:
    """How many split points are at most ``key``: a search in two steps of the square root of their number."""
    if not splits:
        return F.lit(0)
    step = max(1, int(len(splits) ** 0.5))
    every = F.array(*[F.lit(x).cast("long") for x in splits])
    coarse = F.array(*[F.lit(x).cast("long") for x in splits[step - 1 :: step]]) if len(splits) >= step else F.array().cast("array<long>")
    passed = F.size(F.filter(coarse, lambda x: x <= key)) * step
    rest = F.size(F.filter(F.slice(every, passed + 1, step), lambda x: x <= key))
    return (passed + rest).cast("int")
