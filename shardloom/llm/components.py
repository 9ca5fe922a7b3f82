"""Connected components of an edge table by alternating stars; every step is two shuffles of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import discard, scratch


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (``large``) or not larger neighbours on the least of its neighbours and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    if not large:
        both = both.filter("v < u")
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
    hung = both.filter("v > u") if large else both.unionByName(least.select(F.col("w").alias("u"), F.col("w").alias("v")))
    return hung.join(least, hung["u"] == least["w"]).select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its least node. Loops and nulls are ignored."""
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b").distinct()
    spark = edges.sparkSession
    path = scratch(spark, "components")
    edges.write.parquet(path)
    edges, seen = spark.read.schema("a long, b long").parquet(path), None
    for _ in range(rounds):
        before, path = path, scratch(spark, "components")
        _stars(_stars(edges, True), False).write.parquet(path)
        edges = spark.read.schema("a long, b long").parquet(path)
        discard(spark, before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components didn't settle")
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
