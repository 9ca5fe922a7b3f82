"""Benchmark analytics over encoder runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Means of the metrics of good runs; of these the greatest.
MEANS = ("psnr_db", "mae", "ang_mean_deg", "ang_p99_deg", "encode_s")
GREATEST = ("max_err", "ang_max_deg")
#: The metric that ranks encoders of a semantic, and whether more is better.
RANKED_BY = {
    "albedo": ("psnr_db", True),
    "height": ("mae", False),
    "normal": ("ang_mean_deg", False),
    "roughness": ("mae", False),
}


def encoder_summary(results: DataFrame) -> DataFrame:
    """By semantic, format and encoder: the mean of each metric and of the seconds, the greatest errors, runs and failures.

    Failed runs count only as such; a metric that no run of a group has is null.
    """
    good = F.col("error").isNull()
    means = [F.avg(F.when(good, F.col(c))).alias(c) for c in MEANS]
    most = [F.max(F.when(good, F.col(c))).alias(c) for c in GREATEST]
    return results.groupBy("semantic", "format", "encoder").agg(*means, *most, F.count("*").alias("runs"), F.count_if(~good).alias("failures"))


def encoder_winner(summary: DataFrame, formats: DataFrame) -> DataFrame:
    """Rank of encoders of equal bits a pixel within a semantic, by its metric, best first, then less time; and each score's ratio to the best.

    ``formats`` has (format, block_bytes, bw, bh). A ratio is how many times worse: the best PSNR over a PSNR, an error over the least
    error. Encoders without the metric come last and have no ratio.
    """
    bpp = F.col("block_bytes") * 8 / (F.col("bw") * F.col("bh"))
    rows = summary.join(F.broadcast(formats.select("format", bpp.alias("bpp"))), "format")
    metric, more = F.lit(None).cast("double"), F.lit(False)
    for semantic, (name, up) in RANKED_BY.items():
        metric = F.when(F.col("semantic") == semantic, F.col(name)).otherwise(metric)
        more = F.when(F.col("semantic") == semantic, F.lit(up)).otherwise(more)
    rows = rows.withColumn("score", metric).withColumn("cost", F.when(more, -F.col("score")).otherwise(F.col("score")))
    group = Window.partitionBy("semantic", "bpp")
    rank = F.row_number().over(group.orderBy(F.asc_nulls_last("cost"), "encode_s", "format", "encoder"))
    best = F.when(more, F.max("score").over(group) / F.col("score")).otherwise(F.col("score") / F.min("score").over(group))
    return rows.select("semantic", "bpp", "format", "encoder", "score", rank.alias("rank"), best.alias("ratio_to_best"))
