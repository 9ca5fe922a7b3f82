"""The build: job grid, policies, cache, gates, reports, affected jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, keys


def subset(rows: DataFrame, **wanted: list) -> DataFrame:
    """Rows whose columns are in the given lists; an empty list keeps all."""
    for column, values in wanted.items():
        if values:
            rows = rows.filter(F.col(column).isin(values))
    return rows


def job_grid(materials: DataFrame, profiles: DataFrame, presets: DataFrame) -> DataFrame:
    """Each row's material x map with every profile that has the map, and every preset: two broadcast joins of a few rows."""
    return materials.join(F.broadcast(profiles), "map").join(F.broadcast(presets), how="cross")


def with_preset_dims(rows: DataFrame) -> DataFrame:
    w, h = geometry.preset_dims(F.col("preset"), F.col("w"), F.col("h"), F.col("rw"), F.col("rh"))
    return rows.withColumns({"pw": w, "ph": h})


def mip_levels(rows: DataFrame, min_size: int = 1) -> DataFrame:
    """A row per level with its dimensions, until the larger is at most ``min_size``."""
    last = F.array_max(F.filter(F.sequence(F.lit(0), geometry.level_count(F.col("w"), F.col("h")) - 1), lambda k: (k == 0) | (F.call_function("shiftright", F.greatest("w", "h"), k - 1) > min_size)))
    rows = rows.withColumn("level", F.explode(F.sequence(F.lit(0), last)))
    return rows.withColumns({"lw": geometry.level_dim(F.col("w"), F.col("level")), "lh": geometry.level_dim(F.col("h"), F.col("level"))})


def encoded_size(levels: DataFrame, formats: DataFrame, keys_: list[str]) -> DataFrame:
    """Bytes of all levels of each output."""
    sized = levels.join(F.broadcast(formats), "format")
    return sized.groupBy(*keys_).agg(F.sum(geometry.block_bytes(F.col("lw"), F.col("lh"), F.col("bw"), F.col("bh"), F.col("block_bytes"))).alias("bytes"), F.count("*").cast("int").alias("levels"))


def gate_bounds(thresholds: DataFrame) -> DataFrame:
    """map, format, gate_min, gate_max, gate_p99_max of rows (semantic, format, bound, value)."""
    return thresholds.groupBy(F.col("semantic").alias("map"), "format").agg(*[F.max(F.when(F.col("bound") == b, F.col("value"))).alias(f"gate_{b}") for b in ("min", "max", "p99_max")])


def attach_policy(grid: DataFrame, profiles: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Format, channels and colour space by (profile, map); the gate bounds by (map, format), as columns."""
    return grid.join(F.broadcast(profiles), ["profile", "map"]).join(F.broadcast(gate_bounds(thresholds)), ["map", "format"], "left")


def quality_gate(outputs: DataFrame) -> DataFrame:
    """gate_ok by semantic, from bounds attached as gate_min, gate_max, gate_p99_max; an absent bound passes what its default does."""
    albedo = F.col("psnr_db") >= F.coalesce("gate_min", F.lit(0.0))
    normal = (F.col("ang_mean_deg") <= F.coalesce("gate_max", F.lit(99.0))) & (F.col("ang_p99_deg") <= F.coalesce("gate_p99_max", F.lit(999.0)))
    other = F.col("mae") <= F.coalesce("gate_max", F.lit(255.0))
    return outputs.withColumn("gate_ok", F.when(F.col("map") == "albedo", albedo).when(F.col("map") == "normal", normal).otherwise(other))


def with_cache_key(rows: DataFrame, quality: str = "thorough") -> DataFrame:
    return rows.withColumn("cache_key", keys.cache_key(F.col("sha"), F.col("format"), F.col("channels"), F.col("pw"), F.col("ph"), F.lit(quality)))


def cache_lookup(jobs: DataFrame, cache: DataFrame, stats_version: int) -> DataFrame:
    """``status``: hit, miss, or stale_stats for a hit with old statistics of a map that has any."""
    joined = jobs.join(cache, "cache_key", "left")
    stale = (F.col("stats_version") != stats_version) & F.col("map").isin("normal", "height")
    return joined.withColumn("status", F.when(F.col("stats_version").isNull(), "miss").when(stale, "stale_stats").otherwise("hit"))


METRICS = ("psnr_db", "ang_mean_deg", "ang_p99_deg", "mae")


def cache_verdicts(jobs: DataFrame, cache: DataFrame, thresholds: DataFrame, stats_version: int) -> DataFrame:
    """Jobs with ``status``, and for those found the stored metrics and a fresh verdict by today's bounds; a miss has neither.

    ``cache`` has (cache_key, stats_version) and the metrics, unrounded.
    """
    bounds = gate_bounds(thresholds)
    rows = cache_lookup(jobs, cache, stats_version).join(F.broadcast(bounds), ["map", "format"], "left")
    return quality_gate(rows).withColumn("gate_ok", F.when(F.col("status") != "miss", F.col("gate_ok")))


def cache_misses(jobs: DataFrame, cache: DataFrame) -> DataFrame:
    return jobs.join(cache.select("cache_key"), "cache_key", "left_anti")


def override_proposals(failures: DataFrame, ladder: DataFrame) -> DataFrame:
    """The fallback format of each failed output; null where the profile has no ladder."""
    return failures.join(F.broadcast(ladder), ["profile", "map"], "left")


def affected_materials(paths: DataFrame, sample: DataFrame, game: str = "jak1") -> DataFrame:
    """material, full_sample of the changed ``path``s of a game; a changed tool, schema or toolchain adds the fixed sample."""
    parts, path = F.split("path", "/"), F.col("path")
    raw = path.startswith(f"raw/{game}/") & (F.size(parts) >= 4)
    meta = path.startswith(f"metadata/{game}/materials/") & (F.size(parts) >= 5)
    named = F.when(raw, F.concat_ws("/", F.try_element_at(parts, F.lit(3)), F.try_element_at(parts, F.lit(4)))).when(meta, F.concat_ws("/", F.try_element_at(parts, F.lit(4)), F.regexp_replace(F.try_element_at(parts, F.lit(5)), r"\.json$", "")))
    tools = ~raw & ~meta & (path.startswith("tools/") | path.startswith("schemas/") | path.startswith("toolchain/"))
    rows = paths.select(named.alias("material"), tools.alias("tools"))
    full = rows.agg(F.coalesce(F.bool_or("tools"), F.lit(False)).alias("full_sample"))
    found = rows.select("material").filter("material is not null")
    extra = sample.select("material").crossJoin(F.broadcast(full)).filter("full_sample").select("material")
    return found.unionByName(extra).distinct().crossJoin(F.broadcast(full))


def affected_jobs(grid: DataFrame, affected: DataFrame) -> DataFrame:
    return grid.join(affected.select("material"), "material", "left_semi")


def build_report(outputs: DataFrame, shards: DataFrame, ladder: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(failures with their proposals, rows of the shards, counters by profile and preset)."""
    failures = override_proposals(outputs.filter(~F.col("gate_ok")), ladder)
    listed = shards.select("name", "game", "profile", "preset", F.col("grp").alias("group"), "cluster", "part", F.col("sha").alias("sha256"), "size", "entry_count")
    counters = outputs.groupBy("profile", "preset").agg(F.count("*").alias("outputs"), F.count_if(F.col("status") == "hit").alias("hits"), F.count_if(~F.col("gate_ok")).alias("failures"))
    return failures, listed, counters


def write_report(failures: DataFrame, shards: DataFrame, counters: DataFrame, path: str) -> None:
    failures.write.partitionBy("profile", "preset").json(f"{path}/failures")
    shards.write.partitionBy("profile", "preset").json(f"{path}/shards")
    counters.write.json(f"{path}/counters")
