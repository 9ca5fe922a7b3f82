"""Shards: assignment, names, layout, balance and size checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions import geometry, keys
from ..sources.scratch import scratch

FAMILY = ["game", "profile", "preset", "grp", "cluster", "part"]


def cluster_of(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """The frozen cluster of the tpage's prefix; an unknown one goes to ``overflow``."""
    rows = rows.withColumn("prefix", keys.level_prefix(F.col("tpage")))
    return rows.join(F.broadcast(clusters), "prefix", "left").withColumn("cluster", F.coalesce("cluster", F.lit("overflow")))


def shard_family(outputs: DataFrame, clusters: DataFrame, splits: DataFrame) -> DataFrame:
    """Adds grp, cluster, parts and part."""
    rows = cluster_of(outputs.withColumn("grp", keys.group_of(F.col("map"))), clusters)
    rows = rows.join(F.broadcast(splits), ["preset", "grp"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    return rows.withColumn("part", keys.part_of(F.col("mat"), F.col("parts")))


def family_rollup(entries: DataFrame, family: list[str] = FAMILY) -> DataFrame:
    return entries.groupBy(*family).agg(F.count("*").alias("entries"), F.sum("size").alias("bytes"))


RANGE_ROWS = 1_000_000
SAMPLES = 20  # keys of a sample for each range


def bounds_of(rows: DataFrame, keys: list[str], ranges: int) -> list[Row]:
    """At most ``ranges - 1`` ascending keys that cut the rows into ranges of about equal counts.

    They are taken from the keys of the least hashes, ``SAMPLES`` for each range, before any shuffle; so a task that runs again finds the same.
    """
    keyed = rows.select(F.struct(*keys).alias("k"))
    sample = keyed.orderBy(F.xxhash64("k"), "k").limit(SAMPLES * ranges).agg(F.array_sort(F.collect_list("k")).alias("s")).first()["s"] or []
    return [sample[i * len(sample) // ranges] for i in range(1, ranges) if sample and i * len(sample) // ranges > 0]


def range_of(keys: list[str], bounds: list[Row], typed: DataFrame) -> Column:
    """How many bounds are at most the row's key, whose fields have the types that they have in ``typed``: a search in two steps of the root of their number."""
    if not bounds:
        return F.lit(0)
    fields = typed.select(*keys).schema
    every = [F.struct(*[F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(b, fields, strict=True)]) for b in bounds]
    step, key = max(1, int(len(every) ** 0.5)), F.struct(*keys)
    passed = F.size(F.filter(F.array(*every[step - 1 :: step]), lambda x: x <= key)) * step
    return (passed + F.size(F.filter(F.slice(F.array(*every), passed + 1, step), lambda x: x <= key))).cast("int")


def family_ranges(rows: DataFrame, family: list[str], order: list[str], range_rows: int) -> DataFrame | None:
    """family, bounds: ascending order keys that cut each family of more than ``range_rows`` rows into ranges of about as many; None if there is none.

    A key in some 50,000 is sampled, of the large families alone, by its hash.
    """
    if rows.count() <= range_rows:  # from the files' footers alone where the rows are a table's
        return None
    large = rows.groupBy(*family).agg(F.count("*").alias("_n")).filter(F.col("_n") > range_rows)
    large = large.select(*[F.col(c).alias(f"_{c}") for c in family])
    if large.isEmpty():
        return None
    same = F.lit(True)
    for c in family:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    key = F.struct(*order)
    sample = rows.filter(F.pmod(F.xxhash64(*family, *order), F.lit(max(1, range_rows // SAMPLES))) == 0).join(large, same, "left_semi")
    keys = F.array_sort(F.collect_list(key))
    sample = sample.groupBy(*family).agg(keys.alias("_k"))
    path = scratch(rows.sparkSession, "range-bounds")
    sample.select(*family, F.filter("_k", lambda x, i: i % SAMPLES == SAMPLES - 1).alias("_bounds")).write.parquet(path)
    bounds = rows.sparkSession.read.parquet(path)
    # A bound stands for range_rows rows; beyond so many, Spark chooses the join by the table's size.
    return F.broadcast(bounds) if (bounds.agg(F.sum(F.size("_bounds"))).first()[0] or 0) <= 100_000 else bounds


def sums_before(rows: DataFrame, family: list[str], order: list[str], weights: dict[str, Column], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with, by name, the sum of each weight over the rows before it in its family; 0 before the first.

    A family of more than ``range_rows`` rows is summed in ranges of its order, as many as it needs, so that no task holds it; each range begins with the sums of those before.
    Families' sizes are counted from their columns alone first; rows are shuffled once.
    """
    rows = rows.withColumns(weights)
    bounds = family_ranges(rows, family, order, range_rows)
    least = Window.unboundedPreceding

    def before(window, c: str) -> Column:
        return F.coalesce(F.sum(c).over(window.rowsBetween(least, -1)), F.lit(0))

    kept = [c for c in rows.columns if c not in weights]
    if bounds is None:
        within = Window.partitionBy(*family).orderBy(*order)
        return rows.select(*kept, *[before(within, w).alias(w) for w in weights])
    bounds = bounds.select(*[F.col(c).alias(f"_{c}") for c in family], "_bounds")
    same = F.lit(True)
    for c in family:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    key = F.struct(*order)
    passed = F.size(F.filter("_bounds", lambda x: x <= key))
    rows = rows.join(bounds, same, "left").withColumn("_range", F.coalesce(F.when(F.col("_bounds").isNotNull(), passed), F.lit(0))).select(*kept, *weights, "_range")
    place = [*family, "_range"]
    sums = rows.groupBy(*place).agg(*[F.sum(w).alias(w) for w in weights])
    earlier = Window.partitionBy(*family).orderBy("_range")  # a row for each range
    heads = sums.select(*place, F.lit(0).alias("_mark"), *[before(earlier, w).alias(w) for w in weights])
    within = Window.partitionBy(*place).orderBy("_mark", *order)
    every = rows.withColumn("_mark", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    return every.select(*kept, "_mark", *[before(within, w).alias(w) for w in weights]).filter("_mark = 1").drop("_mark")


def pack_layout(entries: DataFrame, family: list[str], order: list[str], range_rows: int = RANGE_ROWS, **weights: Column) -> DataFrame:
    """Aligned offset of each payload: 16 bytes of header and the aligned sizes before it; and the sums of other weights before it."""
    laid = sums_before(entries, family, order, {"offset": geometry.align16(F.col("size")), **weights}, range_rows)
    return laid.withColumn("offset", F.lit(16) + F.col("offset"))


def pack_index(layout: DataFrame, family: list[str]) -> DataFrame:
    """Where the index of each pack begins, unaligned, and its number of entries."""
    return layout.groupBy(*family).agg(F.max(F.col("offset") + F.col("size")).alias("index_offset"), F.count("*").alias("entry_count"))


STATS = ("normal_dc_x", "normal_dc_y", "height_mean", "height_norm", "height_lambda_tiles")


def pack_entries(outputs: DataFrame, materials: DataFrame, formats: DataFrame) -> DataFrame:
    """``outputs`` with ``record``, the JSON of an index record without offset, size and hash of the payload, which the pack gives it.

    Outputs have (mat, map, format, w, h, mip_levels, colorspace, channels) and ``STATS``; materials (mat, game, wrap_mode, alpha_mode); formats
    (format, vk). Modes that a material doesn't have are the defaults; absent channels and statistics are left out.
    """
    known = materials.select("mat", "game", F.coalesce("wrap_mode", F.lit("repeat")).alias("wrap_mode"), F.coalesce("alpha_mode", F.lit("none")).alias("alpha_mode"))
    rows = outputs.join(known, "mat").join(F.broadcast(formats.select("format", F.concat(F.lit("VK_FORMAT_"), "vk").alias("vk_format"))), "format")
    stats = F.when(F.coalesce(*STATS).isNotNull(), F.struct(*STATS))
    record = F.struct(
        "alpha_mode", "channels", "colorspace", F.col("vk_format").alias("format"), F.col("h").alias("height"), F.concat_ws("/", "game", "mat").alias("id"),
        F.col("mat").alias("key"), "map", "mip_levels", stats.alias("stats"), F.col("w").alias("width"), "wrap_mode",
    )
    return rows.withColumn("record", F.to_json(record))


def uniqueness_check(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def part_balance(rows: DataFrame, parts: int) -> DataFrame:
    """Materials of each part, empty parts included, with whether the largest stays under twice the mean."""
    counted = rows.select("mat").distinct().withColumn("part", keys.part_of(F.col("mat"), parts)).groupBy("part").agg(F.count("*").alias("n"))
    every = rows.sparkSession.range(parts).select(F.col("id").alias("part"))
    all_ = Window.partitionBy(F.lit(0))  # ``parts`` rows
    full = every.join(counted, "part", "left").select("part", F.coalesce("n", F.lit(0)).alias("n"))
    return full.withColumn("balanced", (F.max("n").over(all_) < 2 * F.avg("n").over(all_)) & (F.min("n").over(all_) > 0))


def size_band_check(shards: DataFrame, least: int, most: int) -> DataFrame:
    return shards.groupBy("preset").agg(F.max("size").alias("largest"), F.count_if(F.col("size") > most).alias("over"), F.count_if(F.col("size") < least).alias("under"), F.count("*").alias("shards"))


def largest_shards(shards: DataFrame, k: int) -> DataFrame:
    """The k largest of each preset."""
    rank = F.row_number().over(Window.partitionBy("preset").orderBy(F.desc("size"), "name"))
    return shards.withColumn("rank", rank).filter(F.col("rank") <= k)


def change_cost(entries: DataFrame, shards: DataFrame) -> DataFrame:
    """Bytes that a change of one material makes a client fetch again: least and most over the materials, by profile and preset."""
    held = entries.select("mat", *FAMILY).distinct().join(shards, FAMILY)
    cost = held.groupBy("profile", "preset", "mat").agg(F.sum("bytes").alias("cost"))
    return cost.groupBy("profile", "preset").agg(F.min("cost").alias("least"), F.max("cost").alias("most"), F.count("*").alias("materials"))


def set_equality(a: DataFrame, b: DataFrame) -> DataFrame:
    """The symmetric difference of two key sets, with the side that has the key."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def pick_samples(materials: DataFrame, wanted: list[str], quick: bool = False) -> DataFrame:
    """The listed materials that exist, in the list's order; only the first with ``quick``."""
    listed = materials.sparkSession.createDataFrame(list(enumerate(wanted[: 1 if quick else None])), "ordinal int, mat string")
    return materials.join(F.broadcast(listed), "mat")
