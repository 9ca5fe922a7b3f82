"""Ingest: sets of maps by content, distinct materials, what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shards import RANGE_ROWS, sums_before

KINDS = ("albedo", "normal", "roughness", "height")


def set_hash(blobs: DataFrame) -> DataFrame:
    """placement, set_sha256: hash of the maps' hex hashes in the fixed order of ``KINDS``."""
    shas = [F.max(F.when(F.col("map") == k, F.col("sha"))) for k in KINDS]
    return blobs.groupBy("placement").agg(F.sha2(F.concat_ws("", *shas).cast("binary"), 256).alias("set_sha256"))


def incomplete_sets(entries: DataFrame, blobs: DataFrame) -> DataFrame:
    """placement, missing: one row for each required map that has no blob."""
    wanted = entries.select("placement", F.explode(F.array(*map(F.lit, KINDS))).alias("map"))
    return wanted.join(blobs.select("placement", "map"), ["placement", "map"], "left_anti").select("placement", F.col("map").alias("missing"))


GROUP = ["canonical_id", "set_sha256"]


def distinct_materials(entries: DataFrame, hashes: DataFrame, *more: Column) -> DataFrame:
    """One row per distinct content of a canonical id, with the count ``n`` of its placements and their first path parts, ``levels``.

    The group that holds the canonical placement keeps its id, others are named by their least placement. All columns are
    combined before the shuffle and none grows with a group: levels are folders. ``more`` are further aggregates.
    """
    own = F.col("placement") == F.concat("canonical_id", F.lit(".png"))
    groups = entries.join(hashes, "placement").groupBy(*GROUP)
    levels = F.array_sort(F.collect_set(F.substring_index("placement", "/", 1)))
    groups = groups.agg(F.min("placement").alias("representative"), F.bool_or(own).alias("is_canonical"), F.bool_or("recale").alias("recale"), F.count("placement").alias("n"), levels.alias("levels"), *more)
    name = F.when(F.col("is_canonical"), F.col("canonical_id")).otherwise(F.regexp_replace("representative", r"\.png$", ""))
    return groups.withColumns({"material": name, "is_variant": ~F.col("is_canonical")}).drop("is_canonical")


def placement_map(entries: DataFrame, hashes: DataFrame) -> DataFrame:
    """placement, material: a row each, also of a group that holds a third of all placements."""
    rows, names = entries.join(hashes, "placement").select("placement", *GROUP).alias("e"), distinct_materials(entries, hashes).alias("m")
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"m.{c}")) for c in GROUP]
    return rows.join(names, same[0] & same[1]).select("e.placement", "m.material")


def dedup_materials(entries: DataFrame, hashes: DataFrame) -> DataFrame:
    """``distinct_materials`` as documents: each with the sorted array of its placements, which holds a group in one row."""
    rows = distinct_materials(entries, hashes, F.array_sort(F.collect_list("placement")).alias("placements"))
    return rows.select("material", "canonical_id", "is_variant", "recale", "set_sha256", "representative", "placements")


PAGE = 1000


def placement_pages(entries: DataFrame, hashes: DataFrame, page: int = PAGE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """material, page, placements: the sorted placements of each material, at most ``page`` to a row, however many it has.

    Places in a group come from counts over ranges of it, so that a group with a third of all placements is in no task's hands as a whole.
    """
    rows = entries.join(hashes, "placement").select("placement", *GROUP)
    placed = sums_before(rows, GROUP, ["placement"], {"place": F.lit(1)}, range_rows)
    pages = placed.groupBy(*GROUP, F.floor(F.col("place") / page).cast("long").alias("page")).agg(F.array_sort(F.collect_list("placement")).alias("placements")).alias("p")
    names = distinct_materials(entries, hashes).alias("m")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"m.{c}")) for c in GROUP]
    return pages.join(names, same[0] & same[1]).select("m.material", "p.page", "p.placements")


def paged_placement_map(pages: DataFrame) -> DataFrame:
    """placement, material of pages."""
    return pages.select(F.explode("placements").alias("placement"), "material")


def paged_levels(pages: DataFrame) -> DataFrame:
    """material, levels: sorted distinct first path parts, combined page by page."""
    tpages = F.array_distinct(F.transform("placements", lambda p: F.substring_index(p, "/", 1)))
    return pages.select("material", F.explode(tpages).alias("level")).groupBy("material").agg(F.array_sort(F.collect_set("level")).alias("levels"))


def material_levels(materials: DataFrame) -> DataFrame:
    """Sorted distinct first path parts of a material's placements, and what it is a variant of."""
    return materials.select("material", "levels", F.when(F.col("is_variant"), F.col("canonical_id")).alias("variant_of"), (F.col("recale") & F.col("is_variant")).alias("recale"))


def representative_member(rows: DataFrame, group: list[str], key: str, values: list[str]) -> DataFrame:
    """The row of the least ``key`` of each group; combinable before the shuffle."""
    return rows.groupBy(*group).agg(F.min(F.struct(key, *values)).alias("r")).select(*group, "r.*")


def orphan_references(references: DataFrame, records: DataFrame) -> DataFrame:
    """Rows whose ``target`` is no record's ``id``."""
    return references.join(records.select(F.col("id").alias("target")), "target", "left_anti")


def record_summary(records: DataFrame, outputs: DataFrame) -> DataFrame:
    """Records with a wrap mode and with reference dimensions, and outputs, hits and failures: one row, for two counts over either table."""
    known = records.agg(F.count("*").alias("records"), F.count("wrap_mode").alias("wrap_modes"), F.count("esrgan_dims").alias("esrgan_dims"))
    built = outputs.agg(F.count("*").alias("outputs"), F.count_if(F.col("status") == "hit").alias("hits"), F.count_if(~F.col("gate_ok")).alias("failures"))
    return known.crossJoin(built)


def catalog_summary(materials: DataFrame) -> DataFrame:
    """Placements, materials, canonical ones and variants."""
    return materials.agg(F.sum("n").alias("placements"), F.count("*").alias("materials"), F.count_if(~F.col("is_variant")).alias("canonical"), F.count_if("is_variant").alias("variants"), F.count_distinct("canonical_id").alias("canonical_ids"))


#: The wrap mode that each accepted verdict of a tiling check stands for.
WRAP_MODES = {
    "both": "repeat",
    "horizontal": "repeat_x",
    "none": "clamp",
    "vertical": "repeat_y",
}


def wrap_modes(entities: DataFrame, verdicts: DataFrame) -> DataFrame:
    """id, wrap_mode by the first of an entity's ``candidates`` with an accepted verdict (candidate, value); null if none has one."""
    modes = F.create_map(*[F.lit(x) for pair in WRAP_MODES.items() for x in pair])
    return first_match(entities, verdicts, list(WRAP_MODES)).select("id", F.try_element_at(modes, F.col("value")).alias("wrap_mode"))


def first_match(entities: DataFrame, lookup: DataFrame, accepted: list) -> DataFrame:
    """id, value: the first of an entity's ``candidates`` (an array, in order) whose lookup value is accepted; null if none is."""
    tries = entities.select("id", F.posexplode("candidates").alias("pos", "candidate"))
    hits = tries.join(lookup.filter(F.col("value").isin(accepted)), "candidate").groupBy("id").agg(F.min_by("value", "pos").alias("value"), F.min("pos").alias("pos"))
    return entities.select("id").join(hits, "id", "left")
