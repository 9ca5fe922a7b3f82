"""Columns over ids, paths and content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The group of shards that each kind of map goes to.
GROUPS = {
    "albedo": "albedo",
    "mask": "albedo",
    "ao": "material",
    "emissive": "material",
    "height": "material",
    "metallic": "material",
    "normal": "material",
    "roughness": "material",
    "specular": "material",
}
#: File name endings of a set's maps, in the order of its hash.
SUFFIXES = {"albedo": "", "normal": "_normal", "roughness": "_roughness", "height": "_height"}


def level_prefix(tpage: Column) -> Column:
    """Text before the first ``-vis-``, else before the first ``-tpage-``, else all of it."""
    return F.when(F.contains(tpage, F.lit("-vis-")), F.substring_index(tpage, "-vis-", 1)).when(F.contains(tpage, F.lit("-tpage-")), F.substring_index(tpage, "-tpage-", 1)).otherwise(tpage)


def strip_game(path: Column, game: str) -> Column:
    return F.regexp_replace(path, f"^{game}/", "")


def placement_columns(placement: Column) -> list[Column]:
    """dir, stem and one file path per map of ``<dir>/<stem>.png``."""
    bare = F.regexp_replace(placement, r"\.png$", "")
    return [F.substring_index(bare, "/", 1).alias("dir"), F.regexp_extract(bare, "([^/]*)$", 1).alias("stem"), *[F.concat(bare, F.lit(f"{end}.png")).alias(f"{kind}_path") for kind, end in SUFFIXES.items()]]


def hash_mod(text: Column, n: int | Column) -> Column:
    """sha256 of ``text`` as a number, modulo n: its sixteen 16-bit digits folded in turn."""
    n = F.lit(n) if isinstance(n, int) else n
    digest = F.sha2(text.cast("binary"), 256)
    digits = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.conv(F.substr(digest, i * 4 + 1, F.lit(4)), 16, 10).cast("long"))
    return F.aggregate(digits, F.lit(0).cast("long"), lambda a, d: (a * 65_536 + d) % n.cast("long"))


def part_of(material: Column, parts: int | Column) -> Column:
    """The sub-shard of a material: stable under insertion; 0 where there is one part."""
    parts = F.lit(parts) if isinstance(parts, int) else parts
    return F.when(parts <= 1, F.lit(0).cast("long")).otherwise(hash_mod(material, F.greatest(parts, F.lit(1))))


def group_of(kind: Column) -> Column:
    """albedo or material; an unknown kind of map is an error."""
    known = F.create_map(*[F.lit(x) for pair in GROUPS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, kind), F.raise_error(F.concat(F.lit("unknown map kind: "), kind)))


def shard_name(game: Column, profile: Column, preset: Column, grp: Column, cluster: Column, parts: Column, part: Column, sha: Column) -> Column:
    suffix = F.when(parts > 1, F.concat(F.lit("-p"), part.cast("string"))).otherwise(F.lit(""))
    return F.concat(F.concat_ws("-", game, profile, preset, grp, F.lit("shard"), cluster), suffix, F.lit("-"), F.substring(sha, 1, 12), F.lit(".rpack"))


def cache_key(src_sha: Column, fmt: Column, channels: Column, w: Column, h: Column, quality: Column) -> Column:
    """Content address of an encoded output: the source's hash and every parameter that shapes it."""
    dims = F.concat(F.lit("("), w.cast("string"), F.lit(", "), h.cast("string"), F.lit(")"))
    return F.sha2(F.concat(src_sha, F.concat_ws("|", F.lit("tc1"), fmt, channels, dims, F.lit("mips1"), quality)).cast("binary"), 256)
