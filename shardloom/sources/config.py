"""Config tables: fixed rows that small joins broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Codec format and channels of each map, by profile.
PROFILES = {
    "android-astc": {"albedo": ("astc_6x6", "rgb"), "height": ("eac_r11", "r"), "normal": ("astc_4x4", "rg"), "roughness": ("eac_r11", "r")},
    "android-etc2": {"albedo": ("etc2_rgb", "rgb"), "height": ("eac_r11", "r"), "normal": ("eac_rg11", "rg"), "roughness": ("eac_r11", "r")},
    "pc-bc": {"albedo": ("bc7", "rgb"), "height": ("bc4", "r"), "normal": ("bc5", "rg"), "roughness": ("bc4", "r")},
}
#: Vulkan name, block bytes, block width and height of each format.
FORMATS = {
    "astc_4x4": ("ASTC_4x4_UNORM_BLOCK", 16, 4, 4),
    "astc_6x6": ("ASTC_6x6_UNORM_BLOCK", 16, 6, 6),
    "bc1": ("BC1_RGB_UNORM_BLOCK", 8, 4, 4),
    "bc4": ("BC4_UNORM_BLOCK", 8, 4, 4),
    "bc5": ("BC5_UNORM_BLOCK", 16, 4, 4),
    "bc7": ("BC7_UNORM_BLOCK", 16, 4, 4),
    "eac_r11": ("EAC_R11_UNORM_BLOCK", 8, 4, 4),
    "eac_rg11": ("EAC_R11G11_UNORM_BLOCK", 16, 4, 4),
    "etc2_rgb": ("ETC2_R8G8B8_UNORM_BLOCK", 8, 4, 4),
}
#: Colour space of each map.
COLORSPACES = {"albedo": "srgb-encoded", "height": "linear", "normal": "linear", "roughness": "linear"}
#: Fixed values: (semantic, format, bound, value) of the quality gates.
THRESHOLDS = [
    ("albedo", "astc_4x4", "min", 38.0),
    ("albedo", "astc_6x6", "min", 33.0),
    ("albedo", "bc1", "min", 36.0),
    ("albedo", "bc7", "min", 40.0),
    ("albedo", "etc2_rgb", "min", 27.0),
    ("height", "astc_4x4", "max", 0.6),
    ("height", "astc_6x6", "max", 1.5),
    ("height", "bc4", "max", 1.6),
    ("height", "eac_r11", "max", 2.0),
    ("normal", "astc_4x4", "max", 17.0),
    ("normal", "astc_4x4", "p99_max", 95.0),
    ("normal", "bc5", "max", 17.0),
    ("normal", "bc5", "p99_max", 95.0),
    ("normal", "eac_rg11", "max", 17.0),
    ("normal", "eac_rg11", "p99_max", 95.0),
    ("roughness", "astc_4x4", "max", 0.6),
    ("roughness", "astc_6x6", "max", 1.4),
    ("roughness", "bc4", "max", 1.5),
    ("roughness", "eac_r11", "max", 1.8),
]
#: Fixed values: (profile, map, fallback format) proposed when a gate fails.
LADDER = [("android-astc", "albedo", "astc_4x4"), ("android-astc", "height", "astc_4x4"), ("android-astc", "roughness", "astc_4x4")]
#: Fixed values: (preset, group, sub-shards).
SPLITS = [("bonkers", "albedo", 2), ("bonkers", "material", 4), ("default", "albedo", 1), ("default", "material", 1), ("low", "albedo", 1), ("low", "material", 1)]


def profile_dim(spark: SparkSession) -> DataFrame:
    rows = [(p, m, f, c, COLORSPACES[m]) for p, maps in PROFILES.items() for m, (f, c) in maps.items()]
    return spark.createDataFrame(rows, "profile string, map string, format string, channels string, colorspace string")


def format_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in FORMATS.items()], "format string, vk string, block_bytes int, bw int, bh int")


def threshold_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(THRESHOLDS, "semantic string, format string, bound string, value double")


def ladder_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LADDER, "profile string, map string, fallback string")


def split_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SPLITS, "preset string, grp string, parts int")


def documents_at(spark: SparkSession, path: str) -> DataFrame:
    """value: the text of each JSON document at ``path``."""
    return spark.read.text(path, wholetext=True)


def cluster_rows(documents: DataFrame) -> DataFrame:
    """game, cluster, prefix of cluster documents (value): map of arrays to rows."""
    games = documents.select(F.explode(F.from_json("value", "games map<string,struct<clusters:map<string,array<string>>,overflow:string>>")["games"]).alias("game", "g"))
    return games.select("game", F.explode("g.clusters").alias("cluster", "prefixes")).select("game", "cluster", F.explode("prefixes").alias("prefix"))


def split_rows(documents: DataFrame) -> DataFrame:
    """preset, grp, parts of cluster documents' splits; comments are skipped."""
    splits = documents.select(F.explode(F.from_json("value", "splits map<string,string>")["splits"]).alias("preset", "x"))
    return splits.filter(F.col("preset") != "comment").select("preset", F.explode(F.from_json("x", "map<string,int>")).alias("grp", "parts"))


def threshold_rows(documents: DataFrame) -> DataFrame:
    """semantic, format, bound, value of threshold documents: an object of bounds for each semantic; comments and the ladder are no semantics."""
    parts = documents.select(F.explode(F.from_json("value", "map<string,string>")).alias("semantic", "x")).filter(~F.col("semantic").isin("comment", "ladder"))
    bounds = parts.select("semantic", F.explode(F.from_json("x", "map<string,string>")).alias("bound", "y")).filter(F.col("bound").isin("min", "max", "p99_max"))
    return bounds.select("semantic", F.explode(F.from_json("y", "map<string,double>")).alias("format", "value"), "bound").select("semantic", "format", "bound", "value")


def ladder_rows(documents: DataFrame) -> DataFrame:
    """profile, map, fallback of threshold documents' ladder; comments are skipped."""
    steps = documents.select(F.explode(F.from_json(F.get_json_object("value", "$.ladder"), "map<string,string>")).alias("profile", "x")).filter(F.col("profile") != "comment")
    return steps.select("profile", F.explode(F.from_json("x", "map<string,string>")).alias("map", "fallback"))


def cluster_dim(spark: SparkSession, path: str) -> DataFrame:
    return cluster_rows(documents_at(spark, path))


def split_file(spark: SparkSession, path: str) -> DataFrame:
    return split_rows(documents_at(spark, path))


def threshold_file(spark: SparkSession, path: str) -> DataFrame:
    return threshold_rows(documents_at(spark, path))


def ladder_file(spark: SparkSession, path: str) -> DataFrame:
    return ladder_rows(documents_at(spark, path))
