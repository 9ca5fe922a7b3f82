"""Schema rules as data-quality checks, and image headers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import GROUPS


def validate_records(rows: DataFrame, key: str, rules: dict[str, tuple[Column, Column]], nested: tuple[Column, ...] = ()) -> DataFrame:
    """id, rule, value: one row per violated rule; a rule is (condition that holds for sound rows, value to show). A null condition is a violation.

    ``nested`` are further violations as ``each_item`` and ``each_entry`` give them, with their paths as rules.
    """
    bad = F.flatten(F.array(violations(rules), *nested)) if nested else violations(rules)
    return rows.select(F.col(key).alias("id"), F.explode(bad).alias("v")).select("id", "v.*")


def violations(rules: dict[str, tuple[Column, Column]], path: Column | None = None) -> Column:
    """The violated rules as an array of (rule, value), below a path if there is one."""
    named = {n: F.lit(n) if path is None else F.concat(path, F.lit(f".{n}")) for n in rules}
    found = [F.when(~F.coalesce(ok, F.lit(False)), F.struct(named[n].alias("rule"), value.cast("string").alias("value"))) for n, (ok, value) in rules.items()]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


NONE = "array<struct<rule:string,value:string>>"


def each_item(items: Column, path: str, rules: Callable[[Column], Rules]) -> Column:
    """Violations in each item of an array, their rules as ``path[i].name``; none if there is no array."""
    found = F.flatten(F.transform(items, lambda x, i: violations(rules(x), F.concat(F.lit(f"{path}["), i.cast("string"), F.lit("]")))))
    return F.coalesce(found, F.array().cast(NONE))


def each_entry(entries: Column, path: str, rules: Callable[[Column], Rules]) -> Column:
    """Violations in each value of a map, their rules as ``path.key.name``; none if there is no map."""
    found = F.flatten(F.transform(F.map_entries(entries), lambda e: violations(rules(e["value"]), F.concat(F.lit(f"{path}."), e["key"]))))
    return F.coalesce(found, F.array().cast(NONE))


Rules = dict[str, tuple[Column, Column]]
#: Fixed values of the schemas.
GAMES = ("jak1", "jak2", "jak3")
PROFILES = ("android-astc", "android-etc2", "pc-bc", "pc-bc-legacy", "rgba8-fallback")
PRESETS = ("bonkers", "default", "low")
WRAP = ("clamp", "repeat", "repeat_x", "repeat_y")
ALPHA = ("binary", "none", "premultiplied", "progressive")
COLORSPACES = ("linear", "srgb-encoded")
CHANNELS = ("r", "rg", "rgb", "rgba")
SHA256 = "^[0-9a-f]{64}$"
MATERIAL_ID = "^jak[123]/[a-z0-9-]+/[A-Za-z0-9_.-]+$"
SHARD_NAME = r"^jak[123]-[a-z0-9-]+-shard-[a-z0-9-]+(-p[0-9]+)?-[0-9a-f]{12}\.rpack$"
MATERIAL_KEYS = [
    "alpha_mode", "derived", "esrgan_dims", "format_overrides", "game", "id", "levels", "maps", "master_dims", "mip_policy", "notes", "original", "recale", "required", "schema_version",
    "variant_of", "wrap_mode",
]


def one_of(name: str, allowed: tuple[str, ...], optional: bool = False) -> Rules:
    c = F.col(name)
    return {name: (c.isin(*allowed) | (c.isNull() if optional else F.lit(False)), c)}


def matches(name: str, pattern: str, optional: bool = False) -> Rules:
    c = F.col(name)
    return {name: (c.rlike(pattern) | (c.isNull() if optional else F.lit(False)), c)}


def within(name: str, least: float, most: float | None = None, optional: bool = False) -> Rules:
    c = F.col(name)
    ok = (c >= least) & (c <= most if most is not None else F.lit(True))
    return {name: (F.coalesce(ok, F.lit(optional)), c)}


def present(*names: str) -> Rules:
    return {n: (F.col(n).isNotNull(), F.col(n)) for n in names}


def sized(name: str) -> Rules:
    """Two dimensions of at least 1, or none."""
    c = F.col(name)
    return {name: (c.isNull() | ((F.size(c) == 2) & F.forall(c, lambda x: F.coalesce(x >= 1, F.lit(False)))), F.concat_ws(",", c.cast("array<string>")))}


def of_maps(field: str, sound, optional: bool = True) -> Rules:
    """A rule for one field of each of a material's maps."""
    values = F.transform(F.map_values("maps"), lambda m: m[field])
    return {field: (F.coalesce(F.forall(values, lambda x: F.coalesce(sound(x), F.lit(optional))), F.lit(True)), F.concat_ws(",", values))}


def material_rules(text: str = "value") -> Rules:
    """Rules of a material's record, whose JSON is in column ``text`` beside its typed fields."""
    rules = {"schema_version": (F.col("schema_version") == 1, F.col("schema_version"))} | matches("id", MATERIAL_ID) | one_of("game", GAMES) | one_of("wrap_mode", WRAP, True) | one_of("alpha_mode", ALPHA, True) | sized("master_dims") | sized("esrgan_dims")
    kinds, extra = F.map_keys("maps"), unknown_keys(F.col(text), MATERIAL_KEYS)
    rules["maps"] = ((F.size("maps") >= 1) & F.forall(kinds, lambda k: k.isin(*GROUPS)), F.concat_ws(",", kinds))
    rules |= of_maps("colorspace", lambda x: x.isin(*COLORSPACES), False) | of_maps("channels", lambda x: x.isin(*CHANNELS)) | of_maps("source_sha256", lambda x: x.rlike(SHA256))
    return rules | {"unknown": (F.size(extra) == 0, F.concat_ws(",", extra))}


def shard_rules() -> Rules:
    """Rules of a manifest's shard."""
    rules = matches("name", SHARD_NAME) | one_of("game", GAMES) | one_of("profile", PROFILES) | one_of("preset", PRESETS) | one_of("group", ("albedo", "material")) | present("cluster", "url")
    return rules | matches("sha256", SHA256) | within("size", 1) | within("entry_count", 1)


def entry_rules() -> Rules:
    """Rules of a pack's index entry, its statistics as columns."""
    rules = present("id", "key", "format") | one_of("map", tuple(GROUPS)) | within("width", 1) | within("height", 1) | within("mip_levels", 1) | within("size", 1) | matches("sha256", SHA256)
    rules |= {"offset": ((F.col("offset") >= 16) & (F.col("offset") % 16 == 0), F.col("offset"))}
    rules |= one_of("colorspace", COLORSPACES) | one_of("alpha_mode", ALPHA, True) | one_of("wrap_mode", WRAP, True) | one_of("channels", CHANNELS, True)
    return rules | within("height_mean", 0, 1, True) | within("height_norm", 0.5, 16, True) | within("height_lambda_tiles", 1 / 1024, 1, True)


MANIFEST = (
    "schema_version int, asset_version string, games array<string>, engine_compat struct<min_recharged_version:string,max_recharged_version:string,min_loader_version:int,required_features:array<string>>, "
    "profiles array<string>, presets array<string>, shards array<struct<name:string,game:string,profile:string,preset:string,`group`:string,cluster:string,sha256:string,size:bigint,url:string,release_tag:string,entry_count:bigint,requires_features:array<string>>>, "
    "attestation struct<provenance_url:string,manifest_sha256_signed_by:string>, notes string"
)
LOCK = "schema_version int, asset_version string, manifest_url string, manifest_sha256 string, required boolean"
#: Fixed values of the schemas.
ASSET_VERSION = r"^assets-v[0-9]+\.[0-9]+\.[0-9]+$"
URI = "^[A-Za-z][A-Za-z0-9+.-]*:.+$"
MANIFEST_KEYS = ["asset_version", "attestation", "engine_compat", "games", "notes", "presets", "profiles", "schema_version", "shards"]
COMPAT_KEYS = ["max_recharged_version", "min_loader_version", "min_recharged_version", "required_features"]
SHARD_KEYS = ["cluster", "entry_count", "game", "group", "name", "preset", "profile", "release_tag", "requires_features", "sha256", "size", "url"]
LOCK_KEYS = ["asset_version", "manifest_sha256", "manifest_url", "required", "schema_version"]


def some_of(name: str, allowed: tuple[str, ...]) -> Rules:
    """An array of at least one value, all of them allowed."""
    c = F.col(name)
    return {name: ((F.size(c) >= 1) & F.forall(c, lambda x: F.coalesce(x.isin(*allowed), F.lit(False))), F.concat_ws(",", c))}


def no_others(name: str, text: Column, known: list[str]) -> Rules:
    """No keys in a JSON object but the known ones; sound where there is no object."""
    extra = F.coalesce(unknown_keys(text, known), F.array().cast("array<string>"))
    return {name: (F.size(extra) == 0, F.concat_ws(",", extra))}


def lock_rules(text: str = "value") -> Rules:
    """Rules of a lock file, whose JSON is in column ``text`` beside its typed fields."""
    rules = {"schema_version": (F.col("schema_version") == 1, F.col("schema_version"))} | matches("asset_version", ASSET_VERSION) | matches("manifest_url", URI) | matches("manifest_sha256", SHA256)
    return rules | present("required") | no_others("unknown", F.col(text), LOCK_KEYS)


def manifest_rules(text: str = "value") -> Rules:
    """Rules of a manifest's header."""
    compat = F.col("engine_compat")
    rules = {"schema_version": (F.col("schema_version") == 1, F.col("schema_version"))} | matches("asset_version", ASSET_VERSION) | some_of("games", GAMES) | some_of("profiles", PROFILES) | some_of("presets", PRESETS)
    rules |= {
        "engine_compat.min_recharged_version": (compat["min_recharged_version"].isNotNull(), compat["min_recharged_version"]),
        "engine_compat.min_loader_version": (compat["min_loader_version"] >= 1, compat["min_loader_version"]),
        "shards": (F.col("shards").isNotNull(), F.lit(None)),
    }
    return rules | no_others("unknown", F.col(text), MANIFEST_KEYS) | no_others("engine_compat.unknown", F.get_json_object(text, "$.engine_compat"), COMPAT_KEYS)


def item_rules(x: Column) -> Rules:
    """Rules of one shard of a manifest's array."""
    rules = {"name": (x["name"].rlike(SHARD_NAME), x["name"]), "sha256": (x["sha256"].rlike(SHA256), x["sha256"]), "url": (x["url"].rlike(URI), x["url"])}
    rules |= {n: (x[n].isin(*allowed), x[n]) for n, allowed in (("game", GAMES), ("profile", PROFILES), ("preset", PRESETS), ("group", ("albedo", "material")))}
    return rules | {"cluster": (x["cluster"].isNotNull(), x["cluster"]), "size": (x["size"] >= 1, x["size"]), "entry_count": (x["entry_count"] >= 1, x["entry_count"])}


def manifest_items(text: str = "value") -> tuple[Column, ...]:
    """Violations of the shards in a manifest, by their paths."""
    raw = F.from_json(F.get_json_object(text, "$.shards"), "array<string>")
    return each_item(F.col("shards"), "shards", item_rules), each_item(raw, "shards", lambda x: no_others("unknown", x, SHARD_KEYS))


def map_rules(m: Column) -> Rules:
    """Rules of one of a material's maps."""
    rules = {"colorspace": (m["colorspace"].isin(*COLORSPACES), m["colorspace"]), "channels": (m["channels"].isNull() | m["channels"].isin(*CHANNELS), m["channels"])}
    return rules | {"source_sha256": (m["source_sha256"].isNull() | m["source_sha256"].rlike(SHA256), m["source_sha256"])}


def location_rule(game: str, file: str = "file") -> Rules:
    """A material's id says where its file lies: game, folder and name."""
    at = [F.regexp_extract(file, r"([^/]+)/([^/]+)\.json$", i) for i in (1, 2)]
    return {"location": (F.col("id") == F.concat_ws("/", F.lit(game), *at), F.col("id"))}


def unknown_keys(text: Column, known: list[str]) -> Column:
    """Keys of a JSON object that the schema doesn't list."""
    return F.array_except(F.json_object_keys(text), F.array(*map(F.lit, known)))


def sniff_images(blobs: DataFrame, content: str = "content") -> DataFrame:
    """kind, w, h, depth, ctype and flags from the leading bytes: PNG by its magic and header chunk, JPEG by its own, else unknown."""
    head = F.hex(F.substring(content, 1, 8))
    kind = F.when(head == "89504E470D0A1A0A", "png").when(head.startswith("FFD8FF"), "jpeg").otherwise("unknown")

    def number(at: int, n: int) -> Column:
        return F.when(kind == "png", F.conv(F.hex(F.substring(content, at, n)), 16, 10).cast("int"))

    rows = blobs.select("*", kind.alias("kind"), number(17, 4).alias("w"), number(21, 4).alias("h"), number(25, 1).alias("depth"), number(26, 1).alias("ctype"))
    return rows.withColumns({"mislabeled": F.col("kind") != "png", "palette": F.coalesce(F.col("ctype") == 3, F.lit(False)), "deep": F.coalesce(F.col("depth") == 16, F.lit(False))})
