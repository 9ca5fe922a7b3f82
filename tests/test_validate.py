"""Rules with paths into nested values, on planted violations of every kind."""

import json

from pyspark.sql import functions as F

from shardloom.operators import validate as v

SHARD = {"name": "jak2-pc-bc-low-material-shard-c9-p3-0123456789ab.rpack", "game": "jak2", "profile": "pc-bc", "preset": "low", "group": "material", "cluster": "c9", "sha256": "0f" * 32, "size": 3, "url": "https://h/x", "entry_count": 1, "requires_features": ["pbr"]}
HEADER = {"schema_version": 1, "asset_version": "assets-v2.10.3", "games": ["jak2"], "engine_compat": {"min_recharged_version": "1", "max_recharged_version": None, "min_loader_version": 1}, "profiles": ["pc-bc"], "presets": ["low"]}
LOCK = {"schema_version": 1, "asset_version": "assets-v0.0.1", "manifest_url": "https://h/m", "manifest_sha256": "ab" * 32, "required": False}


def found(spark, documents, schema, rules, nested=()):
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "i int, value string")
    rows = rows.select("i", "value", F.from_json("value", schema).alias("r")).select("i", "value", "r.*")
    return {(r["id"], r["rule"], r["value"]) for r in v.validate_records(rows, "i", rules(), nested() if nested else ()).collect()}


def without(d, key):
    return {k: x for k, x in d.items() if k != key}


def test_lock_files(spark):
    cases = [LOCK, *[without(LOCK, k) for k in LOCK], LOCK | {"more": 1}, LOCK | {"manifest_url": "no uri"}, LOCK | {"manifest_sha256": "AB" * 32}, LOCK | {"asset_version": "assets-v1.2"}, {}]
    got = found(spark, cases, v.LOCK, v.lock_rules)
    want = {(i + 1, k, None) for i, k in enumerate(LOCK)} | {(6, "unknown", "more"), (7, "manifest_url", "no uri"), (8, "manifest_sha256", "AB" * 32), (9, "asset_version", "assets-v1.2")} | {(10, k, None) for k in LOCK}
    assert got == want


def test_manifest_headers_and_shards(spark):
    sound = HEADER | {"shards": [SHARD, without(SHARD, "requires_features")]}
    bad_shards = [SHARD | {"game": "jak4"}, SHARD | {"size": 0}, without(SHARD, "cluster"), SHARD | {"name": "x.rpack", "also": 1}, SHARD | {"sha256": "f"}, SHARD | {"entry_count": 0, "url": "u"}, SHARD | {"preset": "very-low", "profile": "pc", "group": "mask"}]
    cases = [sound, without(sound, "shards"), sound | {"shards": bad_shards}, sound | {"games": []}, sound | {"profiles": ["pc-bc", "ps2"], "presets": None}, sound | {"engine_compat": {"min_loader_version": 0, "zz": 1}}, sound | {"one": 1, "two": 2, "schema_version": 3}, without(sound, "engine_compat"), sound | {"shards": []}]
    got = found(spark, cases, v.MANIFEST, v.manifest_rules, v.manifest_items)
    paths = [("[0].game", "jak4"), ("[1].size", "0"), ("[2].cluster", None), ("[3].name", "x.rpack"), ("[3].unknown", "also"), ("[4].sha256", "f"), ("[5].entry_count", "0"), ("[5].url", "u"), ("[6].preset", "very-low"), ("[6].profile", "pc"), ("[6].group", "mask")]
    want = {(2, f"shards{p}", x) for p, x in paths}
    want |= {(1, "shards", None), (3, "games", ""), (4, "profiles", "pc-bc,ps2"), (4, "presets", ""), (5, "engine_compat.min_loader_version", "0"), (5, "engine_compat.min_recharged_version", None), (5, "engine_compat.unknown", "zz"), (6, "unknown", "one,two"), (6, "schema_version", "3")}
    want |= {(7, f"engine_compat.min_{x}_version", None) for x in ("loader", "recharged")}
    assert got == want


def test_maps_by_their_paths_and_ids_by_their_places(spark):
    maps = "map<string,struct<colorspace:string,channels:string,source_sha256:string>>"
    rows = spark.createDataFrame(
        [("jak1/t/a.b", "file:///m/t/a.b.json", {"albedo": ("linear", "rgb", None), "height": ("x", "r", "zz")}), ("jak1/t/a", "file:///m/u/a.json", {"normal": (None, "q", None)}), ("jak2/t/a", "file:///m/t/a.json", None), (None, "file:///m/t/a.json", {})],
        f"id string, file string, maps {maps}",
    )
    got = {tuple(r) for r in v.validate_records(rows, "id", v.location_rule("jak1"), (v.each_entry(F.col("maps"), "maps", v.map_rules),)).collect()}
    assert got == {("jak1/t/a.b", "maps.height.colorspace", "x"), ("jak1/t/a.b", "maps.height.source_sha256", "zz"), ("jak1/t/a", "location", "jak1/t/a"), ("jak1/t/a", "maps.normal.colorspace", None), ("jak1/t/a", "maps.normal.channels", "q"), ("jak2/t/a", "location", "jak2/t/a"), (None, "location", None)}
