"""Literal cases of the catalog's rules."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.functions import geometry, keys
from shardloom.jobs import catalog as jobs
from shardloom.jobs import shipping
from shardloom.operators import build, dedup, encoders, rasters, release, shards, validate
from shardloom.sources import catalog, config, packs


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_preset_dims_are_the_least_reduction_that_fits(spark):
    pick = random.Random(1)
    cases = [(p, pick.choice([1, 7, 500, 1024, 2048, 3000]), pick.choice([1, 64, 498, 2048]), *pick.choice([(None, None), (pick.randint(1, 4000), pick.randint(1, 4000))])) for p in ("low", "default", "bonkers") for _ in range(60)]
    rows = spark.createDataFrame(cases, "preset string, w int, h int, rw int, rh int")
    for r in build.with_preset_dims(rows).collect():
        most = {"low": 1, "default": 2}.get(r["preset"])
        halvings = 0
        if most and r["rw"]:
            while r["w"] // 2**halvings > most * r["rw"] or r["h"] // 2**halvings > most * r["rh"]:
                halvings += 1
        assert (r["pw"], r["ph"]) == (max(1, r["w"] // 2**halvings), max(1, r["h"] // 2**halvings))


def test_unknown_preset_is_an_error(spark):
    rows = spark.createDataFrame([("ultra", 64, 64, 32, 32)], "preset string, w int, h int, rw int, rh int")
    with pytest.raises(Exception, match="unknown preset"):
        build.with_preset_dims(rows).collect()


def test_a_prefix_ends_at_the_first_mark_of_the_stronger_kind(spark):
    pick = random.Random(2)
    made = ["".join(pick.choices(["-vis-", "-tpage-", "a", "b1", "-", "_"], k=pick.randint(0, 6))) for _ in range(200)]
    rows = spark.createDataFrame([(x,) for x in made], "tpage string").withColumn("prefix", keys.level_prefix(F.col("tpage")))
    for r in rows.collect():
        mark = next((m for m in ("-vis-", "-tpage-") if m in r["tpage"]), None)
        assert r["prefix"] == (r["tpage"].partition(mark)[0] if mark else r["tpage"])


def test_part_is_the_hash_modulo_n_and_moves_no_other(spark):
    rows = spark.range(172).select(F.concat(F.lit("a/m"), F.col("id").cast("string")).alias("mat"))
    got = {r["mat"]: r["p"] for r in rows.select("mat", keys.part_of(F.col("mat"), 4).alias("p")).collect()}
    assert got == {m: int(hashlib.sha256(m.encode()).hexdigest(), 16) % 4 for m in got}
    counts = np.bincount(list(got.values()), minlength=4)
    assert counts.min() > 0 and counts.max() < 2 * counts.mean()


def test_shard_names(spark):
    lit = F.lit
    name = keys.shard_name(lit("jak1"), lit("pc-bc"), lit("bonkers"), lit("material"), lit("c1"), lit(4), lit(2), lit("a" * 64))
    assert one(spark, name) == "jak1-pc-bc-bonkers-material-shard-c1-p2-aaaaaaaaaaaa.rpack"


def test_levels_are_the_halvings_down_to_one_pixel(spark):
    pick = random.Random(3)
    rows = spark.createDataFrame([(pick.randint(1, 5000), pick.choice([1, 2, 3, pick.randint(1, 5000)])) for _ in range(200)], "w int, h int")
    for r in rows.withColumn("n", geometry.level_count(F.col("w"), F.col("h"))).collect():
        n, side = 1, max(r["w"], r["h"])
        while side > 1:
            n, side = n + 1, side // 2
        assert r["n"] == n


def test_affected_materials(spark):
    paths = spark.createDataFrame([("raw/jak1/a/b/albedo.png",), ("metadata/jak1/materials/c/d.json",), ("raw/jak1/x",), ("docs/y",)], "path string")
    sample = spark.createDataFrame([("s/t",)], "material string")
    assert {tuple(r) for r in build.affected_materials(paths, sample).collect()} == {("a/b", False), ("c/d", False)}
    more = paths.union(spark.createDataFrame([("tools/z.py",)], "path string"))
    assert {tuple(r) for r in build.affected_materials(more, sample).collect()} == {("a/b", True), ("c/d", True), ("s/t", True)}


def images(spark, *arrays):
    rows = [(i, a.shape[1], a.shape[0], 1 if a.ndim == 2 else a.shape[2], [float(x) for x in a.ravel()]) for i, a in enumerate(arrays)]
    return spark.createDataFrame(rows, "image_id long, w int, h int, c int, data array<double>")


def test_mip_chains(spark):
    checker = np.indices((2, 2)).sum(axis=0) % 2
    albedo = rasters.mip_chain(images(spark, np.repeat(checker[..., None], 3, 2).astype(float)), "albedo").filter("level = 1").first()
    assert albedo["data"] == pytest.approx([0.5 ** (1 / 2.2)] * 3)
    a = np.random.default_rng(1).random((64, 64))
    chain = {r["level"]: r["data"] for r in rasters.mip_chain(images(spark, a), "data").collect()}
    assert len(chain) == 7 and all(np.mean(v) == pytest.approx(a.mean()) for v in chain.values())
    n = np.random.default_rng(42).random((16, 16, 3))
    for r in rasters.mip_chain(images(spark, n), "normal").filter("level > 0").collect():
        assert np.linalg.norm(np.array(r["data"]).reshape(-1, 3) * 2 - 1, axis=1) == pytest.approx(1)
    odd = rasters.mip_chain(images(spark, np.arange(15.0).reshape(3, 5)), "data").collect()
    assert [(r["w"], r["h"]) for r in sorted(odd, key=lambda r: r["level"])] == [(5, 3), (2, 1), (1, 1)]


def test_height_statistics(spark):
    r = np.random.default_rng(4)
    frames = [np.full((8, 8), 102.0), *[r.integers(0, r.integers(2, 256), r.integers(1, 12, 2)).astype(float) for _ in range(30)]]
    got = {row["image_id"]: row for row in rasters.height_stats(images(spark, *frames)).collect()}
    for i, a in enumerate(frames):
        values, n = sorted(a.ravel()), a.size
        low, high = (0 if int(n * q) == 0 else values[int(n * q) - 1] for q in (0.02, 0.98))
        half = max(high / 255 - a.mean() / 255, a.mean() / 255 - low / 255, 2 / 255)
        assert got[i]["mean"] == pytest.approx(a.mean() / 255) and got[i]["norm"] == pytest.approx(min(max(0.5 / half, 0.5), 16))
    assert tuple(rasters.height_stats(images(spark, np.zeros((0, 0)))).first()) == (0, 0.5, 1.0)


def test_metrics_of_pairs_match_plain_loops(spark):
    r = np.random.default_rng(5)
    ref, dec = r.integers(0, 256, (9, 3)).astype(float), r.integers(0, 256, (9, 3)).astype(float)
    rows = spark.createDataFrame([(1, 3, ref.ravel().tolist(), dec.ravel().tolist()), (2, 3, ref.ravel().tolist(), ref.ravel().tolist()), (3, 3, [], [])], "image_id long, c int, ref array<double>, dec array<double>")
    color = {x["image_id"]: x for x in rasters.color_metrics(rows).collect()}
    mse = sum((a - b) ** 2 for a, b in zip(ref.ravel(), dec.ravel(), strict=True)) / 27
    assert color[1]["mse"] == pytest.approx(mse) and color[1]["psnr_db"] == pytest.approx(10 * math.log10(255**2 / mse))
    assert color[2]["psnr_db"] == math.inf and color[3]["mse"] is None
    assert rasters.gray_metrics(rows).filter("image_id = 2").first()["psnr_db"] == pytest.approx(10 * math.log10(255**2 / 1e-9))
    angles = []
    for a, b in zip(ref, dec, strict=True):
        u, v = [x / 127.5 - 1 for x in a], [x / 127.5 - 1 for x in b]
        v[2] = math.sqrt(min(max(1 - v[0] ** 2 - v[1] ** 2, 0), 1))
        dot = sum(x * y for x, y in zip(u, v, strict=True)) / math.hypot(*u) / math.hypot(*v)
        angles.append(math.degrees(math.acos(min(max(dot, -1), 1))))
    got = rasters.normal_metrics(rows).filter("image_id = 1").first()
    assert (got["ang_mean_deg"], got["ang_max_deg"]) == (pytest.approx(np.mean(angles)), pytest.approx(max(angles)))


def test_wavelength_halves_with_the_frequency():
    x = np.arange(256) / 256 * 2 * math.pi
    wave = [np.tile(127 + 120 * np.sin(k * x), (256, 1)) for k in (32, 8, 2)]
    got = [rasters.wavelength(w) for w in wave]
    assert rasters.wavelength(np.full((64, 64), 77.0)) == 0.25 and rasters.wavelength(np.zeros((0, 0))) == 0.25
    assert got[1] / got[0] == pytest.approx(4, rel=0.1) and got[2] / got[1] == pytest.approx(4, rel=0.1)
    series = rasters.variances(wave[0][..., None] / 255, 12)
    k = next(i for i, v in enumerate(series) if v <= series[0] / 2)
    part = math.log(series[k - 1] / (series[0] / 2)) / math.log(series[k - 1] / series[k])
    assert got[0] == pytest.approx(2 ** (k - 1 + part + 1) / 256)
    assert rasters.wavelength(np.arange(4096.0).reshape(1, 4096) % 256) <= 1


def test_better_encoders_rank_first(spark):
    rows = [("albedo", "f", "a", 40.0, None, 2.0, None), ("albedo", "f", "b", 44.0, None, 9.0, None), ("normal", "f", "a", None, 2.0, 1.0, None), ("normal", "f", "b", None, 1.0, 1.0, None), ("normal", "f", "c", None, None, None, "x")]
    results = spark.createDataFrame([(*r[:4], None, r[4], None, None, None, *r[5:]) for r in rows], "semantic string, format string, encoder string, psnr_db double, mae double, ang_mean_deg double, ang_p99_deg double, max_err double, ang_max_deg double, encode_s double, error string")
    formats = spark.createDataFrame([("f", 16, 4, 4)], "format string, block_bytes int, bw int, bh int")
    got = {(r["semantic"], r["encoder"]): (r["rank"], r["ratio_to_best"]) for r in encoders.encoder_winner(encoders.encoder_summary(results), formats).collect()}
    assert got == {("albedo", "b"): (1, 1.0), ("albedo", "a"): (2, 1.1), ("normal", "b"): (1, 1.0), ("normal", "a"): (2, 2.0), ("normal", "c"): (3, None)}


FAMILY = {"game": "g", "profile": "p"}


def test_pack_bytes_do_not_depend_on_order_and_round_trip(spark):
    entries = [("b/x", "albedo", b"z" * 9), ("a/y", "height", b"w" * 1600)]
    content = packs.pack_bytes(FAMILY, entries)
    assert content == packs.pack_bytes(FAMILY, entries[::-1])
    frame = spark.createDataFrame([("one", bytearray(content))], "name string, content binary")
    got = packs.scan_packs(frame).orderBy("key").collect()
    assert [(r["key"], r["offset"], r["size"]) for r in got] == [("a/y", 16, 1600), ("b/x", 1616, 9)]
    assert packs.verify_packs(frame).count() == 0


@pytest.mark.parametrize(("at", "reason"), [(0, "bad header magic"), (20, "altered"), (-40, "index hash differs"), (-1, "bad trailer magic")])
def test_a_changed_byte_is_found(spark, at, reason):
    content = bytearray(packs.pack_bytes(FAMILY, [("a", "albedo", b"q" * 40)]))
    content[at] ^= 1
    frame = spark.createDataFrame([("one", content)], "name string, content binary")
    assert [r["reason"] for r in packs.verify_packs(frame).collect()] == [reason]


def test_a_hot_family_is_cut_into_bounded_packs(spark):
    entries = [("hot", f"k{i:03}", m, bytes([i]) * (200 + i)) for i in range(40) for m in ("albedo", "height")] + [("cold", "k", "albedo", b"x")]
    rows = spark.createDataFrame([(*e[:3], bytearray(e[3])) for e in entries], "fam string, key string, map string, payload binary")
    built = packs.build_packs(rows, ["fam"], 4000).cache()
    largest = max(2 * (len(e[3]) + 16 + 6 * 4 + packs.RECORD) for e in entries)
    assert built.count() > 5 and built.agg(F.max("size")).first()[0] <= 4000 + largest + 200
    scanned = packs.scan_packs(built).join(built.select("fam", F.col("name").alias("pack"), "base"), "pack")
    got = {(r["fam"], r["key"], r["map"]): r["base"] + r["offset"] - 16 for r in scanned.collect()}
    laid = shards.pack_layout(rows.withColumn("size", F.octet_length("payload")), ["fam"], ["key", "map"])
    assert got == {(r["fam"], r["key"], r["map"]): r["offset"] for r in laid.collect()} and scanned.count() == len(entries)
    assert scanned.groupBy("fam", "key").agg(F.count_distinct("pack").alias("n")).filter("n > 1").count() == 0
    assert packs.verify_packs(built).count() == 0


def test_bad_packs_are_refused():
    for entries in ([], [("a", "nothing", b"x")], [("a", "albedo", b"")]):
        with pytest.raises(ValueError):
            packs.pack_bytes(FAMILY, entries)


def test_first_match_takes_the_first_accepted(spark):
    entities = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["z"])], "id int, candidates array<string>")
    lookup = spark.createDataFrame([("a", "bad"), ("b", "both"), ("c", "none")], "candidate string, value string")
    assert {r["id"]: r["value"] for r in dedup.first_match(entities, lookup, ["both", "none"]).collect()} == {1: "both", 2: None}


def test_variants_and_canonical_materials(spark):
    entries = spark.createDataFrame([("t/a.png", "t/a", False), ("u/a.png", "t/a", True), ("v/a.png", "t/a", False)], "placement string, canonical_id string, recale boolean")
    hashes = spark.createDataFrame([("t/a.png", "h1"), ("u/a.png", "h2"), ("v/a.png", "h1")], "placement string, set_sha256 string")
    got = {r["material"]: (r["is_variant"], r["recale"], r["placements"]) for r in dedup.dedup_materials(entries, hashes).collect()}
    assert got == {"t/a": (False, False, ["t/a.png", "v/a.png"]), "u/a": (True, True, ["u/a.png"])}


def test_versions_order_by_number(spark):
    tags = [("f", "v0.9.0", "a"), ("f", "v0.10.0", "b"), ("g", "assets-v0.9.0", "c"), ("g", "assets-v0.10.0", "d"), ("g", "nightly", "e"), ("h", None, "x"), ("h", "v1.2", "w")]
    rows = spark.createDataFrame(tags, "fam string, release_tag string, name string")
    assert {r["fam"]: r["name"] for r in release.manifest_snapshot(rows, ["fam"]).collect()} == {"f": "b", "g": "d", "h": "w"}


def test_a_snapshot_has_all_rows_of_the_latest_release(spark):
    history = [("f", "v0.9.0", "a"), ("f", "v0.10.0", "b"), ("f", "v0.10.0", "c"), ("g", "x", "d"), ("g", "y", "e"), (None, "v1.0.0", "h"), (None, "v2.0.0", "i")]
    rows = spark.createDataFrame(history, "fam string, release_tag string, name string")
    assert sorted(r["name"] for r in release.manifest_snapshot(rows, ["fam"]).collect()) == ["b", "c", "e", "h", "i"]


def test_pages_that_share_a_url_are_in_the_snapshot(spark, tmp_path):
    urls = ["http://h/en/1", "http://h/en/2", "http://h/en/3", "http://h/en/1", None, None, "http://h/en/7", "http://h/en/8", "http://h/en/9", "http://h/en/1", "http://h/en/11", None]
    spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"create view pages as from '{tmp_path}/pages.parquet/*.parquet'")
    got = [tuple(r) for r in shipping.e4_manifest_snapshot(spark, str(tmp_path)).collect()]
    want = con.sql(shipping.ORACLES["e4_manifest_snapshot"]).fetchall()
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[0] == urls[0] for r in got) == 3


def test_the_report_is_made_of_one_table_of_outputs(spark, monkeypatch):
    made, write = [], jobs.build.write_report
    monkeypatch.setattr(jobs.build, "write_report", lambda failures, shards, counters, path: made.extend((failures, counters)) or write(failures, shards, counters, path))
    assert jobs.a8_written_report(spark, "/root/testdata/sf0.001").count() > 0
    for part in made:
        assert part.inputFiles() and all("/outputs-" in f for f in part.inputFiles())


def test_failures_stop_a_release(spark):
    rows, bad = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(9,)], "y int")
    assert release.refuse_failures(rows, bad.limit(0)).count() == 1
    with pytest.raises(Exception, match="failed outputs"):
        release.refuse_failures(rows, bad).collect()


def test_png_header(spark):
    head = bytes.fromhex("89504E470D0A1A0A0000000D49484452") + (512).to_bytes(4, "big") + (498).to_bytes(4, "big") + bytes([8, 3])
    rows = spark.createDataFrame([(bytearray(head),), (bytearray(b"\xff\xd8\xff\xe0"),), (bytearray(),)], "content binary")
    got = validate.sniff_images(rows).collect()
    assert (got[0]["w"], got[0]["h"], got[0]["palette"]) == (512, 498, True)
    assert [r["kind"] for r in got] == ["png", "jpeg", "unknown"] and got[1]["mislabeled"]


def test_config_tables(spark):
    assert config.profile_dim(spark).count() == 12 and config.format_dim(spark).count() == 9 and config.split_dim(spark).count() == 6


def test_readers(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"placements": {"a/b.png": "a/b", "c/d.png": "a/b"}}')
    assert {tuple(r) for r in catalog.read_placements(spark, f"file://{tmp_path}/p.json").collect()} == {("a/b.png", "a/b"), ("c/d.png", "a/b")}
    (tmp_path / "s.json").write_text('{"entrees": {"a/b.png": {"id": "a/b", "recale": true}, "c/d.png": {"id": "a/b"}}}')
    assert {tuple(r) for r in catalog.read_source_manifest(spark, f"file://{tmp_path}/s.json").collect()} == {("a/b.png", "a/b", True), ("c/d.png", "a/b", False)}
    (tmp_path / "m" / "t").mkdir(parents=True)
    (tmp_path / "m" / "t" / "x.json").write_text('{"schema_version": 1, "id": "t/x", "maps": {"albedo": {"colorspace": "srgb", "channels": "rgb"}}}')
    got = catalog.read_materials(spark, f"file://{tmp_path}/m").first()
    assert got["id"] == "t/x" and got["maps"]["albedo"]["channels"] == "rgb"
    (tmp_path / "raw" / "t" / "x").mkdir(parents=True)
    oid = "a" * 64
    (tmp_path / "raw" / "t" / "x" / "albedo.png").write_text(f"version v1\noid sha256:{oid}\nsize 77\n")
    assert tuple(catalog.scan_lfs_pointers(spark, f"file://{tmp_path}/raw").first()) == ("t/x", "albedo", oid, 77)
    blob = catalog.scan_blobs(spark, f"file://{tmp_path}/raw").first()
    assert (blob["tpage"], blob["name"], blob["map_kind"]) == ("t", "x", "albedo") and len(blob["sha256"]) == 64
    (tmp_path / "c.json").write_text('{"games": {"g": {"clusters": {"c1": ["a", "b"]}, "overflow": "o"}}, "splits": {"comment": "x", "low": {"albedo": 2}}}')
    assert config.cluster_dim(spark, f"file://{tmp_path}/c.json").count() == 2
    assert tuple(config.split_file(spark, f"file://{tmp_path}/c.json").first()) == ("low", "albedo", 2)


def test_layout_is_aligned(spark):
    rows = spark.createDataFrame([("f", "b", 9), ("f", "a", 1600), ("f", "c", 1)], "fam string, key string, size long")
    got = shards.pack_layout(rows, ["fam"], ["key"])
    assert [r["offset"] for r in got.orderBy("key").collect()] == [16, 1616, 1632]
    assert tuple(shards.pack_index(got, ["fam"]).first()) == ("f", 1633, 3)


def test_sums_before_match_a_plain_loop_in_a_hot_family(spark):
    pick = random.Random(3)
    rows = [(pick.choice(["hot", "hot", "hot", "a", None]), pick.choice([None, f"k{i:04}"]) if i % 50 == 0 else f"k{i:04}", pick.choice([None, 0, 7, i])) for i in range(600)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, fam string, key string, size long")
    sums, want = {}, {}
    for i, (fam, _, size) in sorted(enumerate(rows), key=lambda x: (x[1][1] or "", x[0])):
        want[i] = sums.get(fam, 0)
        sums[fam] = want[i] + (size or 0)
    for range_rows in (1_000_000, 100, 25):  # no family in ranges, the hot one, all of them
        summed = shards.sums_before(frame, ["fam"], ["key", "i"], {"before": F.col("size")}, range_rows)
        assert summed.columns == frame.columns + ["before"]
        assert {r["i"]: r["before"] for r in summed.collect()} == want
    bounds = {r["fam"]: len(r["_bounds"]) for r in shards.family_ranges(frame, ["fam"], ["key", "i"], 25).collect()}
    assert bounds["hot"] >= 6 and shards.family_ranges(frame, ["fam"], ["key", "i"], 1000) is None
    assert shards.pack_layout(frame.limit(0), ["fam"], ["key"]).count() == 0


def test_lock_digest_hashes_sorted_oids(spark):
    rows = spark.createDataFrame([(x,) for x in ("b", None, "a", "b")], "oid string")
    assert tuple(catalog.lock_digest(rows).first()) == (hashlib.sha256(b"a\nb\nb").hexdigest(), 4)
    assert tuple(catalog.lock_digest(rows.limit(0)).first()) == (hashlib.sha256(b"").hexdigest(), 0)


def test_rows_of_one_content_map_to_one_material(spark):
    entries = spark.createDataFrame([(f"{'tu'[i % 2]}/{i:03}.png", "t/000", i == 5) for i in range(200)], "placement string, canonical_id string, recale boolean")
    hashes = entries.select("placement", F.lit("h").alias("set_sha256"))
    one = dedup.distinct_materials(entries, hashes).first()
    assert (one["material"], one["n"], one["levels"], one["recale"], one["is_variant"]) == ("t/000", 200, ["t", "u"], True, False)
    assert [tuple(r) for r in dedup.placement_map(entries, hashes).groupBy("material").count().collect()] == [("t/000", 200)]
