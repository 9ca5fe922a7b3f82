"""Images in tiles against the kernels of whole images."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.operators import rasters, tiles

rng = np.random.default_rng(7)


def image(h, w, c, smooth=False):
    a = rng.integers(0, 256, (h, w, c))
    if smooth:
        y, x = np.mgrid[0:h, 0:w]
        a = (127 + 80 * np.sin(x / 9) + 40 * np.cos(y / 7) + rng.normal(0, 3, (h, w)))[..., None].clip(0, 255)
    return a.astype(np.uint8)


def table(spark, images, size):
    """Tiles made outside Spark's rows, as a source of large images would."""
    rows = []
    for i, a in images.items():
        h, w, c = a.shape
        rows += [(i, 0, y // size, x // size, t.shape[1], t.shape[0], c, w, h, bytearray(t.tobytes())) for y in range(0, h, size) for x in range(0, w, size) for t in [a[y : y + size, x : x + size]]]
    return spark.createDataFrame(rows, tiles.TILE)


def whole(rows, size):
    """(image, level) -> array, from collected tiles."""
    out = {}
    for r in rows:
        t = r.asDict()
        a = out.setdefault((t["image_id"], t["level"]), np.full((t["height"], t["width"], t["c"]), np.nan))
        a[t["y"] * size : t["y"] * size + t["h"], t["x"] * size : t["x"] * size + t["w"]] = tiles.pixels(t)
    return out


def chain_of(a, semantic):
    a = a / 255
    out = [a]
    a = a**2.2 if semantic == "albedo" else a * 2 - 1 if semantic == "normal" else a
    while max(a.shape[:2]) > 1:
        a = rasters.halved(a)
        if semantic == "normal":
            a = a / np.maximum(np.linalg.norm(a, axis=-1, keepdims=True), 1e-9)
        out.append(tiles.shown(a, semantic))
    return out


@pytest.mark.parametrize("semantic", ["data", "albedo", "normal"])
def test_chains_of_tiles_equal_those_of_whole_images(spark, semantic):
    c = 1 if semantic == "data" else 3
    images = {i: image(h, w, c) for i, (h, w) in enumerate([(37, 53), (64, 64), (16, 16), (1, 70), (65, 3), (1, 1), (33, 129)])}
    got = whole(tiles.tile_chain(table(spark, images, 16), semantic, 16).collect(), 16)
    for i, a in images.items():
        want = chain_of(a, semantic)
        assert {level for n, level in got if n == i} == set(range(len(want)))
        for level, x in enumerate(want):
            assert np.allclose(got[i, level] / (255 if level == 0 else 1), x, atol=1e-12)


def test_tiles_of_arrays_equal_tiles_of_bytes(spark):
    a = image(13, 21, 3)
    rows = spark.createDataFrame([(5, 21, 13, 3, [float(x) for x in a.ravel()]), (6, 0, 0, 3, [])], "image_id long, w int, h int, c int, data array<double>")
    assert sorted(map(tuple, tiles.to_tiles(rows, 8).collect())) == sorted(map(tuple, table(spark, {5: a}, 8).collect()))


def test_a_large_image_equals_the_whole_kernel_and_no_row_is_over_a_tile(spark):
    size, n = 512, 4096
    a = image(n, n, 1, smooth=True)
    base = table(spark, {1: a}, size)
    chain = tiles.tile_chain(base, "data", size)
    sizes = chain.groupBy("level").agg(F.max(F.octet_length("data")).alias("most"), F.sum(F.octet_length("data")).alias("all")).collect()
    assert all(r["most"] <= size * size * (1 if r["level"] == 0 else 8) for r in sizes) and len(sizes) == 13
    want = chain_of(a, "data")
    got = whole(chain.filter("level in (1, 3, 4, 12)").collect(), size)
    for level in (1, 3, 4, 12):
        assert np.allclose(got[1, level], want[level], atol=1e-12)
    maps = spark.createDataFrame([(1, "height")], "image_id long, map string")
    for level in (0, 1):
        at = tiles.to_bytes(chain.filter(F.col("level") == level))
        byte = a if level == 0 else np.rint(np.round(want[level] * 255, 9))
        row = tiles.tile_stats(at, maps, size).first()
        spread = rasters.spread_of(byte.astype(float)[..., 0])
        assert (row["height_mean"], row["height_norm"]) == (round(spread["mean"], 6), round(spread["norm"], 6))
        assert row["height_lambda_tiles"] == round(rasters.wavelength(byte.astype(float)[..., 0]), 6)


def test_samples_of_sizes_that_no_tile_divides(spark):
    images = {1: image(130, 3100, 1, smooth=True), 2: image(3080, 5, 1), 3: image(40, 40, 1)}
    got = {r["image_id"]: r["lambda"] for r in tiles.tile_wavelength(table(spark, images, 64), 64).collect()}
    assert got == {i: rasters.wavelength(a[..., 0].astype(float)) for i, a in images.items()}


def test_gradients_add_up(spark):
    images = {1: image(50, 70, 3), 2: image(3, 3, 3)}
    got = {r["image_id"]: (r["dc_x"], r["dc_y"]) for r in tiles.tile_gradients(table(spark, images, 16)).collect()}
    for i, a in images.items():
        assert got[i] == pytest.approx(tuple(rasters.gradient(a.reshape(-1, 3).astype(float)).values()), abs=1e-12)


@pytest.mark.parametrize("rebuild", [True, False])
def test_percentiles_of_tiles_are_exact(spark, rebuild):
    images = {1: image(70, 90, 3), 2: image(1, 1, 3), 3: image(40, 40, 3), 4: image(2, 1, 3)}
    decoded = {i: (a.astype(int) + rng.integers(-9, 10, a.shape)).clip(0, 255).astype(np.uint8) for i, a in images.items()}
    decoded[3] = images[3].copy()  # all angles near or at zero: ties
    dec = table(spark, decoded, 32).select("image_id", "y", "x", F.col("data").alias("dec"))
    got = {r["image_id"]: r for r in tiles.tile_angles(table(spark, images, 32).join(dec, ["image_id", "y", "x"]), rebuild).collect()}
    assert set(got) == set(images)
    for i, a in images.items():
        angle = rasters.angles_between(a.reshape(-1, 3).astype(float), decoded[i].reshape(-1, 3).astype(float), rebuild)
        assert got[i]["ang_p99_deg"] == pytest.approx(np.percentile(angle, 99), abs=1e-12)
        assert got[i]["ang_max_deg"] == angle.max() and got[i]["ang_mean_deg"] == pytest.approx(angle.mean(), abs=1e-12)


def test_tasks_hand_on_bounded_batches_of_many_rows():
    small = [x.num_rows for x in tiles.batches_of("image_id long, n long", ((i, 1) for i in range(10_000)))]
    assert small == [4096, 4096, 1808]
    large = [x.num_rows for x in tiles.batches_of("image_id long, data binary", ((i, bytes(400_000)) for i in range(7)))]
    assert large == [3, 3, 1]
    assert not [*tiles.batches_of("n long", iter(()))]


def test_groups_of_small_images_need_no_call_each(spark):
    images = {i: image(8, 8, 1) for i in range(40)}
    base = table(spark, images, 4)
    for rows in (tiles.next_level(base, "data", 4), tiles.tile_wavelength(base, 4)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapGroupsInArrow" not in plan and plan.count("MapInArrow") == 2
        assert rows.count() == 40 == rows.select("image_id").distinct().count()


def test_angles_of_small_images_are_taken_many_at_a_time(spark, monkeypatch):
    images = {i: image(8, 8, 3) for i in range(300)}
    decoded = {i: (a.astype(int) + rng.integers(-9, 10, a.shape)).clip(0, 255).astype(np.uint8) for i, a in images.items()}
    pairs = table(spark, images, 4).join(table(spark, decoded, 4).select("image_id", "y", "x", F.col("data").alias("dec")), ["image_id", "y", "x"]).coalesce(1)
    seen, slices = [], tiles.per_slice
    monkeypatch.setattr(tiles, "per_slice", lambda rows, schema, kernel: seen.append((rows.columns, kernel)) or slices(rows, schema, kernel))
    got = {r["image_id"]: r for r in tiles.tile_angles(pairs).collect()}
    assert len(got) == 300 and len(seen) == 1 + tiles.PARTS
    for i, a in images.items():
        angle = rasters.angles_between(a.reshape(-1, 3).astype(float), decoded[i].reshape(-1, 3).astype(float))
        assert got[i]["ang_p99_deg"] == pytest.approx(np.percentile(angle, 99), abs=1e-12)
        assert got[i]["ang_max_deg"] == pytest.approx(angle.max(), abs=1e-12) and got[i]["ang_mean_deg"] == pytest.approx(angle.mean(), abs=1e-12)
    columns, kernel = seen[0]
    image_id, *rest = (list(c) for c in zip(*pairs.select(*columns).collect(), strict=True))
    ids, total, most, n = kernel(image_id, *rest)
    assert ids == image_id and len(total) == len(most) == 1200 and set(n) == {16}


def test_empty_tables(spark):
    none = table(spark, {1: image(2, 2, 1)}, 16).limit(0)
    assert tiles.tile_chain(none, "data", 16).count() == 0
    assert tiles.tile_wavelength(none, 16).count() == 0 and tiles.tile_spread(none).count() == 0
    assert tiles.tile_angles(none.withColumn("dec", F.col("data"))).count() == 0
