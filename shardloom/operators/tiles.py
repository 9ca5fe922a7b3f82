"""Large images as tables of tiles: chains of levels, statistics and metrics without a whole image in any row.

A tile is a row (image_id, level, y, x, w, h, c, width, height, data): its place in tiles, its own and its level's dimensions in pixels, and its pixels as bytes,
row-major with channels innermost. Tiles are ``size`` pixels a side, a power of two, but for those at the right and lower edges. Level 0
holds bytes of 0 to 255; further levels hold what is carried from one to the next, in doubles: linear light, vectors, plain values.

A level's tiles are halved where they lie, and four neighbours make one tile of the next: a quarter of the pixels is shuffled, by the tile's place, so that no image
is a hot key. Once a level fits into one tile the rest of its chain is that row's. Statistics are sums, histograms and samples of tiles, which add up; a percentile
is found exactly by histograms of ever finer bits of its values.

Edge cases: an image without tiles has no rows; odd dimensions drop their last row or column, and a dimension of 1 stays, as for whole images;
repeated image ids are not told apart, so ids are unique.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch
from . import rasters

TILE = "image_id long, level int, y int, x int, w int, h int, c int, width int, height int, data binary"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "string": pa.string()}
NAMES = [x.split()[0] for x in TILE.split(", ")]


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(columns, kinds, strict=True)], names=names)


#: What a task gathers before it hands a batch on: this many rows, or bytes of them.
ROWS, BYTES = 4096, 1 << 20


def batches_of(schema: str, rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """``rows`` in batches of at most ``ROWS``, and of less than ``BYTES`` but for their last row."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 8 * len(row) + sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) >= ROWS or size >= BYTES:
            yield _batch(schema, held)
            held, size = [], 0
    if held:
        yield _batch(schema, held)


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of some ``ROWS`` or ``BYTES``."""
    for batch in batches:
        n = max(1, min(ROWS, BYTES * batch.num_rows // max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, n):
            yield batch.slice(start, n)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of batches, of which a few are Python objects at a time."""
    for piece in _slices(batches):
        yield from zip(*(c.to_pylist() for c in piece.columns), strict=True)


def per_slice(tiles: DataFrame, schema: str, kernel) -> DataFrame:
    """The arrays that ``kernel`` gives for the columns of some tiles at a time, which it takes as lists."""
    kinds = [x.split() for x in schema.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _slices(batches):
            got = kernel(*(c.to_pylist() for c in piece.columns))
            yield pa.RecordBatch.from_arrays([pa.array(a, _ARROW[k]) for a, (_, k) in zip(got, kinds, strict=True)], names=[n for n, _ in kinds])

    return tiles.mapInArrow(scan, schema)


def per_tile(tiles: DataFrame, schema: str, kernel, *more: str) -> DataFrame:
    """Rows that ``kernel`` yields for each tile, a dictionary of its columns."""
    names = [*NAMES, *more]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(schema, (row for values in _rows(batches) for row in kernel(dict(zip(names, values, strict=True)))))

    return tiles.select(*names).mapInArrow(scan, schema)


def per_group(rows: DataFrame, key: list[str], schema: str, kernel) -> DataFrame:
    """Rows that ``kernel`` yields for the rows of each ``key``, a list of dictionaries. A task takes its groups from a sorted stream and holds one of them."""
    names = rows.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (dict(zip(names, values, strict=True)) for values in _rows(batches))
        groups = groupby(stream, key=lambda r: [r[k] for k in key])
        return batches_of(schema, (row for _, group in groups for row in kernel(list(group))))

    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(scan, schema)


def to_tiles(images: DataFrame, size: int) -> DataFrame:
    """Tiles of whole images of bytes (image_id, w, h, c, data as an array)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(TILE, (row for image in _rows(batches) for row in tiles_of(*image)))

    def tiles_of(image: int, w: int, h: int, c: int, data: list | None) -> Iterator[tuple]:
        a = np.asarray(data or [], np.uint8).reshape(h, w, c)
        for y in range(0, h, size):
            for x in range(0, w, size):
                t = a[y : y + size, x : x + size]
                yield image, 0, y // size, x // size, t.shape[1], t.shape[0], c, w, h, t.tobytes()

    whole = [F.col(n).cast("int").alias(n) for n in ("w", "h", "c")]
    return images.select("image_id", *whole, F.transform("data", lambda v: v.cast("int")).alias("data")).mapInArrow(cut, TILE)


def pixels(tile: dict) -> np.ndarray:
    """(h, w, c) of a tile as doubles: bytes of level 0 as they are, carried values else."""
    return np.frombuffer(tile["data"], np.uint8 if tile["level"] == 0 else float).astype(float).reshape(tile["h"], tile["w"], tile["c"])


def carried(tile: dict, semantic: str) -> np.ndarray:
    """What the chain carries of a tile: linear light, vectors or plain values."""
    a = pixels(tile)
    if tile["level"]:
        return a
    a = a / 255
    return a**rasters.GAMMA if semantic == "albedo" else a * 2 - 1 if semantic == "normal" else a


def shown(a: np.ndarray, semantic: str) -> np.ndarray:
    """Carried values in [0, 1]."""
    return a ** (1 / rasters.GAMMA) if semantic == "albedo" else (a + 1) / 2 if semantic == "normal" else a


def halved_tile(a: np.ndarray, width: int, height: int, semantic: str) -> np.ndarray:
    """2 x 2 means of a tile of an image of these dimensions; it may come out empty where the image's last column or row is dropped."""
    for axis, whole in ((0, height), (1, width)):
        if whole > 1:
            n = a.shape[axis] // 2 * 2
            even, odd = (np.take(a, np.arange(i, n, 2), axis) for i in (0, 1))
            a = (even + odd) / 2
    return rasters._unit(a) if semantic == "normal" and a.size else a


def next_level(tiles: DataFrame, semantic: str, size: int) -> DataFrame:
    """Tiles of the next level of those images that are larger than a tile."""

    def halve(t: dict) -> Iterator[tuple]:
        a = halved_tile(carried(t, semantic), t["width"], t["height"], semantic)
        if a.size:
            yield t["image_id"], t["level"] + 1, t["y"], t["x"], a.shape[1], a.shape[0], t["c"], max(1, t["width"] // 2), max(1, t["height"] // 2), a.tobytes()

    parts = per_tile(tiles.filter(F.greatest("width", "height") > size), TILE, halve)
    half = size // 2

    def assemble(rows: list[dict]) -> Iterator[tuple]:
        t = rows[0]
        y, x = t["_y"], t["_x"]
        w, h = min(size, t["width"] - x * size), min(size, t["height"] - y * size)
        a = np.zeros((h, w, t["c"]))
        for r in rows:
            top, left = r["y"] % 2 * half, r["x"] % 2 * half
            a[top : top + r["h"], left : left + r["w"]] = pixels(r)
        yield t["image_id"], t["level"], y, x, w, h, t["c"], t["width"], t["height"], a.tobytes()

    place = {f"_{n}": F.floor(F.col(n) / 2).cast("int") for n in "yx"}
    return per_group(parts.withColumns(place), ["image_id", *place], TILE, assemble)  # at most four parts of a quarter tile


def tile_chain(tiles: DataFrame, semantic: str, size: int) -> DataFrame:
    """Tiles of all levels, those above 0 in values of [0, 1]; levels are tables in the shared folder, as each comes from the one before."""
    spark = tiles.sparkSession
    most = tiles.agg(F.max(F.greatest("width", "height"))).first()[0] or 0
    levels = [tiles.select(NAMES)]
    while most > size:
        path = scratch(spark, "tile-level")
        next_level(levels[-1], semantic, size).write.parquet(path)
        levels.append(spark.read.parquet(path))
        most //= 2

    def rest(t: dict) -> Iterator[tuple]:
        a, w, h = carried(t, semantic), t["width"], t["height"]
        level = t["level"]
        if level:
            yield *(t[n] for n in NAMES[:-1]), shown(a, semantic).tobytes()
        while max(w, h) > 1 and max(t["width"], t["height"]) <= size:
            a = halved_tile(a, w, h, semantic)
            w, h, level = max(1, w // 2), max(1, h // 2), level + 1
            yield t["image_id"], level, 0, 0, w, h, t["c"], w, h, shown(a, semantic).tobytes()

    out = levels[0]
    for level in levels:  # a level's own tiles; of images that fit into one, also the rest of the chain
        out = out.unionByName(per_tile(level, TILE, rest))
    return out


def tile_values(tiles: DataFrame) -> DataFrame:
    """image_id, level, y, x, row, column, ch, v: a row for each value, for small images."""

    def each(t: dict) -> Iterator[tuple]:
        yield from ((t["image_id"], t["level"], t["y"], t["x"], *at, float(v)) for at, v in np.ndenumerate(pixels(t)))

    return per_tile(tiles, "image_id long, level int, y int, x int, row int, column int, ch int, v double", each)


def to_bytes(tiles: DataFrame) -> DataFrame:
    """Tiles of levels above 0 in bytes, as if of level 0; halves go to even, and what is within 1e-9 of a half is one."""

    def quantize(t: dict) -> Iterator[tuple]:
        a = pixels(t)
        yield t["image_id"], 0, *(t[n] for n in NAMES[2:-1]), (a if t["level"] == 0 else np.clip(np.rint(np.round(a * 255, 9)), 0, 255)).astype(np.uint8).tobytes()

    return per_tile(tiles, TILE, quantize)


def tile_gradients(tiles: DataFrame) -> DataFrame:
    """image_id, dc_x, dc_y: ``normal_dc`` from sums of tiles of bytes."""

    def sums(t: dict) -> Iterator[tuple]:
        a = pixels(t).reshape(-1, t["c"])
        got = rasters.gradient(a)
        yield t["image_id"], got["dc_x"] * len(a), got["dc_y"] * len(a), len(a)

    rows = per_tile(tiles, "image_id long, sx double, sy double, n long", sums).groupBy("image_id").agg(*[F.sum(c).alias(c) for c in ("sx", "sy", "n")])
    return rows.select("image_id", (F.col("sx") / F.col("n")).alias("dc_x"), (F.col("sy") / F.col("n")).alias("dc_y"))


def tile_histogram(tiles: DataFrame) -> DataFrame:
    """image_id, bin, n of tiles of bytes, first channel."""

    def count(t: dict) -> Iterator[tuple]:
        n = np.bincount(pixels(t)[..., 0].astype(int).ravel(), minlength=256)
        yield from ((t["image_id"], int(b), int(n[b])) for b in np.flatnonzero(n))

    return per_tile(tiles, "image_id long, bin int, n long", count).groupBy("image_id", "bin").agg(F.sum("n").alias("n"))


def tile_spread(tiles: DataFrame) -> DataFrame:
    """image_id, mean, norm: ``height_stats`` from added histograms."""
    bins = tile_histogram(tiles)
    mean = bins.groupBy("image_id").agg((F.sum(F.col("bin") * F.col("n")) / F.sum("n") / 255).alias("mean"))
    rows = rasters.cumulative_histogram(bins, [0.02, 0.98]).join(mean, "image_id")
    half = F.greatest(F.col("p98") / 255 - F.col("mean"), F.col("mean") - F.col("p2") / 255, F.lit(2 / 255))
    return rows.select("image_id", "mean", F.least(F.greatest(0.5 / half, F.lit(0.5)), F.lit(16.0)).alias("norm"))


def tile_wavelength(tiles: DataFrame, size: int) -> DataFrame:
    """image_id, lambda: ``height_wavelength`` of tiles of bytes.

    Each tile gives the pixels that the image's sample has of it; a sample has less than 2048 pixels a side, whatever the image.
    """
    sample = "image_id long, top int, left int, w int, h int, width int, height int, data binary"

    def take(t: dict) -> Iterator[tuple]:
        step = max(1, max(t["width"], t["height"]) // 1024)
        rows, columns = (np.arange(-(at * size) % step, n, step) for at, n in ((t["y"], t["h"]), (t["x"], t["w"])))
        if len(rows) and len(columns):
            part = np.frombuffer(t["data"], np.uint8).reshape(t["h"], t["w"], t["c"])[np.ix_(rows, columns)][..., 0]
            top, left = (t["y"] * size + int(rows[0])) // step, (t["x"] * size + int(columns[0])) // step
            yield t["image_id"], top, left, len(columns), len(rows), -(-t["width"] // step), -(-t["height"] // step), part.tobytes()

    def measure(rows: list[dict]) -> Iterator[tuple]:
        a = np.zeros((rows[0]["height"], rows[0]["width"]), np.uint8)
        for r in rows:
            a[r["top"] : r["top"] + r["h"], r["left"] : r["left"] + r["w"]] = np.frombuffer(r["data"], np.uint8).reshape(r["h"], r["w"])
        yield rows[0]["image_id"], rasters.wavelength(a.astype(float))

    return per_group(per_tile(tiles, sample, take), ["image_id"], "image_id long, lambda double", measure)


def tile_stats(tiles: DataFrame, maps: DataFrame, size: int) -> DataFrame:
    """image_id, map and the fields of ``rasters.build_stats`` of tiles of bytes; ``maps`` has each image's map."""
    of = tiles.join(maps.select("image_id", "map"), "image_id")
    slopes = tile_gradients(of.filter("map = 'normal'")).select("image_id", F.col("dc_x").alias("normal_dc_x"), F.col("dc_y").alias("normal_dc_y"))
    heights = of.filter("map = 'height'")
    spread = tile_spread(heights).join(tile_wavelength(heights, size), "image_id").select("image_id", F.col("mean").alias("height_mean"), F.col("norm").alias("height_norm"), F.col("lambda").alias("height_lambda_tiles"))
    rows = maps.select("image_id", "map").join(slopes, "image_id", "left").join(spread, "image_id", "left")
    return rows.select("image_id", "map", *[F.round(F.nanvl(f, F.lit(None).cast("double")), 6).alias(f) for f in ("normal_dc_x", "normal_dc_y", "height_mean", "height_norm", "height_lambda_tiles")])


PARTS = 4  # of 16 bits each, of a double's 64


def tile_angles(pairs: DataFrame, rebuild_z: bool = True) -> DataFrame:
    """image_id, ang_mean_deg, ang_p99_deg, ang_max_deg of tiles of bytes with a further column ``dec``: ``rasters.normal_metrics`` without a whole image.

    Non-negative doubles are ordered as their bits are. The percentile lies between two ranks; for each, a histogram of the upper 16 bits finds the bin that holds it,
    one of the next 16 bits within that bin the finer bin, and so on: four passes over the tiles, each with at most 65,536 bins an image and rank.
    """
    spark = pairs.sparkSession

    def angles(c: list[int], data: list[bytes], dec: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The angles of all pixels of some tiles, and the place of each one's tile among them."""
        values, owners = [np.zeros(0)], [np.zeros(0, int)]
        for channels in sorted(set(c)):
            rows = [i for i, n in enumerate(c) if n == channels]
            ref, got = (np.frombuffer(b"".join(x[i] for i in rows), np.uint8).astype(float).reshape(-1, channels) for x in (data, dec))
            values.append(rasters.angles_between(ref, got, rebuild_z))
            owners.append(np.repeat(rows, [len(data[i]) // channels for i in rows]))
        return np.concatenate(values), np.concatenate(owners)

    def sums(image: list[int], *tile: list) -> tuple:
        a, of = angles(*tile)
        most = np.full(len(image), -np.inf)
        np.maximum.at(most, of, a)
        return image, np.bincount(of, a, len(image)), most, np.bincount(of, minlength=len(image))

    pairs = pairs.select("image_id", "c", "data", "dec")
    facts = per_slice(pairs, "image_id long, total double, most double, n long", sums).groupBy("image_id").agg(F.sum("total").alias("total"), F.max("most").alias("most"), F.sum("n").alias("n"))
    path = scratch(spark, "tile-angles")
    facts.write.parquet(path)
    facts = spark.read.parquet(path)
    at = F.floor((F.col("n") - 1) * 0.99)
    ranks = facts.select("image_id", F.explode(F.array(at, F.least(at + 1, F.col("n") - 1))).alias("goal"))
    state = ranks.distinct().select("image_id", "goal", F.col("goal").alias("left"), F.lit(0).cast("long").alias("prefix"))
    for part in range(PARTS):
        shift = 16 * (PARTS - 1 - part)

        def count(image: list[int], *tile: list, shift: int = shift) -> tuple:
            *tile, prefix = tile
            a, of = angles(*tile)
            bits = a.view(np.int64) >> shift
            inside = bits >> 16 == np.asarray(prefix, np.int64)[of]
            known, place = np.unique(np.array([image, prefix], np.int64), axis=1, return_inverse=True)
            bins, n = np.unique(place.ravel()[of[inside]] << 16 | bits[inside] & 0xFFFF, return_counts=True)
            return *known[:, bins >> 16], bins & 0xFFFF, n

        wanted = state.select("image_id", "prefix").distinct()
        held = pairs.join(wanted, "image_id").select(*pairs.columns, "prefix")
        bins = per_slice(held, "image_id long, prefix long, bin int, n long", count).groupBy("image_id", "prefix", "bin").agg(F.sum("n").alias("n"))
        running = Window.partitionBy("image_id", "prefix").orderBy("bin")
        bins = bins.withColumn("before", F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, -1))).withColumn("before", F.coalesce("before", F.lit(0)))
        found = state.join(bins, ["image_id", "prefix"]).filter((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("n")))
        path = scratch(spark, "tile-ranks")
        found.select("image_id", "goal", (F.col("left") - F.col("before")).alias("left"), (F.col("prefix") * 65_536 + F.col("bin")).alias("prefix")).write.parquet(path)
        state = spark.read.parquet(path)

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64).view(float))], names=["image_id", "goal", "angle"])

    values = state.select("image_id", "goal", "prefix").mapInArrow(value, "image_id long, goal long, angle double")
    low = F.floor((F.col("n") - 1) * 0.99)
    share = (F.col("n") - 1) * 0.99 - low
    both = facts.join(values, "image_id").groupBy("image_id", "total", "most", "n").agg(F.min("angle").alias("a"), F.max("angle").alias("b"))
    return both.select("image_id", (F.col("total") / F.col("n")).alias("ang_mean_deg"), (F.col("a") + (F.col("b") - F.col("a")) * share).alias("ang_p99_deg"), F.col("most").alias("ang_max_deg"))
