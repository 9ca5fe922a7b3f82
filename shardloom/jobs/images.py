"""Raster and benchmark queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import encoders, rasters, tiles
from . import standins as s
from .catalog import Query, values

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *views: str):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = s.with_views(sql, *views) if views else sql
        return f

    return add


def rounded(rows: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return rows.withColumns({n: F.round(n, digits) for n in names})


_ERRORS = "select image_id, avg(power(ref - dec, 2)) as mse, max(abs(ref - dec))::double as max_err, avg(abs(ref - dec)) as mae from {} group by image_id"


@query(f"select image_id, round(mse, 6) as mse, round(case when mse = 0 then 'inf'::double else 10 * log10(65025 / mse) end, 6) as psnr_db, max_err from ({_ERRORS.format('raster_rgb')})", "raster_rgb")
def d15_color_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rasters.color_metrics(s.rgb_images(spark, sf_dir)), "mse", "psnr_db")


@query(f"select image_id, round(mae, 6) as mae, max_err, round(10 * log10(65025 / greatest(mse, 1e-9)), 6) as psnr_db from ({_ERRORS.format('raster8')})", "raster8")
def d16_gray_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rasters.gray_metrics(s.gray_images(spark, sf_dir)), "mae", "psnr_db")


_PIXELS = "select image_id, pixel, " + ", ".join(f"max(case when ch = {c} then {v} end) / 255.0::double * 2 - 1 as {v[0]}{c}" for v in ("ref", "dec") for c in range(3)) + " from raster_rgb group by 1, 2"


def angles(z: str) -> str:
    return f"""select image_id, degrees(acos(least(greatest((r0 * d0 + r1 * d1 + r2 * z) / greatest(sqrt(r0 * r0 + r1 * r1 + r2 * r2), 1e-9) / greatest(sqrt(d0 * d0 + d1 * d1 + z * z), 1e-9), -1), 1))) as angle
 from (select *, {z} as z from ({_PIXELS}))"""


def _angles_sql(z: str) -> str:
    return f"select image_id, round(avg(angle), 4) as ang_mean_deg, round(quantile_cont(angle, 0.99), 4) as ang_p99_deg, round(max(angle), 4) as ang_max_deg from ({angles(z)}) group by image_id"


@query(_angles_sql("sqrt(least(greatest(1 - d0 * d0 - d1 * d1, 0), 1))"), "raster_rgb")
def d17_normal_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rasters.normal_metrics(s.rgb_images(spark, sf_dir)), "ang_mean_deg", "ang_p99_deg", "ang_max_deg", digits=4)


@query(_angles_sql("d2"), "raster_rgb")
def d17_normal_metrics_xyz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For formats of three channels."""
    return rounded(rasters.normal_metrics(s.rgb_images(spark, sf_dir), rebuild_z=False), "ang_mean_deg", "ang_p99_deg", "ang_max_deg", digits=4)


def normal_sql(source: str) -> str:
    """image_id, dc_x, dc_y of bytes (image_id, pixel, ch, b)."""
    pixels = ", ".join(f"max(case when ch = {c} then b end) / 255.0::double * 2 - 1 as r{c}" for c in range(3))
    slopes = ", ".join(f"avg(least(greatest(r{i} / greatest(r2, 0.05), -4), 4)) as dc_{'xy'[i]}" for i in (0, 1))
    return f"select image_id, {slopes} from (select image_id, pixel, {pixels} from ({source}) group by 1, 2) group by image_id"


@query(f"select image_id, round(dc_x, 6) as dc_x, round(dc_y, 6) as dc_y from ({normal_sql('select image_id, pixel, ch, ref as b from raster_rgb')})", "raster_rgb")
def d18_normal_dc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rasters.normal_dc(s.rgb_images(spark, sf_dir), "ref"), "dc_x", "dc_y")


def quantiles_sql(source: str) -> str:
    """image_id, p2, p98 of bytes (image_id, y, x, b)."""
    counted = f"select image_id, bin, sum(n) over (partition by image_id order by bin) as cum, sum(n) over (partition by image_id) as total from (select image_id, b as bin, count(*) as n from ({source}) group by 1, 2)"
    first = "min(case when floor(total * {q}::double) = 0 then 0 when cum >= floor(total * {q}::double) then bin end)"
    return f"select image_id, {first.format(q=0.02)} as p2, {first.format(q=0.98)} as p98 from ({counted}) group by 1"


_BOX = "select image_id, {l} as level, y // 2 as y, x // 2 as x, avg(v) as v from ({src}) group by image_id, y // 2, x // 2"


def wavelength_sql(source: str, levels: int) -> str:
    """image_id, tiles of square images of 2 ** levels bytes (image_id, y, x, b) a side."""
    scaled = f"select image_id, y, x, b / 255.0::double as v from ({source})"
    series = []
    for level in range(levels + 1):
        series.append(f"select image_id, {level} as level, greatest(avg(v * v) - avg(v) * avg(v), 0) as var from ({scaled}) group by image_id")
        scaled = _BOX.format(l=level + 1, src=scaled)
    crossing = "case when v[k] > 0 then least(greatest((ln(v[k - 1]) - ln(v[1] / 2)) / greatest(ln(v[k - 1]) - ln(v[k]), 1e-12), 0), 1) else 0 end"
    place = f"case when k is null then {levels} else k - 2 + {crossing} end"
    return f"""select image_id, case when v[1] < 1e-8 then 0.25 else least(greatest(power(2, 1 + {place}) / {1 << levels}, 1 / 1024.0::double), 1) end as tiles
 from (select *, list_min([i for i in range(2, {levels + 2}) if v[i] <= v[1] / 2]) as k from (select image_id, list(var order by level) as v from ({" union all ".join(series)}) group by image_id))"""


def height_sql(source: str, levels: int) -> str:
    """image_id, mean, norm, tiles of bytes (image_id, y, x, b)."""
    return f"""select image_id, mean, least(greatest(0.5 / greatest(p98 / 255.0::double - mean, mean - p2 / 255.0::double, 2 / 255.0::double), 0.5), 16) as norm, tiles
 from ({quantiles_sql(source)}) join (select image_id, avg(b) / 255 as mean from ({source}) group by 1) using (image_id) join ({wavelength_sql(source, levels)}) using (image_id)"""


def stats_sql(gray: str, rgb: str, levels: int) -> str:
    """The statistics of each map's images; maps go round by id."""
    kind = "(['albedo', 'normal', 'roughness', 'height'])[(vec_id % 4 + 1)::int]"
    return f"""select vec_id as image_id, {kind} as map, case when vec_id % 4 = 1 then round(dc_x, 6) end as normal_dc_x, case when vec_id % 4 = 1 then round(dc_y, 6) end as normal_dc_y,
 case when vec_id % 4 = 3 then round(mean, 6) end as height_mean, case when vec_id % 4 = 3 then round(norm, 6) end as height_norm, case when vec_id % 4 = 3 then round(tiles, 6) end as height_lambda_tiles
 from embeddings join ({normal_sql(rgb)}) n on n.image_id = vec_id join ({height_sql(gray, levels)}) h on h.image_id = vec_id"""


_GRAY = "select image_id, y, x, {} as b from raster8"
_RGB = "select image_id, pixel, ch, {} as b from raster_rgb"


@query(quantiles_sql(_GRAY.format("ref")), "raster8")
def e2_cumulative_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.cumulative_histogram(rasters.histogram(s.gray_images(spark, sf_dir), "ref"), [0.02, 0.98])


@query(f"select image_id, round(mean, 6) as mean, round(norm, 6) as norm from ({height_sql(_GRAY.format('ref'), 3)})", "raster8")
def d19_height_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rasters.height_stats(s.gray_images(spark, sf_dir), "ref"), "mean", "norm")


@query(f"select image_id, round(tiles, 6) as lambda from ({wavelength_sql(_GRAY.format('ref'), 3)})", "raster8")
def d20_height_wavelength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rasters.height_wavelength(s.gray_images(spark, sf_dir), "ref"), "lambda")


_D1 = _BOX.format(l=1, src="select image_id, y, x, v from raster8")
_D2 = _BOX.format(l=2, src=_D1)
_D3 = _BOX.format(l=3, src=_D2)


def _pixels(chain: DataFrame, channels: int = 1) -> DataFrame:
    """image_id, level, y, x, ch, v of all levels below the first."""
    rows = chain.filter("level > 0").select("image_id", "level", "w", F.posexplode("data").alias("i", "v"))
    pixel = F.floor(F.col("i") / channels).cast("int")
    return rows.select("image_id", "level", F.floor(pixel / F.col("w")).cast("int").alias("y"), (pixel % F.col("w")).alias("x"), (F.col("i") % channels).alias("ch"), F.round("v", 6).alias("v"))


def _chain(spark: SparkSession, sf_dir: str, semantic: str) -> DataFrame:
    images = s.rgb_images(spark, sf_dir) if semantic == "normal" else s.gray_images(spark, sf_dir)
    return rasters.mip_chain(images.withColumn("data", F.col("v")), semantic)


@query(f"select image_id, level, y, x, round(v, 6) as v from (select * from ({_D1}) union all select * from ({_D2}) union all select * from ({_D3}))", "raster8")
def d21_mip_chain_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixels(_chain(spark, sf_dir, "data")).drop("ch")


_A1 = _BOX.format(l=1, src="select image_id, y, x, power(v, 2.2::double) as v from raster8")
_A2 = _BOX.format(l=2, src=_A1)
_A3 = _BOX.format(l=3, src=_A2)


@query(f"select image_id, level, y, x, round(power(v, 1 / 2.2::double), 6) as v from (select * from ({_A1}) union all select * from ({_A2}) union all select * from ({_A3}))", "raster8")
def d21_mip_chain_albedo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixels(_chain(spark, sf_dir, "albedo")).drop("ch")


_N0 = "select image_id, 0 as level, pixel // 8 as y, pixel % 8 as x, " + ", ".join(f"max(case when ch = {c} then v end) * 2 - 1 as n{c}" for c in range(3)) + " from raster_rgb group by image_id, pixel"
_LENGTH = "greatest(sqrt(a0 * a0 + a1 * a1 + a2 * a2), 1e-9)"
_NEXT = "select image_id, {l} as level, y, x, " + ", ".join(f"a{c} / {_LENGTH} as n{c}" for c in range(3)) + " from (select image_id, y // 2 as y, x // 2 as x, " + ", ".join(f"avg(n{c}) as a{c}" for c in range(3)) + " from ({src}) group by image_id, y // 2, x // 2)"
_N1 = _NEXT.format(l=1, src=_N0)
_N2 = _NEXT.format(l=2, src=_N1)
_N3 = _NEXT.format(l=3, src=_N2)


@query(f"select image_id, level, y, x, ch, round(([n0, n1, n2])[ch + 1] / 2 + 0.5, 6) as v from (select * from ({_N1}) union all select * from ({_N2}) union all select * from ({_N3})), (values (0), (1), (2)) k(ch)", "raster_rgb")
def d21_mip_chain_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixels(_chain(spark, sf_dir, "normal"), 3)


@query(f"select image_id, level, (8 >> level)::int as w, count(*)::int as pixels, round(sum(v), 5) as total from (select image_id, 0 as level, v from raster8 union all select image_id, level, v from ({_D1}) union all select image_id, level, v from ({_D2}) union all select image_id, level, v from ({_D3})) group by 1, 2", "raster8")
def d21_mip_chain_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _chain(spark, sf_dir, "data")
    return rows.select("image_id", "level", "w", F.size("data").alias("pixels"), F.round(F.aggregate("data", F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


def _by_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normals with three channels, the other maps with one."""
    return s.gray_images(spark, sf_dir).filter("map <> 'normal'").unionByName(s.rgb_images(spark, sf_dir).filter("map = 'normal'"))


_GRAY1 = f"select image_id, y, x, round_even(v * 255, 0)::int as b from ({_D1})"
_RGB1 = f"select image_id, y * 4 + x as pixel, ch, round_even((([n0, n1, n2])[ch + 1] + 1) / 2 * 255, 0)::int as b from ({_N1}), (values (0), (1), (2)) k(ch)"


@query(stats_sql(_GRAY1, _RGB1, 2), "raster8", "raster_rgb")
def d22_build_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For a preset of half the master's size: its level 0 is the chain's level 1, in bytes."""
    images = _by_map(spark, sf_dir).withColumn("data", F.col("v"))
    chains = rasters.mip_chain(images.filter("map = 'normal'"), "normal").unionByName(rasters.mip_chain(images.filter("map <> 'normal'"), "data"))
    level = chains.filter("level = 1").select("image_id", "w", "h", F.transform("data", lambda x: rasters.to_byte(x).cast("double")).alias("data"))
    return rasters.build_stats(level.join(images.select("image_id", "map", "c"), "image_id"))


SIZE = 4  # pixels a side of the queries' tiles
_B0 = "select image_id, y, x, ref / 255.0::double as v from raster8"
_B = [_B0]
for _level in (1, 2, 3):
    _B.append(_BOX.format(l=_level, src=_B[-1]))
_V0 = "select image_id, 0 as level, pixel // 8 as y, pixel % 8 as x, " + ", ".join(f"max(case when ch = {c} then ref end) / 255.0::double * 2 - 1 as n{c}" for c in range(3)) + " from raster_rgb group by image_id, pixel"
_V = [_V0]
for _level in (1, 2):
    _V.append(_NEXT.format(l=_level, src=_V[-1]))


def _tiles(images: DataFrame) -> DataFrame:
    return tiles.to_tiles(images.withColumn("data", F.col("ref")), SIZE)


@query("select image_id, level, y, x, round(v, 6) as v from (" + " union all ".join(f"select image_id, level, y, x, v from ({b})" for b in _B[1:]) + ")", "raster8")
def d21_tile_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data chain from tiles of bytes; tiles of each level are put back in their places."""
    chain = tiles.tile_chain(_tiles(s.gray_images(spark, sf_dir)), "data", SIZE).filter("level > 0")
    rows = tiles.tile_values(chain)
    return rows.select("image_id", "level", (F.col("y") * SIZE + F.col("row")).alias("y"), (F.col("x") * SIZE + F.col("column")).alias("x"), F.round("v", 6).alias("v"))


def _gray_bytes(level: int) -> str:
    return f"select image_id, y, x, round_even(round(v * 255, 9), 0)::int as b from ({_B[level]})"


def _rgb_bytes(level: int) -> str:
    side = 8 >> level
    return f"select image_id, y * {side} + x as pixel, ch, round_even(round((([n0, n1, n2])[ch + 1] + 1) / 2 * 255, 9), 0)::int as b from ({_V[level]}), (values (0), (1), (2)) k(ch)"


_PRESET_LEVELS = {"bonkers": 0, "default": 1, "low": 2}


@query(" union all ".join(f"select '{p}' as preset, * from ({stats_sql(_gray_bytes(k), _rgb_bytes(k), 3 - k)})" for p, k in _PRESET_LEVELS.items()), "raster8", "raster_rgb")
def d22_preset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics at each preset's level, from one chain of tiles for each image."""
    images = _by_map(spark, sf_dir)
    chain = tiles.tile_chain(_tiles(images.filter("map = 'normal'")), "normal", SIZE).unionByName(tiles.tile_chain(_tiles(images.filter("map <> 'normal'")), "data", SIZE))
    chain = s.stored(chain, "chain")
    out = None
    for preset, level in _PRESET_LEVELS.items():
        got = tiles.tile_stats(tiles.to_bytes(chain.filter(F.col("level") == level)), images, SIZE).withColumn("preset", F.lit(preset))
        out = got if out is None else out.unionByName(got)
    return out


@query(_angles_sql("sqrt(least(greatest(1 - d0 * d0 - d1 * d1, 0), 1))"), "raster_rgb")
def d17_tile_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = s.rgb_images(spark, sf_dir)
    ref, dec = _tiles(images), tiles.to_tiles(images.withColumn("data", F.col("dec")), SIZE)
    pairs = ref.join(dec.select("image_id", "y", "x", F.col("data").alias("dec")), ["image_id", "y", "x"])
    return rounded(tiles.tile_angles(s.stored(pairs, "pairs")), "ang_mean_deg", "ang_p99_deg", "ang_max_deg", digits=4)


_PARITY = f"""select image_id, t.field, round(case when relative then abs(x - y) / abs(y) else abs(x - y) end, 8) as delta, coalesce(case when relative then abs(x - y) / abs(y) else abs(x - y) end <= most, false) as ok
 from (select a.image_id, f.field, case f.field when 'normal_dc_x' then a.normal_dc_x when 'normal_dc_y' then a.normal_dc_y when 'height_mean' then a.height_mean when 'height_norm' then a.height_norm else a.height_lambda_tiles end as x,
  case f.field when 'normal_dc_x' then b.normal_dc_x when 'normal_dc_y' then b.normal_dc_y when 'height_mean' then b.height_mean when 'height_norm' then b.height_norm else b.height_lambda_tiles end as y
  from ({stats_sql(_GRAY.format("ref"), _RGB.format("ref"), 3)}) a join ({stats_sql(_GRAY.format("dec"), _RGB.format("dec"), 3)}) b using (image_id), (values ('normal_dc_x'), ('normal_dc_y'), ('height_mean'), ('height_norm'), ('height_lambda_tiles')) f(field))
 join (values ('normal_dc_x', 0.001, false), ('normal_dc_y', 0.001, false), ('height_mean', 0.001, false), ('height_norm', 0.01, true), ('height_lambda_tiles', 0.1, true)) t(field, most, relative) using (field) where x is not null or y is not null"""


@query(_PARITY, "raster8", "raster_rgb")
def c12_stats_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the images against what is decoded from their coarser bytes."""
    images = _by_map(spark, sf_dir)
    a, b = (rasters.build_stats(images.withColumn("data", F.col(x))) for x in ("ref", "dec"))
    return rounded(rasters.stats_parity(a, b), "delta", digits=8)


_MEANS = ", ".join(f"avg({c}) filter (where error is null) as {c}" for c in ("psnr_db", "mae", "ang_mean_deg", "ang_p99_deg", "encode_s"))
_SUMMARY = f"select semantic, format, encoder, {_MEANS}, max(max_err) filter (where error is null) as max_err, max(ang_max_deg) filter (where error is null) as ang_max_deg, count(*) as runs, count(error) as failures from bench group by 1, 2, 3"
_FORMATS = [("f0", 16, 4, 4), ("f1", 16, 4, 4), ("f2", 8, 4, 4), ("f3", 8, 4, 4)]


@query(f"select * replace (round(psnr_db, 6) as psnr_db, round(mae, 6) as mae, round(ang_mean_deg, 6) as ang_mean_deg, round(ang_p99_deg, 6) as ang_p99_deg, round(encode_s, 6) as encode_s) from ({_SUMMARY})", "bench")
def d14_encoder_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(encoders.encoder_summary(s.bench(spark, sf_dir)), *encoders.MEANS)


_SCORED = f"select *, block_bytes * 8.0::double / (bw * bh) as bpp, case semantic when 'albedo' then psnr_db when 'normal' then ang_mean_deg else mae end as score, semantic = 'albedo' as more from ({_SUMMARY}) join {values(_FORMATS, 'b', 'format', 'block_bytes', 'bw', 'bh')} using (format)"


@query(
    f"""select semantic, bpp, format, encoder, round(score, 6) as score, row_number() over (partition by semantic, bpp order by case when more then -score else score end nulls last, encode_s nulls first, format, encoder)::int as rank,
 round(case when more then max(score) over (partition by semantic, bpp) / score else score / min(score) over (partition by semantic, bpp) end, 6) as ratio_to_best from ({_SCORED})""",
    "bench",
)
def e3_encoder_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    formats = spark.createDataFrame(_FORMATS, "format string, block_bytes int, bw int, bh int")
    return rounded(encoders.encoder_winner(encoders.encoder_summary(s.bench(spark, sf_dir)), formats), "score", "ratio_to_best")
