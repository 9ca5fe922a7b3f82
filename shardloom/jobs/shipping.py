"""Shard, pack, release and install queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry, keys
from ..operators import build, release, shards, validate
from ..sources import config, files, packs
from . import standins as s
from .catalog import FAMILY_SQL, MOD, Query, _families, values

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *views: str):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = s.with_views(sql, *views) if views else sql
        return f

    return add


FAMILY = shards.FAMILY
_ALIGNED = "((size + 15) // 16 * 16)"
_LAYOUT = f"select tpage, mat, map, sha, size, (16 + coalesce(sum({_ALIGNED}) over (partition by tpage order by mat, map rows between unbounded preceding and 1 preceding), 0))::bigint as \"offset\" from assets"


def _layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.pack_layout(s.assets(spark, sf_dir).drop("payload"), ["tpage"], ["mat", "map"])


@query(_LAYOUT, "assets")
def e1_pack_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layout(spark, sf_dir).select("tpage", "mat", "map", "sha", "size", "offset")


@query(f'select tpage, max("offset" + size)::bigint as index_offset, count(*) as entry_count from ({_LAYOUT}) group by tpage', "assets")
def e1_pack_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.pack_index(_layout(spark, sf_dir), ["tpage"])


_FAMILY = "game, profile, preset, grp, cluster, parts, part"
_PACKED = f"select *, (16 + coalesce(sum({_ALIGNED}) over (partition by {_FAMILY} order by mat, map rows between unbounded preceding and 1 preceding), 0))::bigint as \"offset\" from ({FAMILY_SQL}) where size > 0"
_POLICY = values([(m, f"VK_FORMAT_{config.FORMATS[f][0]}", c, config.COLORSPACES[m]) for m, (f, c) in config.PROFILES["pc-bc"].items()], "po", "map", "format", "channels", "colorspace")
_NUMBER = "(regexp_extract(mat, '[0-9]+$', 0))::bigint"
_RECORD = f"""select *, 'jak1/' || mat as id, (1 << ({_NUMBER} % 8)::int) as width, (1 << ({_NUMBER} % 5)::int) as height, length(bin(1 << greatest({_NUMBER} % 8, {_NUMBER} % 5)::int))::int as mip_levels,
 case when {_NUMBER} % 3 = 0 then 'clamp' else 'repeat' end as wrap_mode, 'none' as alpha_mode, case when map = 'normal' then {_NUMBER} % 100 / 256 end as normal_dc_x, case when map = 'height' then {_NUMBER} % 50 / 64 end as height_mean from ({_PACKED}) join {_POLICY} using (map)"""
_FIELDS = ["id", "key", "map", "format", "width", "height", "mip_levels", "colorspace", "channels", "wrap_mode", "alpha_mode"]


def _outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard families' outputs with their dimensions, statistics and index records."""
    policy = config.profile_dim(spark).filter("profile = 'pc-bc'").select("map", "format", "channels", "colorspace")
    doc = F.col("doc_id").cast("int")
    rows = _families(spark, sf_dir).filter("size > 0").join(F.broadcast(policy), "map")
    rows = rows.withColumns({"w": F.call_function("shiftleft", F.lit(1), doc % 8), "h": F.call_function("shiftleft", F.lit(1), doc % 5)})
    rows = rows.withColumn("mip_levels", geometry.level_count(F.col("w"), F.col("h")).cast("int"))
    nothing = F.lit(None).cast("double")
    stats = {"normal_dc_x": F.when(F.col("map") == "normal", doc % 100 / 256), "normal_dc_y": F.when(F.col("map") == "normal", F.lit(0.5)), "height_mean": F.when(F.col("map") == "height", doc % 50 / 64), "height_norm": nothing, "height_lambda_tiles": nothing}
    known = s.assets(spark, sf_dir).select("mat", F.lit("jak1").alias("game"), F.when(doc % 3 == 0, "clamp").alias("wrap_mode"), F.lit(None).cast("string").alias("alpha_mode"))
    return shards.pack_entries(rows.withColumns(stats).drop("game"), known, config.format_dim(spark))


def _written(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the packs of all outputs."""
    path = s.scratch(spark, "packs")
    payload = s.assets(spark, sf_dir).select("mat", "payload")
    rows = _outputs(spark, sf_dir).join(payload, "mat").select(*PACKED, F.col("mat").alias("key"), "map", "payload", "record", "size")
    packs.write_packs(rows, PACKED, path)
    return path


PACKED = ["game", "profile", "preset", "grp", "cluster", "parts", "part"]


@query(f"select game, profile, preset, grp, cluster, part, count(*)::bigint as entry_count, true as named from ({_PACKED}) group by {_FAMILY}", "assets", "clusters")
def a9_write_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the list of packs: entries of each family, and whether all names hold the family and the hash."""
    held = spark.read.parquet(_written(spark, sf_dir) + "/_packs")
    c = F.col
    named = c("name") == keys.shard_name(c("game"), c("profile"), c("preset"), c("grp"), c("cluster"), c("parts").cast("int"), c("part"), c("sha256"))
    return held.groupBy(*PACKED).agg(F.sum("entry_count").alias("entry_count"), F.bool_and(named).alias("named")).select("game", "profile", "preset", "grp", "cluster", F.col("part").cast("long").alias("part"), "entry_count", "named")


@query(f'select game, profile, preset, grp as "group", cluster, id, mat as key, map, format, width, height, mip_levels, colorspace, channels, wrap_mode, alpha_mode, normal_dc_x, height_mean, sha as sha256, size, "offset" from ({_RECORD})', "assets", "clusters")
def a10_scan_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets are those in the layout of the whole family: a pack's base and what lies before the entry in the pack."""
    path = _written(spark, sf_dir)
    bases = spark.read.parquet(path + "/_packs").select(F.col("name").alias("pack"), "base")
    rows = packs.scan_pack_files(spark, path).join(bases, "pack")
    return rows.select("game", "profile", "preset", "group", "cluster", *_FIELDS, "stats.normal_dc_x", "stats.height_mean", "sha256", "size", (F.col("base") + F.col("offset") - packs.HEADER).alias("offset"))


@query(f"select case when payload is null or payload = '' then 'empty payload' else 'unknown map' end as reason, mat as key, kind as map from (select mat, case when doc_id % 7 = 0 then '' else payload end as payload, case when doc_id % 5 = 0 then 'depth' else map end as kind from assets) where payload is null or payload = '' or kind = 'depth'", "assets")
def a9_refused_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some payloads are emptied and some maps given a name that no group has."""
    doc = F.col("doc_id")
    rows = s.assets(spark, sf_dir).select(F.col("mat").alias("key"), F.when(doc % 5 == 0, "depth").otherwise(F.col("map")).alias("map"), F.when(doc % 7 == 0, "").otherwise(F.col("payload")).alias("payload"))
    return packs.refused_entries(rows)


def _damaged(spark: SparkSession, path: str, held: DataFrame, kind) -> str:
    """A folder with the packs of another; of those whose ``kind`` is altered or short the first payload's first byte is changed, or the last byte cut off; missing ones are left out."""
    out = s.scratch(spark, "damaged-packs")
    files.Folder(out).make()

    def copy(batches):
        old, new = files.Folder(path), files.Folder(out)
        for batch in batches:
            for name, fault in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with old.open(f"{old.base}/{name}") as f:
                    content = bytearray(f.read())
                if fault == "altered":
                    content[packs.HEADER] ^= 255
                with new.create(name) as f:
                    f.write(bytes(content[:-1] if fault == "short" else content))
            yield batch

    # One job, whose result is not kept: the copies are.
    held.select("name", F.coalesce(kind, F.lit("")).alias("kind")).filter("kind <> 'missing'").mapInArrow(copy, "name string, kind string").write.format("noop").mode("overwrite").save()
    return out


_FIRST = f"select game, profile, preset, grp, cluster, part, mat as key, map, row_number() over (partition by {_FAMILY} order by mat, map) as rn, count(*) over (partition by {_FAMILY}) as n from ({FAMILY_SQL}) where size > 0"


@query(f"select game, profile, preset, grp, cluster, part, key, map, 'altered' as reason from ({_FIRST}) where rn = 1", "assets", "clusters")
def a11_verify_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The byte after the header is the first payload's; it is altered in the first pack of every family."""
    path = _written(spark, sf_dir)
    listed = spark.read.parquet(path + "/_packs")
    found = packs.verify_pack_files(spark, _damaged(spark, path, listed, F.when(F.col("cut") == 0, "altered")))
    found = found.join(listed.withColumnRenamed("name", "pack").select("pack", *PACKED), "pack")
    return found.select("game", "profile", "preset", "grp", "cluster", F.col("part").cast("long").alias("part"), "key", "map", "reason")


_FAULTS = ("missing", "unlisted", "altered", "short")


@query(
    f"""select game, profile, preset, grp, cluster, part, case when e.fault = 'altered entry' then key end as key, case when e.fault = 'altered entry' then map end as map, split_part(e.fault, ' ', 1) as reason
 from ({_FIRST}), (values (0, 'missing'), (1, 'unlisted'), (2, 'altered'), (2, 'altered entry'), (3, 'short')) e(k, fault) where rn = 1 and n % 5 = e.k""",
    "assets",
    "clusters",
)
def a11_reconcile_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each family's first pack, by its family's entries, the file goes, its line in the manifest goes, or its bytes are changed or cut."""
    path = _written(spark, sf_dir)
    listed = spark.read.parquet(path + "/_packs").withColumn("n", F.sum("entry_count").over(Window.partitionBy(*PACKED)))
    kind = F.when(F.col("cut") == 0, F.get(F.array(*map(F.lit, _FAULTS)), (F.col("n") % 5).cast("int")))
    listed = listed.withColumn("kind", kind)
    manifest = listed.filter(~F.col("kind").eqNullSafe("unlisted")).select("name", "sha256", "size")
    found = packs.verify_pack_files(spark, _damaged(spark, path, listed, F.col("kind")), manifest)
    found = found.join(listed.withColumnRenamed("name", "pack").select("pack", *PACKED), "pack")
    return found.select("game", "profile", "preset", "grp", "cluster", F.col("part").cast("long").alias("part"), "key", "map", "reason")


@query(f"select game, profile, preset, grp, cluster, part, count(*) as entries, sum(size)::bigint as bytes from ({FAMILY_SQL}) group by all", "assets", "clusters")
def d7_family_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.family_rollup(_families(spark, sf_dir))


@query(f"""select profile, preset, min(cost)::bigint as least, max(cost)::bigint as most, count(*) as materials from (select profile, preset, mat, sum(bytes) as cost from (select distinct mat, game, profile, preset, grp, cluster, part from fam)
 join (select game, profile, preset, grp, cluster, part, sum(size) as bytes from fam group by all) using (game, profile, preset, grp, cluster, part) group by all) group by all""".replace("from fam", f"from ({FAMILY_SQL})"), "assets", "clusters")
def d11_change_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _families(spark, sf_dir)
    return shards.change_cost(rows, shards.family_rollup(rows))


@query("select tpage, sha, count(*) as n from assets group by all having count(*) > 1", "assets")
def d12_uniqueness_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.uniqueness_check(s.assets(spark, sf_dir), ["tpage", "sha"])


@query(f"select part, n, max(n) over () < 2 * avg(n) over () and min(n) over () > 0 as balanced from (select part, count(mat) as n from (select unnest(range(8)) as part) left join (select distinct mat, {MOD.format(x='mat', n=8)} as part from assets) using (part) group by part)", "assets")
def d13_part_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.part_balance(s.assets(spark, sf_dir), 8)


@query("select preset, max(size) as largest, count(*) filter (where size > 8000) as over, count(*) filter (where size < 1000) as under, count(*) as shards from shards_now group by preset", "shards_now")
def d10_size_band_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.size_band_check(s.shards_now(spark, sf_dir), 1000, 8000)


@query("select preset, name, size, rank from (select *, row_number() over (partition by preset order by size desc, name)::int as rank from shards_now) where rank <= 5", "shards_now")
def f1_largest_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.largest_shards(s.shards_now(spark, sf_dir), 5).select("preset", "name", "size", "rank")


@query("select split_part(tpage, '-vis-', 1) as key, 'left' as side from assets where split_part(tpage, '-vis-', 1) not in (select prefix from clusters) group by 1", "assets", "clusters")
def g1_set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = s.table(spark, sf_dir, "documents").select(F.col("source").alias("key")).distinct()
    return shards.set_equality(used, s.clusters(spark).select(F.col("prefix").alias("key")))


_SAMPLES = ["src0-vis-en/d0", "src1-vis-en/d1", "src9-vis-xx/d9", "src5-vis-en/d5"]


@query(f"select ordinal, mat, map from assets join {values(list(enumerate(_SAMPLES)), 'w', 'ordinal', 'mat')} using (mat)", "assets")
def f2_pick_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.pick_samples(s.assets(spark, sf_dir).select("mat", "map"), _SAMPLES).select("ordinal", "mat", "map")


@query(f"select preset, id, mat as key, map, format, width, height, mip_levels, colorspace, channels, wrap_mode, alpha_mode, normal_dc_x, height_mean from ({_RECORD})", "assets", "clusters")
def c13_pack_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record is JSON; its fields are read back from it."""
    kinds = {"width": "int", "height": "int", "mip_levels": "int"}
    rows = _outputs(spark, sf_dir)
    fields = [F.get_json_object("record", f"$.{f}").cast(kinds.get(f, "string")).alias(f) for f in _FIELDS]
    return rows.select("preset", *fields, *[F.get_json_object("record", f"$.stats.{f}").cast("double").alias(f) for f in ("normal_dc_x", "height_mean")])


_REUSE = "select n.page_id, n.name, n.sha, n.size, coalesce(p.page_id is not null, false) as reused, coalesce(p.tag, 'v2.0.0') as release_tag, coalesce(p.url, 'https://assets.example/v2.0.0/' || n.name) as url from shards_now n left join (select sha, max_by(page_id, name) as page_id, max_by('old/' || name, name) as url, 'v1.0.0' as tag from shards_prev group by sha) p using (sha)"


def _reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev = s.shards_prev(spark, sf_dir).select("sha", "name", F.concat(F.lit("old/"), "name").alias("url"), F.lit("v1.0.0").alias("release_tag"))
    return release.shard_reuse(s.shards_now(spark, sf_dir).select("page_id", "name", "sha", "size"), prev, "v2.0.0", "https://assets.example")


@query(_REUSE, "shards_now", "shards_prev")
def c6_shard_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reuse(spark, sf_dir)


@query("select name, sha, size from shards_now", "shards_now")
def c6_refuse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No page has a negative size, so the release goes through."""
    now = s.shards_now(spark, sf_dir)
    return release.refuse_failures(now.select("name", "sha", "size"), now.filter("size < 0"))


@query(f"select count(*) as total, count(*) filter (where reused) as reused, count(*) filter (where not reused) as to_upload, round(count(*) filter (where reused) / count(*), 6) as rate from ({_REUSE})", "shards_now", "shards_prev")
def d9_release_reuse_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.release_reuse_stats(_reuse(spark, sf_dir))


_DIFF = "select name, case when w.size is null then 'orphan' when w.size is not distinct from i.size then 'keep' else 'fetch' end as action, coalesce(w.size, i.size) as size from (select name, size from shards_now where profile = 'en' and preset = 'low') w full join installed i using (name)"


def _diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = release.resolve_shards(s.with_features(s.shards_now(spark, sf_dir)), "en", "low", True)
    return release.install_diff(wanted, s.installed(spark, sf_dir))


@query(_DIFF, "shards_now", "installed")
def c7_install_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _diff(spark, sf_dir)


@query(f"select action, count(*) as shards, sum(size)::bigint as bytes, ceil(sum(case when action <> 'orphan' then size else 0 end) * 1.1::double)::bigint as space from ({_DIFF}) group by action", "shards_now", "installed")
def c7_install_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.install_totals(_diff(spark, sf_dir))


@query("select name, size from shards_now where profile = 'en' and preset = 'default' and grp <> 'material'", "shards_now")
def b14_resolve_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.resolve_shards(s.with_features(s.shards_now(spark, sf_dir)), "en", "default", False).select("name", "size")


@query("select coalesce(a.name, b.name) as name, case when a.name is null then 'missing_left' when b.name is null then 'missing_right' else 'different' end as kind from shards_now a full join shards_prev b using (name) where a.name is null or b.name is null or a.sha <> b.sha", "shards_now", "shards_prev")
def c11_rebuild_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.rebuild_diff(s.shards_now(spark, sf_dir), s.shards_prev(spark, sf_dir), ["name"], "sha")


@query("select coalesce(a.name, b.name) as name, case when a.name is null then 'missing_left' when b.name is null then 'missing_right' else 'different' end as kind from shards_now a full join shards_prev b using (name) where a.name is null or b.name is null or a.sha <> b.sha", "shards_now", "shards_prev")
def c11_rebuild_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same difference from digests of parts, top down."""
    return release.rebuild_diff_by_digests(s.shards_now(spark, sf_dir), s.shards_prev(spark, sf_dir), ["name"], "sha")


@query("select profile, preset, count(*) filter (where grp <> 'material') as shards, count(*) filter (where grp = 'material') as skipped_shards, coalesce(sum(size) filter (where grp <> 'material'), 0)::bigint as bytes, coalesce(sum(size) filter (where grp = 'material'), 0)::bigint as skipped_bytes from shards_now group by 1, 2", "shards_now")
def b14_resolve_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.resolve_totals(s.with_features(s.shards_now(spark, sf_dir)), False)


@query("select profile, preset, sum(size)::bigint as bytes, sum(case when grp = 'albedo' then size else 0 end)::bigint as bytes_plain, count(*) as shards, grouping(profile, preset)::int as level from shards_now group by rollup (profile, preset)", "shards_now")
def d8_download_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.download_sizes(s.with_features(s.shards_now(spark, sf_dir)))


_SHARDS = f"""select *, game || '-' || profile || '-' || preset || '-' || grp || '-shard-' || cluster || case when parts > 1 then '-p' || part else '' end || '-' || substr(sha, 1, 12) || '.rpack' as name
 from (select *, sha256(preset || grp || cluster || part || ':' || size) as sha from (select game, profile, preset, grp, cluster, parts, part::bigint as part, count(*) as entry_count, sum(size)::bigint as size from ({FAMILY_SQL}) group by 1, 2, 3, 4, 5, 6, 7))"""


def shard_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per shard family, named by the hash of its place and size."""
    c = F.col
    rows = _families(spark, sf_dir).groupBy("game", "profile", "preset", "grp", "cluster", "parts", "part").agg(F.count("*").alias("entry_count"), F.sum("size").alias("size"))
    rows = rows.withColumn("sha", F.sha2(F.concat("preset", "grp", "cluster", c("part").cast("string"), F.lit(":"), c("size").cast("string")).cast("binary"), 256))
    return rows.withColumn("name", keys.shard_name(c("game"), c("profile"), c("preset"), c("grp"), c("cluster"), c("parts"), c("part"), c("sha")))


@query(
    f"""select 1 as schema_version, 'assets-v1.0.0' as asset_version, 'jak1' as games, 'pc-bc' as profiles, 'bonkers,low' as presets, '0.9.0' as min_recharged_version, true as has_max, 2 as min_loader_version, row_number() over (order by name)::int - 1 as place,
 name, game, profile, preset, grp as "group", cluster, sha as sha256, size, 'u/' || name as url, 'assets-v1.0.0' as release_tag, entry_count, case when grp = 'material' then 'pbr' else '' end as requires_features from ({_SHARDS})""",
    "assets",
    "clusters",
)
def a7_manifest_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document's JSON is read back, a row for each shard in its place."""
    rows = shard_list(spark, sf_dir).withColumns({"url": F.concat(F.lit("u/"), "name"), "release_tag": F.lit("assets-v1.0.0")})
    doc = release.manifest_doc(rows, "assets-v1.0.0", "0.9.0", 2)
    text = release.manifest_json(doc)
    read = text.select("value", F.from_json("value", doc.schema).alias("d"))
    has_max = F.array_contains(F.json_object_keys(F.get_json_object("value", "$.engine_compat")), "max_recharged_version")
    head = ["d.schema_version", "d.asset_version", *[F.concat_ws(",", F.col(f"d.{c}")).alias(c) for c in ("games", "profiles", "presets")], "d.engine_compat.min_recharged_version", has_max.alias("has_max"), "d.engine_compat.min_loader_version"]
    rows = read.select(*head, F.posexplode("d.shards").alias("place", "x"))
    return rows.select("*", "x.*").drop("x").withColumn("requires_features", F.concat_ws(",", "requires_features"))


@query(f'select name, game, profile, preset, grp as "group", cluster, part, sha as sha256, size, entry_count from ({_SHARDS})', "assets", "clusters")
def a8_shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = spark.createDataFrame([], "profile string, preset string, map string, gate_ok boolean, status string")
    return build.build_report(outputs, shard_list(spark, sf_dir), config.ladder_dim(spark))[1]


_BROKEN = f"select *, case when part % 2 = 1 then 'x' || name else name end as shown, case when entry_count % 3 = 0 then 0 else entry_count end as entries, case when cluster = 'overflow' then null else cluster end as place from ({_SHARDS})"


@query(
    f"""select shown as id, unnest([x for x in [case when part % 2 = 1 then {{'rule': 'name', 'value': shown}} end, case when place is null then {{'rule': 'cluster', 'value': null}} end, case when entries < 1 then {{'rule': 'entry_count', 'value': entries::varchar}} end,
 case when size < 1 then {{'rule': 'size', 'value': size::varchar}} end] if x is not null], recursive := true) from ({_BROKEN})""",
    "assets",
    "clusters",
)
def b13_manifest_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some shards are given wrong names, no entries or no cluster."""
    c = F.col
    rows = shard_list(spark, sf_dir).withColumns(
        {"name": F.when(c("part") % 2 == 1, F.concat(F.lit("x"), "name")).otherwise(c("name")), "entry_count": F.when(c("entry_count") % 3 == 0, 0).otherwise(c("entry_count")), "cluster": F.when(c("cluster") != "overflow", c("cluster")), "url": F.lit("u"), "group": c("grp"), "sha256": c("sha")}
    )
    return validate.validate_records(rows, "name", validate.shard_rules())


@query(
    f"""select key, unnest([x for x in [case when "offset" % 3 = 0 then {{'rule': 'offset', 'value': ("offset" + 8)::varchar}} end, case when height_mean > 0.5 then {{'rule': 'height_mean', 'value': (height_mean * 2)::varchar}} end,
 case when width = 128 then {{'rule': 'width', 'value': '0'}} end, case when wrap_mode = 'clamp' then {{'rule': 'wrap_mode', 'value': 'clamped'}} end] if x is not null], recursive := true) from (select mat as key, * from ({_RECORD}))""",
    "assets",
    "clusters",
)
def b13_pack_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some entries of the packs as read back are given wrong offsets, statistics, widths or modes."""
    path = _written(spark, sf_dir)
    bases = spark.read.parquet(path + "/_packs").select(F.col("name").alias("pack"), "base")
    c = F.col
    rows = packs.scan_pack_files(spark, path).join(bases, "pack").withColumn("offset", c("base") + c("offset") - packs.HEADER)
    rows = rows.select("*", *[c(f"stats.{f}").alias(f) for f in shards.STATS]).withColumns(
        {"offset": F.when(c("offset") % 3 == 0, c("offset") + 8).otherwise(c("offset")), "height_mean": F.when(c("height_mean") > 0.5, c("height_mean") * 2).otherwise(c("height_mean")), "width": F.when(c("width") == 128, 0).otherwise(c("width")), "wrap_mode": F.when(c("wrap_mode") == "clamp", "clamped").otherwise(c("wrap_mode"))}
    )
    return validate.validate_records(rows, "key", validate.entry_rules()).withColumnRenamed("id", "key")


@query("select name, profile, preset, case when page_id is not null then 'assets-v0.10.0' else 'assets-v0.9.0' end as release_tag from (select name, p.profile, p.preset, n.page_id from shards_prev p left join shards_now n using (name, profile, preset) union select name, profile, preset, page_id from shards_now)", "shards_now", "shards_prev")
def e4_manifest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name's pages in the new release are told apart, those in the old one aren't."""
    family = ["name", "profile", "preset"]
    old = s.shards_prev(spark, sf_dir).select(*family, F.lit(None).cast("long").alias("page_id"), F.lit("assets-v0.9.0").alias("release_tag"))
    new = s.shards_now(spark, sf_dir).select(*family, "page_id", F.lit("assets-v0.10.0").alias("release_tag"))
    return release.manifest_snapshot(old.unionByName(new).distinct(), family).select(*family, "release_tag")
