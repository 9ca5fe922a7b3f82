"""Ingest, deduplication, build planning and validation queries."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, keys
from ..operators import build, dedup, shards, validate
from ..sources import catalog as sources
from ..sources import config
from . import standins as s

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *views: str) -> Callable[[Query], Query]:
    """Register a query by its function's name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = s.with_views(sql, *views) if views else sql
        return f

    return add


def values(rows: list[tuple], name: str, *columns: str) -> str:
    """A VALUES list as a SQL table."""
    return "(values " + ", ".join("(" + ", ".join(repr(x) if not isinstance(x, bool) else str(x) for x in r) + ")" for r in rows) + f") {name}({', '.join(columns)})"


PROFILE_ROWS = values([(p, m, f, c) for p, maps in config.PROFILES.items() for m, (f, c) in maps.items()], "pr", "profile", "map", "format", "channels")
FORMAT_ROWS = values([(k, *v) for k, v in config.FORMATS.items()], "fo", "format", "vk", "block_bytes", "bw", "bh")
THRESHOLD_ROWS = values(config.THRESHOLDS, "th", "semantic", "format", "bound", "value")
PRESETS = ["low", "default", "bonkers"]
PRESET_ROWS = values([(p,) for p in PRESETS], "ps", "preset")
MOD = "list_reduce(list_prepend(0::bigint, [('0x' || substr(sha256({x}), i * 4 + 1, 4))::bigint for i in range(16)]), lambda a, d: (a * 65536 + d) % ({n})::bigint)"


# Sources.


@query("select event_id, regexp_extract(props, '\"(\\w+)\"', 1) as placement, regexp_extract(props, ': ?(\\d+)', 1)::int as material from events")
def a2_read_placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.table(spark, sf_dir, "events").select("event_id", sources.exploded_map(F.col("props"), "int").alias("placement", "material"))


@query("select 'p' || doc_id as placement, source as canonical_id, (doc_id % 3 = 0) as recale from documents")
def a3_source_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.to_json(F.create_map(F.concat(F.lit("p"), F.col("doc_id").cast("string")), F.struct(F.col("source").alias("id"), F.when(F.col("doc_id") % 3 == 0, True).alias("recale"))))
    return sources.source_entries(s.table(spark, sf_dir, "documents").select(doc.alias("value")))


MATERIALS_SQL = """select 'jak1/' || source || '-vis-' || lang || '/d' || doc_id as id, 'jak' || doc_id % 4 as game, doc_id % 8 + 1 as w, n_chars - 40 as h, (['repeat', 'clamp', 'tile', null])[(doc_id % 4 + 1)::int] as wrap_mode, case when doc_id % 9 = 0 then null else 'none' end as alpha_mode,
 case when doc_id % 11 = 0 then 'srgb' else 'linear' end as colorspace, (['rgb', 'rg', 'x'])[(doc_id % 3 + 1)::int] as channels, case when doc_id % 6 = 0 then 'zz' else sha256(text) end as source_sha256, doc_id % 13 <> 0 as has_map, doc_id from documents"""


def material_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and a material's record as JSON, for each document; some break the schema's rules."""
    doc, c = F.col("doc_id"), F.col
    one = F.struct(
        F.when(doc % 11 == 0, "srgb").otherwise("linear").alias("colorspace"),
        F.element_at(F.array(*map(F.lit, ("rgb", "rg", "x"))), (doc % 3 + 1).cast("int")).alias("channels"),
        F.when(doc % 6 == 0, "zz").otherwise(F.sha2(c("text").cast("binary"), 256)).alias("source_sha256"),
    )
    record = F.struct(
        F.when(doc % 10 != 0, 1).alias("schema_version"), F.concat(F.lit("jak1/"), "mat").alias("id"), F.concat(F.lit("jak"), (doc % 4).cast("string")).alias("game"), F.array(doc % 8 + 1, c("n_chars") - 40).alias("master_dims"),
        F.get(F.array(F.lit("repeat"), F.lit("clamp"), F.lit("tile"), F.lit(None)), (doc % 4).cast("int")).alias("wrap_mode"), F.when(doc % 9 != 0, "none").alias("alpha_mode"),
        F.when(doc % 13 != 0, F.create_map(F.lit("albedo"), one)).otherwise(F.create_map().cast("map<string,struct<colorspace:string,channels:string,source_sha256:string>>")).alias("maps"), F.when(doc % 17 == 0, True).alias("extra"),
    )
    return s.documents(spark, sf_dir).select("doc_id", F.to_json(record).alias("value"))


@query(f"select id, game, w, h, wrap_mode, alpha_mode, case when has_map then colorspace end as colorspace, case when has_map then channels end as channels, case when has_map then source_sha256 end as source_sha256 from ({MATERIALS_SQL})")
def a1_read_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = s.scratch(spark, "materials")
    material_documents(spark, sf_dir).select("value").write.option("compression", "none").text(path)
    rows = sources.read_materials(spark, path, lines=True, glob="part-*")
    albedo = F.try_element_at("maps", F.lit("albedo"))
    return rows.select("id", "game", F.col("master_dims")[0].cast("long").alias("w"), F.col("master_dims")[1].cast("long").alias("h"), "wrap_mode", "alpha_mode", *[albedo[x].alias(x) for x in ("colorspace", "channels", "source_sha256")])


@query("select s_nationkey::varchar as tpage, s_suppkey::varchar as name, sha256(s_name || '#' || s_acctbal::bigint || chr(10)) as sha256, strlen(s_name || '#' || s_acctbal::bigint || chr(10))::bigint as size from supplier")
def a4_scan_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a file for each supplier, in a folder for its nation."""
    path = s.scratch(spark, "blobs")
    text = F.concat("s_name", F.lit("#"), F.rint("s_acctbal").cast("long").cast("string"), F.lit("\n"))
    rows = s.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("tpage"), F.col("s_suppkey").cast("string").alias("name"), F.lit("blob").alias("map_kind"), text.alias("content"))
    sources.write_blobs(rows, path, "txt")
    return sources.scan_blobs(spark, path, "*.txt").select("tpage", "name", "sha256", "size")


@query("select tpage, count(*) as blobs, sum(size)::bigint as bytes, count(distinct sha) as contents from assets group by tpage", "assets")
def a4_blob_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.assets(spark, sf_dir).groupBy("tpage").agg(F.count("*").alias("blobs"), F.sum("size").alias("bytes"), F.count_distinct("sha").alias("contents"))


@query("select sha256(string_agg(sha, chr(10) order by sha)) as digest, count(*) as n from assets", "assets")
def a5_lock_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("version 1\noid sha256:"), "sha", F.lit("\nsize "), F.col("size").cast("string"), F.lit("\n"))
    return sources.lock_digest(s.assets(spark, sf_dir).select(*sources.parse_pointer(text)))


@query(f"select p.profile, p.map, p.format, p.channels, f.vk, f.block_bytes, a.n from {PROFILE_ROWS.replace(' pr(', ' p(')} join {FORMAT_ROWS.replace(' fo(', ' f(')} using (format) join (select map, count(*) as n from assets group by map) a using (map)", "assets")
def a6_config_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = s.assets(spark, sf_dir).groupBy("map").agg(F.count("*").alias("n"))
    return used.join(F.broadcast(config.profile_dim(spark)), "map").join(F.broadcast(config.format_dim(spark)), "format").select("profile", "map", "format", "channels", "vk", "block_bytes", "n")


@query("select lang as semantic, source as format, bound, (case when bound = 'min' then least else most end)::double as value from (select lang, source, min(n_chars) as least, max(n_chars) as most from documents group by 1, 2), (values ('min'), ('max')) b(bound)")
def a6_threshold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a document with a language's least and greatest lengths by source, beside a comment and a ladder."""
    by_source = s.table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.min("n_chars").alias("least"), F.max("n_chars").alias("most"))
    langs = by_source.groupBy("lang").agg(*[F.map_from_entries(F.collect_list(F.struct("source", c))).alias(n) for c, n in (("least", "min"), ("most", "max"))])
    body = F.map_from_arrays(F.array("lang", F.lit("ladder")), F.array(F.struct(F.lit("n_chars").alias("metric"), "min", "max"), F.lit(None)))
    return config.threshold_rows(langs.select(F.to_json(body).alias("value")))


@query("select distinct 'g' as game, lang as cluster, source as prefix from documents")
def a6_cluster_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    langs = s.table(spark, sf_dir, "documents").groupBy("lang").agg(F.collect_set("source").alias("prefixes"))
    game = F.struct(F.create_map("lang", "prefixes").alias("clusters"), F.lit("o").alias("overflow"))
    return config.cluster_rows(langs.select(F.to_json(F.struct(F.create_map(F.lit("g"), game).alias("games"))).alias("value")))


@query("select lang as profile, source as map, 'f' || min(doc_id % 7) as fallback from documents group by lang, source")
def a6_ladder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = s.table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.concat(F.lit("f"), F.min(F.col("doc_id") % 7).cast("string")).alias("to"))
    langs = steps.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("source", "to"))).alias("x"))
    return config.ladder_rows(langs.select(F.to_json(F.struct(F.lit("c").alias("comment"), F.create_map("lang", "x").alias("ladder"))).alias("value")))


@query("select doc_id as id, false as derived, n_chars from documents where doc_id % 7 = 0 union all select doc_id, true, n_chars + 1 from documents where doc_id % 7 <> 0")
def a12_upsert_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = s.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), (F.col("doc_id") % 7 != 0).alias("derived"), "n_chars")
    return sources.upsert_metadata(docs.withColumns({"derived": F.lit(True), "n_chars": F.col("n_chars") + 1}), docs)


@query("select lang as preset, source as grp, max(n_chars) as parts from documents group by 1, 2")
def a6_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a document with each language's greatest lengths by source as splits, beside a comment."""
    most = s.table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.max("n_chars").cast("int").alias("parts"))
    langs = most.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("source", "parts"))).alias("x"))
    body = F.to_json(F.map_from_arrays(F.array("lang", F.lit("comment")), F.array("x", F.lit(None))))
    return config.split_rows(langs.select(F.concat(F.lit('{"splits":'), body, F.lit("}")).alias("value")))


_RECORD = "id string, derived boolean, n_chars long"


@query(
    """select mat as id, tpage, case when old and derived0 and even then true when old then derived0 else true end as derived, case when even and (not old or derived0) then n_chars + 1 else n_chars end as n_chars
 from (select source || '-vis-' || lang || '/d' || doc_id as mat, source || '-vis-' || lang as tpage, doc_id % 2 = 0 as old, doc_id % 7 <> 0 as derived0, substr(source, 4)::int % 2 = 0 as even, n_chars from documents) where old or even"""
)
def a12_upsert_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the records are written, some hand-edited; then all records of half of the sources are derived again."""
    path = s.scratch(spark, "metadata")
    docs = s.documents(spark, sf_dir).select("doc_id", "source", F.col("mat").alias("id"), (F.col("doc_id") % 7 != 0).alias("derived"), F.col("n_chars").cast("long").alias("n_chars"))
    sources.write_metadata(docs.filter("doc_id % 2 = 0").select("id", "derived", "n_chars"), path)
    again = docs.filter("cast(substring(source, 4) as int) % 2 = 0").select("id", F.lit(True).alias("derived"), (F.col("n_chars") + 1).alias("n_chars"))
    sources.upsert_written(again, path, _RECORD)
    return sources.read_metadata(spark, path, _RECORD)


@query("select sha256(string_agg(d, chr(10) order by part)) as digest, sum(n)::bigint as n from (select substr(sha, 1, 3) as part, sha256(string_agg(sha, chr(10) order by sha)) as d, count(*) as n from assets group by 1)", "assets")
def a5_lock_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.lock_tree(s.assets(spark, sf_dir).select(F.col("sha").alias("oid")))


# Projections and predicates.


@query("select doc_id, tpage as dir, name as stem, tpage || '/' || name || '.png' as albedo_path, tpage || '/' || name || '_normal.png' as normal_path, tpage || '/' || name || '_roughness.png' as roughness_path, tpage || '/' || name || '_height.png' as height_path from assets", "assets")
def b1_parse_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = s.assets(spark, sf_dir).select("doc_id", F.concat(F.lit("jak1/"), "mat", F.lit(".png")).alias("path"))
    return placed.select("doc_id", *keys.placement_columns(keys.strip_game(F.col("path"), "jak1")))


@query("select doc_id, tpage, map from assets where tpage in ('src0-vis-en', 'src5-vis-fr') and map in ('albedo', 'height')", "assets")
def b2_subset_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.subset(s.assets(spark, sf_dir).select("doc_id", "tpage", "map"), tpage=["src0-vis-en", "src5-vis-fr"], map=["albedo", "height"], name=[])


@query(f"select a.mat, a.map, profile, format, preset from assets a join {PROFILE_ROWS} using (map) cross join {PRESET_ROWS}", "assets")
def b3_job_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    presets = spark.createDataFrame([(p,) for p in PRESETS], "preset string")
    return build.job_grid(s.assets(spark, sf_dir).select("mat", "map"), config.profile_dim(spark), presets).select("mat", "map", "profile", "format", "preset")


_DIMS = f"""select mat, preset, w, h, rw, rh, greatest(1, w >> k) as pw, greatest(1, h >> k) as ph from (
 select *, case when preset = 'bonkers' or rw is null then 0 else list_min([i for i in range(32) if (w >> i::int) <= rw * t and (h >> i::int) <= rh * t])::int end as k
 from (select *, case preset when 'low' then 1 else 2 end as t from dims cross join {PRESET_ROWS}))"""


def _dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.with_preset_dims(s.dims(spark, sf_dir).crossJoin(F.broadcast(spark.createDataFrame([(p,) for p in PRESETS], "preset string"))))


@query(_DIMS, "dims")
def b4_preset_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dims(spark, sf_dir)


@query("select distinct tpage, split_part(tpage, '-vis-', 1) as prefix, source || '-tpage-2' as other, source as other_prefix from (select *, split_part(tpage, '-vis-', 1) as source from assets)", "assets")
def b5_level_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = s.table(spark, sf_dir, "documents").select(F.concat("source", F.lit("-vis-"), "lang").alias("tpage"), F.concat("source", F.lit("-tpage-2")).alias("other")).distinct()
    return rows.select("tpage", keys.level_prefix(F.col("tpage")).alias("prefix"), "other", keys.level_prefix(F.col("other")).alias("other_prefix"))


@query(f"select mat, {MOD.format(x='mat', n=4)} as part4, {MOD.format(x='mat', n=1000003)} as part_big, 0::bigint as part1 from assets", "assets")
def b6_part_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    mat = F.col("mat")
    return s.assets(spark, sf_dir).select("mat", keys.part_of(mat, 4).alias("part4"), keys.part_of(mat, 1_000_003).alias("part_big"), keys.part_of(mat, 1).alias("part1"))


FAMILY_SQL = f"""select 'jak1' as game, profile, preset, mat, map, sha, size, case when map = 'albedo' then 'albedo' else 'material' end as grp, coalesce(cluster, 'overflow') as cluster, parts, case when parts <= 1 then 0 else {MOD.format(x='mat', n='greatest(parts, 1)')} end as part
 from (select *, case when preset = 'bonkers' then case when map = 'albedo' then 2 else 4 end else 1 end as parts from assets cross join {values([('pc-bc', 'low'), ('pc-bc', 'bonkers')], 'o', 'profile', 'preset')})
 left join clusters on prefix = split_part(tpage, '-vis-', 1)"""


def config_files(spark: SparkSession) -> tuple[str, str]:
    """The catalog's two config documents as files: clusters and splits, thresholds and ladder."""
    games: dict = {}
    for prefix, cluster in s.CLUSTERS:
        games.setdefault(cluster, []).append(prefix)
    splits: dict = {"comment": "parts of each group"}
    for preset, grp, parts in config.SPLITS:
        splits.setdefault(preset, {})[grp] = parts
    bounds: dict = {"comment": "accepted measures"}
    for semantic, form, bound, value in config.THRESHOLDS:
        bounds.setdefault(semantic, {"metric": "any"}).setdefault(bound, {})[form] = value
    ladder: dict = {"comment": "next format"}
    for profile, kind, fallback in config.LADDER:
        ladder.setdefault(profile, {})[kind] = fallback
    paths = s.scratch(spark, "clusters"), s.scratch(spark, "thresholds")
    for path, document in zip(paths, ({"games": {"jak1": {"clusters": games, "overflow": "overflow"}}, "splits": splits}, bounds | {"ladder": ladder}), strict=True):
        spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.text(path)
    return paths


def _families(spark: SparkSession, sf_dir: str, clusters: DataFrame | None = None, splits: DataFrame | None = None) -> DataFrame:
    outputs = spark.createDataFrame([("pc-bc", "low"), ("pc-bc", "bonkers")], "profile string, preset string")
    rows = s.assets(spark, sf_dir).drop("payload").crossJoin(F.broadcast(outputs)).withColumn("game", F.lit("jak1"))
    return shards.shard_family(rows, s.clusters(spark) if clusters is None else clusters, config.split_dim(spark) if splits is None else splits)


@query(f"select mat, map, preset, grp, cluster, parts, part from ({FAMILY_SQL})", "assets", "clusters")
def b7_shard_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _families(spark, sf_dir).select("mat", "map", "preset", "grp", "cluster", "parts", "part")


@query(f"select mat, map, preset, grp, cluster, parts, part from ({FAMILY_SQL})", "assets", "clusters")
def b7_family_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters and splits are read from their document."""
    path, _ = config_files(spark)
    clusters = config.cluster_dim(spark, path).filter("game = 'jak1'").select("prefix", "cluster")
    return _families(spark, sf_dir, clusters, config.split_file(spark, path)).select("mat", "map", "preset", "grp", "cluster", "parts", "part")


@query(f"select mat, preset, game || '-' || profile || '-' || preset || '-' || grp || '-shard-' || cluster || case when parts > 1 then '-p' || part else '' end || '-' || substr(sha, 1, 12) || '.rpack' as shard from ({FAMILY_SQL})", "assets", "clusters")
def b8_shard_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return _families(spark, sf_dir).select("mat", "preset", keys.shard_name(c("game"), c("profile"), c("preset"), c("grp"), c("cluster"), c("parts"), c("part"), c("sha")).alias("shard"))


_KEYED = f"select mat, map, preset, profile, format, sha256(sha || 'tc1|' || format || '|' || channels || '|(' || pw || ', ' || ph || ')|mips1|thorough') as cache_key from (select mat, preset, pw, ph, (['albedo', 'normal', 'roughness', 'height'])[(mat % 4 + 1)::int] as map, sha256('s' || mat) as sha from ({_DIMS})) join {PROFILE_ROWS} using (map)"


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*map(F.lit, ("albedo", "normal", "roughness", "height")))
    rows = _dims(spark, sf_dir).withColumns({"map": F.element_at(kinds, (F.col("mat") % 4 + 1).cast("int")), "sha": F.sha2(F.concat(F.lit("s"), F.col("mat").cast("string")).cast("binary"), 256)})
    return build.with_cache_key(rows.join(F.broadcast(config.profile_dim(spark)), "map"))


@query(_KEYED, "dims")
def b9_cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir).select("mat", "map", "preset", "profile", "format", "cache_key")


_LEVELS = "select mat, w, h, level, greatest(1, w >> level) as lw, greatest(1, h >> level) as lh from (select *, unnest(range(length(bin(greatest(w, h)))))::int as level from dims)"


@query(_LEVELS, "dims")
def b10_mip_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.mip_levels(s.dims(spark, sf_dir).select("mat", "w", "h")).select("mat", "w", "h", "level", "lw", "lh")


@query(f"select mat, format, sum(((lw + bw - 1) // bw)::bigint * ((lh + bh - 1) // bh) * block_bytes)::bigint as bytes, count(*)::int as levels from ({_LEVELS}) cross join {FORMAT_ROWS} where format in ('bc7', 'astc_6x6') group by mat, format", "dims")
def b11_encoded_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = build.mip_levels(s.dims(spark, sf_dir).select("mat", "w", "h"))
    both = spark.createDataFrame([("bc7",), ("astc_6x6",)], "format string")
    return build.encoded_size(levels.crossJoin(F.broadcast(both)), config.format_dim(spark), ["mat", "format"])


_GATED = f"""select event_id, map, format, case map when 'albedo' then value * 1.5 >= coalesce(gate_min, 0) when 'normal' then value / 5 <= coalesce(gate_max, 99) and value * 1.5 <= coalesce(gate_p99_max, 999) else value / 50 <= coalesce(gate_max, 255) end as gate_ok
 from (select event_id, value, (['albedo', 'normal', 'roughness', 'height'])[(event_id % 4 + 1)::int] as map, (['bc7', 'bc5', 'bc4', 'astc_4x4', 'bc1'])[(user_id % 5 + 1)::int] as format from events)
 left join (select semantic as map, format, max(case when bound = 'min' then value end) as gate_min, max(case when bound = 'max' then value end) as gate_max, max(case when bound = 'p99_max' then value end) as gate_p99_max from {THRESHOLD_ROWS} group by all) using (map, format)"""


def _gated(spark: SparkSession, sf_dir: str, thresholds: DataFrame | None = None) -> DataFrame:
    kinds, formats = F.array(*map(F.lit, ("albedo", "normal", "roughness", "height"))), F.array(*map(F.lit, ("bc7", "bc5", "bc4", "astc_4x4", "bc1")))
    v = F.col("value")
    rows = s.table(spark, sf_dir, "events").select("event_id", F.element_at(kinds, (F.col("event_id") % 4 + 1).cast("int")).alias("map"), F.element_at(formats, (F.col("user_id") % 5 + 1).cast("int")).alias("format"), (v * 1.5).alias("psnr_db"), (v / 5).alias("ang_mean_deg"), (v * 1.5).alias("ang_p99_deg"), (v / 50).alias("mae"))
    return build.quality_gate(rows.join(F.broadcast(build.gate_bounds(config.threshold_dim(spark) if thresholds is None else thresholds)), ["map", "format"], "left"))


@query(_GATED)
def b12_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).select("event_id", "map", "format", "gate_ok")


@query("""select page_id as id, unnest([x for x in [case when coalesce(regexp_matches(url, '^https?://[a-z0-9.]+/[a-z]{2}/'), false) then null else {'rule': 'url', 'value': url} end,
 case when coalesce(strlen(html) >= 500, false) then null else {'rule': 'size', 'value': strlen(html)::varchar} end,
 case when coalesce(split_part(url, '/', 4) in ('en', 'fr'), false) then null else {'rule': 'profile', 'value': split_part(url, '/', 4)} end] if x is not null], recursive := true) from pages""")
def b13_validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = s.table(spark, sf_dir, "pages")
    profile = F.coalesce(F.try_element_at(F.split("url", "/"), F.lit(4)), F.lit(""))
    rules = {"url": (F.col("url").rlike("^https?://[a-z0-9.]+/[a-z]{2}/"), F.col("url")), "size": (F.octet_length("html") >= 500, F.octet_length("html")), "profile": (profile.isin("en", "fr"), profile)}
    return validate.validate_records(rows, "page_id", rules)


_TOOLS = "(select bool_or(path like 'tools/%') as full_sample from paths)"


@query(f"""select material, full_sample from (select distinct split_part(path, '/', 3) || '/' || split_part(path, '/', 4) as material from paths where path like 'raw/jak1/%' and len(string_split(path, '/')) >= 4
 union select regexp_replace(split_part(path, '/', 4) || '/' || split_part(path, '/', 5), '\\.json$', '') from paths where path like 'metadata/%' union select 'sample/one' from {_TOOLS} where full_sample) cross join {_TOOLS}""", "paths")
def b15_affected_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.affected_materials(s.paths(spark, sf_dir), spark.createDataFrame([("sample/one",)], "material string"))


_SHAPE = "n_chars::int + 1 as w, doc_id::int + 1 as h, (['8', '16'])[(doc_id // 4 % 2 + 1)::int]::int as depth, (doc_id // 8 % 4)::int as ctype"


@query(f"select doc_id, kind, case when kind = 'png' then w end as w, case when kind = 'png' then h end as h, case when kind = 'png' then depth end as depth, case when kind = 'png' then ctype end as ctype, kind <> 'png' as mislabeled, kind = 'png' and ctype = 3 as palette, kind = 'png' and depth = 16 as deep from (select doc_id, {_SHAPE}, case doc_id % 4 when 0 then 'unknown' when 1 then 'jpeg' else 'png' end as kind from documents)")
def b16_sniff_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of blobs that begin like a PNG, like a JPEG or with the document's text, and end with it."""
    c, doc = F.col, F.col("doc_id")

    def number(x: Column, digits: int) -> Column:
        return F.lpad(F.hex(x), digits, "0")

    depth, ctype = F.when(F.floor(doc / 4) % 2 == 0, 8).otherwise(16), F.floor(doc / 8).cast("long") % 4
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), number(c("n_chars") + 1, 8), number(doc + 1, 8), number(depth.cast("long"), 2), number(ctype, 2))
    head = F.unhex(F.when(doc % 4 == 0, "").when(doc % 4 == 1, "FFD8FFE0").otherwise(png))
    blobs = s.table(spark, sf_dir, "documents").select("doc_id", F.concat(head, F.coalesce("text", F.lit("")).cast("binary")).alias("content"))
    return validate.sniff_images(blobs).drop("content")


# Joins of the build.


@query("select mat, split_part(tpage, '-vis-', 1) as prefix, coalesce(cluster, 'overflow') as cluster from assets left join clusters on prefix = split_part(tpage, '-vis-', 1)", "assets", "clusters")
def c1_cluster_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.cluster_of(s.assets(spark, sf_dir).select("mat", "tpage"), s.clusters(spark)).select("mat", "prefix", "cluster")


@query(f"""select profile, map, format, channels, count(*) as n, max(gate_min)::double as gate_min, max(gate_max)::double as gate_max, max(gate_p99_max)::double as gate_p99_max from assets join {PROFILE_ROWS} using (map)
 left join (select semantic as map, format, max(case when bound = 'min' then value end) as gate_min, max(case when bound = 'max' then value end) as gate_max, max(case when bound = 'p99_max' then value end) as gate_p99_max from {THRESHOLD_ROWS} group by all) using (map, format) group by all""", "assets")
def c2_attach_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = s.assets(spark, sf_dir).select("mat", "map").crossJoin(F.broadcast(spark.createDataFrame([(p,) for p in config.PROFILES], "profile string")))
    rows = build.attach_policy(grid, config.profile_dim(spark), config.threshold_dim(spark))
    return rows.groupBy("profile", "map", "format", "channels").agg(F.count("*").alias("n"), *[F.max(c).alias(c) for c in ("gate_min", "gate_max", "gate_p99_max")])


_STORED = "25 + mat % 20::double as psnr_db, mat % 25::double as ang_mean_deg, mat % 120::double as ang_p99_deg, mat % 9 / 3::double as mae"
_CACHE = f"(select distinct cache_key, 1 + mat % 2 as stats_version, {_STORED} from ({_KEYED}) where mat % 3 = 0)"
_BOUNDS = f"(select semantic as map, format, max(case when bound = 'min' then value end) as gate_min, max(case when bound = 'max' then value end) as gate_max, max(case when bound = 'p99_max' then value end) as gate_p99_max from {THRESHOLD_ROWS} group by all)"


def _cache(keyed: DataFrame) -> DataFrame:
    mat = F.col("mat")
    stored = {"psnr_db": 25 + mat % 20, "ang_mean_deg": mat % 25, "ang_p99_deg": mat % 120, "mae": mat % 9 / 3}
    return keyed.filter("mat % 3 = 0").select("cache_key", (mat % 2 + 1).alias("stats_version"), *[x.cast("double").alias(n) for n, x in stored.items()]).distinct()


@query(
    f"""select mat, preset, profile, case when stats_version is null then 'miss' when stats_version <> 2 and map in ('normal', 'height') then 'stale_stats' else 'hit' end as status, psnr_db, mae,
 case when stats_version is null then null when map = 'albedo' then psnr_db >= coalesce(gate_min, 0) when map = 'normal' then ang_mean_deg <= coalesce(gate_max, 99) and ang_p99_deg <= coalesce(gate_p99_max, 999) else mae <= coalesce(gate_max, 255) end as gate_ok
 from ({_KEYED}) left join {_CACHE} using (cache_key) left join {_BOUNDS} using (map, format)""",
    "dims",
)
def c3_cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _keyed(spark, sf_dir)
    return build.cache_verdicts(keyed, _cache(keyed), config.threshold_dim(spark), 2).select("mat", "preset", "profile", "status", "psnr_db", "mae", "gate_ok")


@query(f"select mat, preset, profile, map from ({_KEYED}) where mat % 3 <> 0", "dims")
def c4_cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _keyed(spark, sf_dir)
    return build.cache_misses(keyed, _cache(keyed)).select("mat", "preset", "profile", "map")


@query(f"select event_id, profile, map, case when profile = 'android-astc' and map <> 'normal' then 'astc_4x4' end as fallback from ({_GATED}) cross join {values([(p,) for p in config.PROFILES], 'p', 'profile')} where not gate_ok")
def c5_override_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = _gated(spark, sf_dir).filter(~F.col("gate_ok")).select("event_id", "map").crossJoin(F.broadcast(spark.createDataFrame([(p,) for p in config.PROFILES], "profile string")))
    return build.override_proposals(failed, config.ladder_dim(spark)).select("event_id", "profile", "map", "fallback")


@query(f"select event_id, profile, map, case when profile = 'android-astc' and map <> 'normal' then 'astc_4x4' end as fallback from ({_GATED}) cross join {values([(p,) for p in config.PROFILES], 'p', 'profile')} where not gate_ok")
def c5_proposals_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds of the gate and the ladder are read from their document."""
    _, path = config_files(spark)
    failed = _gated(spark, sf_dir, config.threshold_file(spark, path)).filter(~F.col("gate_ok")).select("event_id", F.explode(F.array(*map(F.lit, config.PROFILES))).alias("profile"), "map")
    return build.override_proposals(failed, config.ladder_file(spark, path)).select("event_id", "profile", "map", "fallback")


@query("select d.doc_id as id, (case when l0.quality = 1 then 0 when l1.quality = 1 then 1 when l2.quality = 1 then 2 end)::int as pos, (case when l0.quality = 1 then l0.quality when l1.quality = 1 then l1.quality when l2.quality = 1 then l2.quality end)::int as value from documents d left join labels l0 on l0.doc_id = d.doc_id left join labels l1 on l1.doc_id = d.doc_id + 1 left join labels l2 on l2.doc_id = d.doc_id + 2")
def c8_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = s.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array(*[F.col("doc_id") + i for i in range(3)]).alias("candidates"))
    lookup = s.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("candidate"), F.col("quality").alias("value"))
    return dedup.first_match(entities, lookup, [1]).select("id", "pos", "value")


_VERDICTS = "(select doc_id, (['both', 'none', 'edge', 'horizontal', 'vertical', null])[(doc_id * 7 % 6 + 1)::int] as v from labels)"


@query(
    f"""select d.doc_id as id, case coalesce(case when l0.v <> 'edge' then l0.v end, case when l1.v <> 'edge' then l1.v end, case when l2.v <> 'edge' then l2.v end) when 'both' then 'repeat' when 'none' then 'clamp' when 'horizontal' then 'repeat_x' when 'vertical' then 'repeat_y' end as wrap_mode
 from documents d left join {_VERDICTS} l0 on l0.doc_id = d.doc_id left join {_VERDICTS} l1 on l1.doc_id = d.doc_id + 1 left join {_VERDICTS} l2 on l2.doc_id = d.doc_id + 2"""
)
def c8_wrap_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = s.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array(*[F.col("doc_id") + i for i in range(3)]).alias("candidates"))
    said = F.get(F.array(*map(F.lit, ("both", "none", "edge", "horizontal", "vertical", None))), (F.col("doc_id") * 7 % 6).cast("int"))
    return dedup.wrap_modes(entities, s.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("candidate"), said.alias("value")))


@query("select doc_id, doc_id - 7 as target from documents d where doc_id - 7 not in (select doc_id from labels)")
def c9_orphan_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = s.table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") - 7).alias("target"))
    return dedup.orphan_references(refs, s.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))).select("doc_id", "target")


@query("select mat as material, map from assets where mat in (select split_part(path, '/', 3) || '/' || split_part(path, '/', 4) from paths where path like 'raw/jak1/%' and len(string_split(path, '/')) >= 4 union select regexp_replace(split_part(path, '/', 4) || '/' || split_part(path, '/', 5), '\\.json$', '') from paths where path like 'metadata/%')", "assets", "paths")
def c10_affected_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    affected = build.affected_materials(s.paths(spark, sf_dir), spark.createDataFrame([("sample/one",)], "material string"))
    return build.affected_jobs(s.assets(spark, sf_dir).select(F.col("mat").alias("material"), "map"), affected)


# Deduplication.


_HASHES = "select placement, sha256(string_agg(sha, '' order by case map when 'albedo' then 0 when 'normal' then 1 when 'roughness' then 2 else 3 end)) as set_sha256 from asset_maps group by placement"
_ENTRIES = "select tp || '/d' || doc_id || '.png' as placement, first_value(tp || '/d' || doc_id) over (partition by lang order by doc_id) as canonical_id, coalesce(toxic, 0) = 1 as recale from (select d.doc_id, source || '-vis-' || lang as tp, lang, toxic from documents d left join labels using (doc_id))"
_DEDUP = f"""select case when canon then canonical_id else regexp_replace(first, '\\.png$', '') end as material, canonical_id, not canon as is_variant, recale, set_sha256, placements
 from (select canonical_id, set_sha256, min(placement) as first, bool_or(placement = canonical_id || '.png') as canon, bool_or(recale) as recale, list_sort(list(placement)) as placements from ({_ENTRIES}) join ({_HASHES}) using (placement) group by 1, 2)"""


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = s.documents(spark, sf_dir).select("doc_id", "lang", "mat").join(s.table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    least = docs.groupBy("lang").agg(F.min_by("mat", "doc_id").alias("canonical_id"))
    return docs.join(F.broadcast(least), "lang").select(F.concat("mat", F.lit(".png")).alias("placement"), "canonical_id", (F.coalesce("toxic", F.lit(0)) == 1).alias("recale"))


def _placed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _entries(spark, sf_dir), dedup.set_hash(s.asset_maps(spark, sf_dir))


@query(_HASHES, "asset_maps")
def d1_set_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.set_hash(s.asset_maps(spark, sf_dir))


@query("select placement, map as missing from asset_maps where doc_id % 11 = 0 and map = 'height'", "asset_maps")
def d2_incomplete_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    blobs = s.asset_maps(spark, sf_dir)
    return dedup.incomplete_sets(blobs.select("placement").distinct(), blobs.filter("not (doc_id % 11 = 0 and map = 'height')"))


@query(f"select material, canonical_id, is_variant, recale, set_sha256, len(placements)::int as n, array_to_string(placements, ',') as placements from ({_DEDUP})", "asset_maps")
def d3_dedup_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_materials(*_placed(spark, sf_dir)).select("material", "canonical_id", "is_variant", "recale", "set_sha256", F.size("placements").alias("n"), F.concat_ws(",", "placements").alias("placements"))


@query(f"select unnest(placements) as placement, material from ({_DEDUP})", "asset_maps")
def d4_placement_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.placement_map(*_placed(spark, sf_dir))


@query(f"select material, array_to_string(list_sort(list_distinct([split_part(p, '/', 1) for p in placements])), ',') as levels, case when is_variant then canonical_id end as variant_of, recale and is_variant as recale from ({_DEDUP})", "asset_maps")
def d5_material_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.material_levels(dedup.distinct_materials(*_placed(spark, sf_dir))).withColumn("levels", F.concat_ws(",", "levels"))


@query(f"select material, page, len(placements[page * 3 + 1 : page * 3 + 3])::int as n, array_to_string(placements[page * 3 + 1 : page * 3 + 3], ',') as placements from (select material, placements, unnest(range((len(placements) + 2) // 3)) as page from ({_DEDUP}))", "asset_maps")
def d3_placement_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = dedup.placement_pages(*_placed(spark, sf_dir), page=3)
    return pages.select("material", "page", F.size("placements").alias("n"), F.concat_ws(",", "placements").alias("placements"))


@query(f"select unnest(placements) as placement, material from ({_DEDUP})", "asset_maps")
def d4_paged_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.paged_placement_map(dedup.placement_pages(*_placed(spark, sf_dir)))


@query(f"select material, array_to_string(list_sort(list_distinct([split_part(p, '/', 1) for p in placements])), ',') as levels from ({_DEDUP})", "asset_maps")
def d5_paged_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.paged_levels(dedup.placement_pages(*_placed(spark, sf_dir))).withColumn("levels", F.concat_ws(",", "levels"))


@query(f"select sum(len(placements))::bigint as placements, count(*) as materials, count(*) filter (where not is_variant) as canonical, count(*) filter (where is_variant) as variants, count(distinct canonical_id) as canonical_ids from ({_DEDUP})", "asset_maps")
def d6_catalog_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.catalog_summary(dedup.distinct_materials(*_placed(spark, sf_dir)))


@query("select sha, min(mat) as mat, arg_min(doc_id, mat) as doc_id from assets group by sha", "assets")
def e5_representative_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.representative_member(s.assets(spark, sf_dir), ["sha"], "mat", ["doc_id"])


_VERDICT = f"""select mat, preset, profile, map, format, case when stats_version is null then 'miss' when stats_version <> 2 and map in ('normal', 'height') then 'stale_stats' else 'hit' end as status,
 case when stats_version is null then null when map = 'albedo' then psnr_db >= coalesce(gate_min, 0) when map = 'normal' then ang_mean_deg <= coalesce(gate_max, 99) and ang_p99_deg <= coalesce(gate_p99_max, 999) else mae <= coalesce(gate_max, 255) end as gate_ok
 from ({_KEYED}) left join {_CACHE} using (cache_key) left join {_BOUNDS} using (map, format)"""


def _outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a report tells of an output; the rest of its row isn't shuffled."""
    keyed = _keyed(spark, sf_dir)
    return build.cache_verdicts(keyed, _cache(keyed), config.threshold_dim(spark), 2).select("mat", "preset", "profile", "map", "format", "status", "gate_ok", *build.METRICS)


def _report(spark: SparkSession, outputs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    nothing = spark.createDataFrame([], "name string, game string, profile string, preset string, grp string, cluster string, part int, sha string, size long, entry_count long")
    return build.build_report(outputs, nothing, config.ladder_dim(spark))


@query(f"select profile, preset, count(*) as outputs, count(*) filter (where status = 'hit') as hits, count(*) filter (where not gate_ok) as failures from ({_VERDICT}) group by 1, 2", "dims")
def a8_build_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, _outputs(spark, sf_dir))[2]


@query(f"select mat, preset, profile, map, format, case when profile = 'android-astc' and map <> 'normal' then 'astc_4x4' end as fallback from ({_VERDICT}) where not gate_ok", "dims")
def a8_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, _outputs(spark, sf_dir))[0].select("mat", "preset", "profile", "map", "format", "fallback")


@query(f"select profile, preset, mat, map, format, case when profile = 'android-astc' and map <> 'normal' then 'astc_4x4' end as fallback from ({_VERDICT}) where not gate_ok and preset = 'low'", "dims")
def a8_written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failures of one preset, read back from its folder of the written report, whose parts are all made of one table of outputs."""
    path = s.scratch(spark, "report")
    build.write_report(*_report(spark, s.stored(_outputs(spark, sf_dir), "outputs")), path)
    rows = spark.read.schema("mat long, map string, format string, fallback string, profile string, preset string").json(f"{path}/failures")
    return rows.filter("preset = 'low'").select("profile", "preset", "mat", "map", "format", "fallback")


@query(f"select count(*) as records, count(wrap_mode) as wrap_modes, count(esrgan) as esrgan_dims, max(outputs) as outputs, max(hits) as hits, max(failures) as failures from (select wrap_mode, case when doc_id % 3 = 0 then 1 end as esrgan from ({MATERIALS_SQL})), (select count(*) as outputs, count(*) filter (where status = 'hit') as hits, count(*) filter (where not gate_ok) as failures from ({_VERDICT}))", "dims")
def d6_record_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = material_documents(spark, sf_dir).select(F.get_json_object("value", "$.wrap_mode").alias("wrap_mode"), F.when(F.col("doc_id") % 3 == 0, F.array(F.lit(1), F.lit(1))).alias("esrgan_dims"))
    keyed = _keyed(spark, sf_dir)
    return dedup.record_summary(records, build.cache_verdicts(keyed, _cache(keyed), config.threshold_dim(spark), 2))


@query(
    f"""select id, unnest([x for x in [case when doc_id % 10 = 0 then {{'rule': 'schema_version', 'value': null}} end, case when game not in ('jak1', 'jak2', 'jak3') then {{'rule': 'game', 'value': game}} end,
 case when wrap_mode = 'tile' then {{'rule': 'wrap_mode', 'value': wrap_mode}} end, case when h < 1 then {{'rule': 'master_dims', 'value': w || ',' || h}} end, case when not has_map then {{'rule': 'maps', 'value': ''}} end,
 case when has_map and colorspace = 'srgb' then {{'rule': 'colorspace', 'value': colorspace}} end, case when has_map and channels = 'x' then {{'rule': 'channels', 'value': channels}} end, case when has_map and source_sha256 = 'zz' then {{'rule': 'source_sha256', 'value': 'zz'}} end,
 case when doc_id % 17 = 0 then {{'rule': 'unknown', 'value': 'extra'}} end] if x is not null], recursive := true) from ({MATERIALS_SQL})"""
)
def b13_material_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = material_documents(spark, sf_dir).select("value", F.from_json("value", sources.MATERIAL).alias("m")).select("value", "m.*")
    return validate.validate_records(rows, "id", validate.material_rules())


@query(
    f"""select id, unnest([x for x in [case when doc_id % 16 = 0 then {{'rule': 'location', 'value': id}} end, case when has_map and colorspace = 'srgb' then {{'rule': 'maps.albedo.colorspace', 'value': colorspace}} end,
 case when has_map and channels = 'x' then {{'rule': 'maps.albedo.channels', 'value': channels}} end, case when has_map and source_sha256 = 'zz' then {{'rule': 'maps.albedo.source_sha256', 'value': 'zz'}} end] if x is not null], recursive := true) from ({MATERIALS_SQL})"""
)
def b13_material_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of each map by its path, and of the place of a record; some files lie elsewhere."""
    docs = material_documents(spark, sf_dir)
    rows = docs.select("doc_id", "value", F.from_json("value", sources.MATERIAL).alias("r")).select("doc_id", "value", "r.*")
    name = F.concat(F.regexp_extract("id", "/([^/]+/[^/]+)$", 1), F.when(F.col("doc_id") % 16 == 0, "x").otherwise(""))
    rows = rows.withColumn("file", F.concat(F.lit("file:///metadata/jak1/materials/"), name, F.lit(".json")))
    return validate.validate_records(rows, "id", validate.location_rule("jak1"), (validate.each_entry(F.col("maps"), "maps", validate.map_rules),))


@query(
    """select doc_id as id, unnest([x for x in [case when doc_id % 10 = 0 then {'rule': 'schema_version', 'value': '2'} end, case when doc_id % 6 = 0 then {'rule': 'asset_version', 'value': 'v1'} end, case when doc_id % 8 = 0 then {'rule': 'manifest_url', 'value': null} end,
 case when doc_id % 9 = 0 then {'rule': 'manifest_sha256', 'value': 'zz'} end, case when doc_id % 11 = 0 then {'rule': 'required', 'value': null} end, case when doc_id % 13 = 0 then {'rule': 'unknown', 'value': 'extra'} end] if x is not null], recursive := true) from documents"""
)
def b13_lock_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lock file for each document; some break the schema."""
    doc = F.col("doc_id")
    record = F.struct(
        F.when(doc % 10 == 0, 2).otherwise(1).alias("schema_version"), F.when(doc % 6 == 0, "v1").otherwise("assets-v1.0.2").alias("asset_version"), F.when(doc % 8 != 0, "https://assets.example/m.json").alias("manifest_url"),
        F.when(doc % 9 == 0, "zz").otherwise(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("manifest_sha256"), F.when(doc % 11 != 0, True).alias("required"), F.when(doc % 13 == 0, 1).alias("extra"),
    )
    rows = s.table(spark, sf_dir, "documents").select("doc_id", F.to_json(record).alias("value"))
    rows = rows.select("doc_id", "value", F.from_json("value", validate.LOCK).alias("r")).select("doc_id", "value", "r.*")
    return validate.validate_records(rows, "doc_id", validate.lock_rules())


_HEADER_FAULTS = [
    ("schema_version", "'2'", "m % 5 = 0"), ("games", "case when m % 6 = 0 then '' else 'jak9' end", "m % 6 = 0 or m % 7 = 0"), ("engine_compat.min_loader_version", "'0'", "m % 4 = 0"), ("engine_compat.unknown", "'x'", "m % 9 = 0"), ("presets", "'low,ultra'", "m % 3 = 0"),
]
_SHARD_FAULTS = [("name", "'bad'", 11), ("group", "'mask'", 13), ("cluster", "null", 17), ("size", "'0'", 19), ("unknown", "'y'", 23)]


@query(
    "with numbered as (select page_id // 10 as m, page_id, row_number() over (partition by page_id // 10 order by page_id) - 1 as i from pages), heads as (select distinct m from numbered) "
    + " union all ".join([f"select m as id, '{r}' as rule, {v} as value from heads where {w}" for r, v, w in _HEADER_FAULTS] + [f"select m, 'shards[' || i || '].{r}', {v} from numbered where page_id % {k} = 0" for r, v, k in _SHARD_FAULTS])
)
def b13_manifest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest for each ten pages; some headers and some shards in them break the schema."""
    page, m, c = F.col("page_id"), F.col("m"), F.col
    sha = F.sha2(F.coalesce("html", F.lit("")), 256)
    shard = F.struct(
        F.when(page % 11 == 0, "bad").otherwise(F.concat(F.lit("jak1-pc-bc-low-albedo-shard-c1-"), F.substring(sha, 1, 12), F.lit(".rpack"))).alias("name"), F.lit("jak1").alias("game"), F.lit("pc-bc").alias("profile"), F.lit("low").alias("preset"),
        F.when(page % 13 == 0, "mask").otherwise("albedo").alias("group"), F.when(page % 17 != 0, "c1").alias("cluster"), sha.alias("sha256"), F.when(page % 19 == 0, 0).otherwise(F.octet_length("html") + 1).alias("size"), F.lit("https://assets.example/u").alias("url"),
        F.lit(1).alias("entry_count"), F.when(page % 23 == 0, 1).alias("y"),
    )
    groups = s.table(spark, sf_dir, "pages").select(F.floor(page / 10).alias("m"), F.struct("page_id", shard.alias("shard")).alias("x")).groupBy("m").agg(F.array_sort(F.collect_list("x")).alias("x"))
    compat = F.struct(F.lit("0.9.0").alias("min_recharged_version"), F.when(m % 4 == 0, 0).otherwise(2).alias("min_loader_version"), F.when(m % 9 == 0, 1).alias("x"))
    games = F.when(m % 6 == 0, F.array().cast("array<string>")).when(m % 7 == 0, F.array(F.lit("jak9"))).otherwise(F.array(F.lit("jak1")))
    document = F.struct(
        F.when(m % 5 == 0, 2).otherwise(1).alias("schema_version"), F.lit("assets-v1.0.0").alias("asset_version"), games.alias("games"), compat.alias("engine_compat"), F.array(F.lit("pc-bc")).alias("profiles"),
        F.when(m % 3 == 0, F.array(F.lit("low"), F.lit("ultra"))).otherwise(F.array(F.lit("low"))).alias("presets"), F.transform("x", lambda x: x["shard"]).alias("shards"),
    )
    rows = groups.select("m", F.to_json(document).alias("value"))
    rows = rows.select(c("m"), "value", F.from_json("value", validate.MANIFEST).alias("r")).select("m", "value", "r.*")
    return validate.validate_records(rows, "m", validate.manifest_rules(), validate.manifest_items())
