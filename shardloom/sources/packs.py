"""Indexed binary packs: a header, payloads aligned to 16 bytes, a canonical JSON index and a trailer with its hash prefix.

Writing cuts a family, in the order of its keys, into parts of about ``max_bytes`` of payload and index; the maps
of a key stay together. A pack is one part: it exceeds ``max_bytes`` by no more than its last key's entries and a
frame of fixed size. Where the cuts lie is found from keys and sizes alone. Some of the cuts are the bounds of ranges, to which entries and cuts are
dealt together, so payloads are shuffled once; a task merges both in order and builds one pack after the other. Each is a ``.rpack`` file, named by its family and
the hash of its bytes, which the task writes to the shared folder; so its bytes travel no further, and a task that runs again writes the same file.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry
from ..functions.keys import GROUPS
from ..operators.shards import bounds_of, pack_layout, range_of
from .batches import arrow_batches
from .files import Folder, chunks, list_files
from .scratch import scratch

HEADER, TRAILER = 16, 24
MAX_BYTES = 16 << 20
#: An index record has less than this besides its key and what is given of it, of which JSON makes at most six bytes from one.
RECORD = 256
STATS = "struct<height_lambda_tiles:double,height_mean:double,height_norm:double,normal_dc_x:double,normal_dc_y:double>"
ENTRY = f"struct<alpha_mode:string,channels:string,colorspace:string,format:string,height:int,id:string,key:string,map:string,mip_levels:int,offset:bigint,sha256:string,size:bigint,stats:{STATS},width:int,wrap_mode:string>"


def pack_bytes(family: dict[str, str], entries: list[tuple[str, str, bytes]], records: list[dict] | None = None) -> bytes:
    """One pack of (key, map, payload) entries, each with the other fields of its record; the order given doesn't matter."""
    if not entries:
        raise ValueError("a pack has at least one entry")
    out, index = bytearray(b"RPK1" + struct.pack("<III", 1, len(entries), 0)), []
    for (key, kind, payload), more in sorted(zip(entries, records or [{}] * len(entries), strict=True), key=lambda e: e[0][:2]):
        if kind not in GROUPS or not payload:
            raise ValueError(f"{key}: unknown map {kind}" if payload else f"{key} ({kind}): empty payload")
        out += bytes(-len(out) % 16)
        index.append(more | {"key": key, "map": kind, "offset": len(out), "sha256": hashlib.sha256(payload).hexdigest(), "size": len(payload)})
        out += payload
    text = json.dumps({"schema_version": 1, **family, "entries": index}, sort_keys=True, separators=(",", ":")).encode()
    return bytes(out) + text + struct.pack("<QQ", len(out), len(text)) + hashlib.sha256(text).digest()[:4] + b"RIDX"


def pack_cuts(entries: DataFrame, family: list[str], max_bytes: int) -> DataFrame:
    """family columns, key, cut, base: the first key of each part of a family; ``base`` is where the part begins in the layout of the whole family.

    Only keys and sizes are sorted, from a table of them; payloads are read for it once, or not at all where ``size`` is a column; there is one row for some ``max_bytes`` of input.
    """
    spark = entries.sparkSession
    size = F.col("size") if "size" in entries.columns else F.octet_length("payload")
    sizes = entries.select(*family, "key", "map", size.cast("long").alias("size"), F.coalesce(F.octet_length("record"), F.lit(0)).alias("more"))
    weight = geometry.align16(F.col("size")) + 6 * F.octet_length("key") + F.col("more") + RECORD
    table = scratch(spark, "pack-sizes")
    sizes.write.parquet(table)
    laid = pack_layout(spark.read.schema(sizes.schema).parquet(table), family, ["key", "map"], before=weight)
    starts = laid.groupBy(*family, "key").agg(F.min("before").alias("before"), F.min("offset").alias("base"))
    starts = starts.groupBy(*family, F.floor(F.col("before") / max_bytes).alias("slot")).agg(F.min("key").alias("key"), F.min("base").alias("base"))
    turn = Window.partitionBy(*family).orderBy("slot")
    path = scratch(spark, "pack-cuts")
    starts.select(*family, "key", (F.row_number().over(turn) - 1).alias("cut"), F.col("base").cast("long").alias("base")).write.parquet(path)
    return spark.read.parquet(path)


#: Columns of a family that say where in it a pack lies, and are no part of its index.
PLACES = ("parts", "part")


def stem_of(one: dict[str, str], cut: int) -> str:
    """A pack's name up to its hash: that of a shard where the family is a shard's."""
    if {"game", "profile", "preset", "grp", "cluster"} <= set(one):
        many = f"-p{one['part']}" if int(one.get("parts") or 1) > 1 else ""
        return "-".join([one["game"], one["profile"], one["preset"], one["grp"], "shard", one["cluster"]]) + many
    return "-".join([*one.values(), f"p{cut}"]).replace("/", "-")


def refused_entries(entries: DataFrame) -> DataFrame:
    """key, map, reason of the rows that no pack can hold; writing stops at the first of them."""
    reason = F.when(F.col("key").isNull(), "no key").when(F.col("payload").isNull() | (F.octet_length("payload") == 0), "empty payload").when(F.col("map").isNull() | ~F.col("map").isin(list(GROUPS)), "unknown map")
    return entries.select("key", "map", reason.alias("reason")).filter("reason is not null")


def squeezed(entries: DataFrame) -> DataFrame:
    """Entries with compressed payloads, for the way through the shuffle."""

    at = entries.columns.index("payload")

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            columns = batch.columns
            columns[at] = pa.array([small.compress(p) for p in columns[at].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return entries.mapInArrow(squeeze, entries.schema)


def merged_stream(entries: DataFrame, cuts: DataFrame, family: list[str]) -> DataFrame:
    """Entries, their payloads compressed, and cuts in order, each cut before its entries, in ranges that begin with a cut: one shuffle of the entries.

    Cuts are as heavy as each other, so ranges bounded by evenly chosen cuts are; there are as many as shuffle partitions, which a deployment sizes.
    """
    place = [*family, "key"]
    n = max(1, int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = bounds_of(cuts, place, n)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("map", "string"), ("payload", "binary"), ("record", "string"))]
    rows = squeezed(entries.select(*place, "map", "payload", "record")).select("*", F.lit(1).alias("mark"), F.lit(None).cast("int").alias("cut"), F.lit(None).cast("long").alias("base"))
    every = rows.unionByName(cuts.select(*place, *nothing, F.lit(0).alias("mark"), "cut", "base"))
    # An entry before the first bound belongs to range 0, as do the cuts there; bounds are first keys, so no part crosses one.
    dealt = every.withColumn("_range", range_of(place, bounds, cuts)).repartitionById(n, "_range")
    return dealt.sortWithinPartitions(*place, "mark", "map").drop("_range")


def build_packs(entries: DataFrame, family: list[str], max_bytes: int = MAX_BYTES, folder: str | None = None) -> DataFrame:
    """family columns, cut, base, name, entry_count, sha256, size, content: one row per pack of the rows (family, key, map, payload; record and size, the payload's bytes, if any).

    With a ``folder`` (a URI that every executor reaches) the task writes the pack there, and content is null.
    """
    if "record" not in entries.columns:
        entries = entries.withColumn("record", F.lit(None).cast("string"))
    bad = F.col("payload").isNull() | (F.octet_length("payload") == 0) | F.col("key").isNull() | F.col("map").isNull() | ~F.col("map").isin(list(GROUPS))
    checked = entries.withColumn("payload", F.when(bad, F.raise_error(F.concat(F.lit("can't pack "), F.coalesce("key", F.lit("a null key")))).cast("binary")).otherwise(F.col("payload").cast("binary")))
    size = [F.col("size")] if "size" in entries.columns else []
    checked = checked.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in family], "key", "map", "payload", "record", *size)
    fields = [(c, pa.string()) for c in family] + [("cut", pa.int32()), ("base", pa.int64()), ("name", pa.string()), ("entry_count", pa.int32()), ("sha256", pa.string()), ("size", pa.int64()), ("content", pa.binary())]

    def pack(place: list, cut: int, base: int, held: list[tuple]) -> pa.RecordBatch:
        one = dict(zip(family, place, strict=True))
        index = {"group" if c == "grp" else c: v for c, v in one.items() if c not in PLACES}
        content = pack_bytes(index, [h[:3] for h in held], [json.loads(h[3]) if h[3] else {} for h in held])
        digest = hashlib.sha256(content).hexdigest()
        name = f"{stem_of(one, cut)}-{digest[:12]}.rpack"
        if folder:
            with Folder(folder).create(name) as f:
                f.write(content)
        row = one | {"cut": cut, "base": base, "name": name, "entry_count": len(held), "sha256": digest, "size": len(content), "content": None if folder else content}
        return pa.RecordBatch.from_pylist([row], schema=pa.schema(fields))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, k, whole = None, [], len(family), zstandard.ZstdDecompressor()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[k + 4] == 0:
                    if held:
                        yield pack(*at, held)
                    at, held = (row[:k], row[k + 5], row[k + 6]), []
                else:
                    held.append((*row[k : k + 2], whole.decompress(row[k + 2]), row[k + 3]))
        if held:
            yield pack(*at, held)

    stream = merged_stream(checked, pack_cuts(checked, family, max_bytes), family)
    schema = ", ".join(f"{c} string" for c in family) + ", cut int, base long, name string, entry_count int, sha256 string, size long, content binary"
    return stream.mapInArrow(build, schema)


def write_packs(entries: DataFrame, family: list[str], folder: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Write a ``.rpack`` file for each pack into the folder of this URI; returns the list of packs, which is kept as a table below ``_packs`` in it."""
    Folder(folder).make()
    path = f"{folder}/_packs"
    with arrow_batches(entries.sparkSession, 1000, max_bytes):
        build_packs(entries, family, max_bytes, folder).drop("content").write.parquet(path)
    return entries.sparkSession.read.parquet(path)


def read_index(file) -> tuple[str | None, str | None]:
    """(index as JSON, error) of a pack that can be sought in: header, trailer and index are read, payloads aren't.

    Magics, version, bounds, hash prefix and entry count are checked.
    """
    size = file.size()
    if size < HEADER + TRAILER:
        return None, "too small"
    file.seek(0)
    head = file.read(HEADER)
    if head[:4] != b"RPK1":
        return None, "bad header magic"
    version, count, _ = struct.unpack("<III", head[4:])
    if version != 1:
        return None, "unknown version"
    file.seek(size - TRAILER)
    tail = file.read(TRAILER)
    if tail[-4:] != b"RIDX":
        return None, "bad trailer magic"
    at, length = struct.unpack("<QQ", tail[:16])
    if at + length > size - TRAILER:
        return None, "index out of bounds"
    file.seek(at)
    index = file.read(length)
    if hashlib.sha256(index).digest()[:4] != tail[16:20]:
        return None, "index hash differs"
    if len(json.loads(index)["entries"]) != count:
        return None, "entry count differs"
    return index.decode(), None


def parse_pack(content: bytes) -> tuple[str | None, str | None]:
    """``read_index`` of a pack in memory."""
    return read_index(pa.BufferReader(content))


HEADER_FIELDS = ("schema_version", "game", "profile", "preset", "group", "cluster")


def scan_packs(packs: DataFrame, name: str = "name") -> DataFrame:
    """pack, error, its header columns and one row per index entry of rows (name, content); a broken pack has one row with its error."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [parse_pack(bytes(c)) for c in frame["content"]]
            yield pd.DataFrame({"pack": frame["pack"], "index": [g[0] for g in got], "error": [g[1] for g in got]})

    schema = f"struct<schema_version:int,game:string,profile:string,preset:string,`group`:string,cluster:string,entries:array<{ENTRY}>>"
    rows = packs.select(F.col(name).cast("string").alias("pack"), "content").mapInPandas(parse, "pack string, index string, error string")
    rows = rows.withColumn("i", F.from_json("index", schema))
    return rows.select("pack", "error", *[F.col("i")[c].alias(c) for c in HEADER_FIELDS], F.explode_outer("i.entries").alias("e")).select("pack", "error", *HEADER_FIELDS, "e.*")


def scan_pack_files(spark: SparkSession, path: str) -> DataFrame:
    """``scan_packs`` of the pack files below a folder, by a data source that reads their indexes alone; filters on pack, key and map are pushed down to it."""
    from .pack_source import PackSource

    spark.dataSource.register(PackSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("rpack").option("splits", 4 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))).load(path)


def check_file(file) -> tuple[str, str | None, list[tuple[str, str, str]]]:
    """(sha256 of the whole file, structural error, (key, map, reason) of entries that are wrong), from one pass over it a chunk at a time."""
    text, error = read_index(file)
    entries = [] if text is None else sorted(json.loads(text)["entries"], key=lambda e: e["offset"])
    end, whole, wrong, size = HEADER, hashlib.sha256(), [], file.size()
    file.seek(0)
    at = 0
    for e in entries:
        start, length = e["offset"], e["size"]
        if start % 16 or start < end or length < 0 or start + length > size:
            wrong.append((e["key"], e["map"], "misaligned" if start % 16 else "overlapping" if 0 <= start < end else "cut short"))
            continue
        for piece in chunks(file, start - at):
            whole.update(piece)
        own = hashlib.sha256()
        for piece in chunks(file, length):
            whole.update(piece)
            own.update(piece)
        at = end = start + length
        if own.hexdigest() != e["sha256"]:
            wrong.append((e["key"], e["map"], "altered"))
    for piece in chunks(file):
        whole.update(piece)
    return whole.hexdigest(), error, wrong


CHECKED = "pack string, size long, sha256 string, key string, map string, reason string"


def verify_pack_files(spark: SparkSession, path: str, manifest: DataFrame | None = None) -> DataFrame:
    """pack, key, map, reason: every fault of the pack files below a folder, each file read once as a stream.

    Entries can be misaligned, overlapping, cut short or altered, a pack's frame broken. With a manifest (name, sha256, size), both sides are compared:
    listed packs without a file are ``missing``, files that aren't listed ``unlisted``, and others ``short``, ``long`` or ``altered`` as a whole (key and map null).
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Folder(path)
        for batch in batches:
            out = []
            for file, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with folder.open(file) as f:
                    digest, error, wrong = check_file(f)
                name = file.rsplit("/", 1)[1]
                out += [(name, size, digest, None, None, error), *((name, None, None, *x) for x in wrong)]
            columns = zip(*out, strict=True) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 1 else pa.string()) for i, c in enumerate(columns)], names=[x.split()[0] for x in CHECKED.split(", ")])

    table = scratch(spark, "pack-checks")
    list_files(spark, path, "*.rpack").mapInArrow(check, CHECKED).write.parquet(table)
    found = spark.read.parquet(table)
    entries = found.filter("size is null").select("pack", "key", "map", "reason")
    files = found.filter("size is not null").select("pack", F.col("size").alias("held"), F.col("sha256").alias("digest"), "reason")
    if manifest is not None:
        both = files.join(manifest.select(F.col("name").alias("pack"), F.col("size").alias("listed"), F.col("sha256").alias("wanted"), F.lit(True).alias("is_listed")), "pack", "full_outer")
        whole = F.when(F.col("held").isNull(), "missing").when(F.col("is_listed").isNull(), "unlisted").when(F.col("held") < F.col("listed"), "short").when(F.col("held") > F.col("listed"), "long").when(~F.col("digest").eqNullSafe(F.col("wanted")), "altered")
        files = both.withColumn("reason", F.coalesce(whole, "reason"))
    nothing = F.lit(None).cast("string")
    return entries.unionByName(files.filter("reason is not null").select("pack", nothing.alias("key"), nothing.alias("map"), "reason"))


def verify_packs(packs: DataFrame) -> DataFrame:
    """pack, key, map, reason of rows (name, content): entries that are misaligned, overlapping, cut short or altered, and broken packs."""

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, content in zip(frame["pack"], frame["content"], strict=True):
                _, error, wrong = check_file(pa.BufferReader(bytes(content)))
                out += [(name, None, None, error)] if error else [(name, *x) for x in wrong]
            yield pd.DataFrame(out, columns=["pack", "key", "map", "reason"])

    return packs.select(F.col("name").cast("string").alias("pack"), "content").mapInPandas(check, "pack string, key string, map string, reason string")
