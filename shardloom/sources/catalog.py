"""Readers and writers of the catalog's JSON documents and blobs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import can_stream, hash_files, list_files, write_files
from .scratch import scratch

MATERIAL = (
    "schema_version int, id string, game string, original struct<tpage_name:string,texture_name:string,dims:array<int>,has_alpha:boolean>, esrgan_dims array<int>, "
    "master_dims array<int>, wrap_mode string, alpha_mode string, required boolean, levels array<string>, variant_of string, recale boolean, derived boolean, "
    "maps map<string,struct<colorspace:string,channels:string,source_sha256:string>>, format_overrides map<string,map<string,string>>, mip_policy struct<height_reduction:string,min_mip_size:int>"
)


def read_materials(spark: SparkSession, root: str, lines: bool = False, glob: str = "*.json") -> DataFrame:
    """One typed row per JSON document below ``root``, with the file it came from; a document to a file, or to a line with ``lines``."""
    rows = spark.read.schema(MATERIAL).option("multiLine", not lines).option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(root)
    return rows.withColumn("file", F.col("_metadata.file_path"))


def exploded_map(text: Column, value: str) -> Column:
    """Entries of a JSON object given as text."""
    return F.explode(F.from_json(text, f"map<string,{value}>"))


def read_placements(spark: SparkSession, path: str) -> DataFrame:
    """placement, material of a file holding ``{"placements": {...}}`` or the bare object."""
    text = spark.read.text(path, wholetext=True)
    inner = F.coalesce(F.get_json_object("value", "$.placements"), F.col("value"))
    return text.select(exploded_map(inner, "string").alias("placement", "material"))


def read_source_manifest(spark: SparkSession, path: str, field: str = "entrees") -> DataFrame:
    """placement, canonical_id, recale (false where absent) of a source manifest."""
    text = spark.read.text(path, wholetext=True)
    return source_entries(text.select(F.get_json_object("value", f"$.{field}").alias("value")))


def source_entries(text: DataFrame) -> DataFrame:
    rows = text.select(exploded_map(F.col("value"), "struct<id:string,recale:boolean>").alias("placement", "e"))
    return rows.select("placement", F.col("e.id").alias("canonical_id"), F.coalesce("e.recale", F.lit(False)).alias("recale"))


def scan_blobs(spark: SparkSession, root: str, glob: str = "*.png") -> DataFrame:
    """tpage, name, map_kind, sha256, size of every blob.

    Spark lists the files; a task hashes each as a stream, whatever its size. Where the workers can't open the root's scheme,
    Spark's reader of whole files is used, which takes files of up to 2 GB.
    """
    at = r"(?:[^/=]+=)?([^/]+)/(?:[^/=]+=)?([^/]+)/([^/]+)\.[a-z]+$"  # folders may be named column=value
    if can_stream(root):
        hashed = hash_files(list_files(spark, root, glob), root)
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
        hashed = files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))
    return hashed.select(*[F.regexp_extract("path", at, i).alias(n) for i, n in enumerate(("tpage", "name", "map_kind"), 1)], "sha256", "size")


def write_blobs(blobs: DataFrame, root: str, ending: str = "png") -> None:
    """A file tpage/name/map_kind.ending for each row (tpage, name, map_kind, content).

    Tasks write them as they come. Where the workers can't open the root's scheme, Spark's writer of text does: contents are lines there, kinds are lost, and the ending is txt.
    """
    if can_stream(root):
        path = F.concat("tpage", F.lit("/"), "name", F.lit("/"), "map_kind", F.lit(f".{ending}"))
        write_files(blobs.select(path.alias("path"), "content"), root)
    else:
        blobs.select("tpage", "name", F.regexp_replace("content", "\\n$", "")).repartition("tpage", "name").write.partitionBy("tpage", "name").text(root)


def parse_pointer(text: Column) -> list[Column]:
    """oid and size of a large-file pointer text."""
    return [F.regexp_extract(text, r"oid sha256:([0-9a-f]{64})", 1).alias("oid"), F.regexp_extract(text, r"(?m)^size (\d+)$", 1).cast("long").alias("size")]


def scan_lfs_pointers(spark: SparkSession, root: str) -> DataFrame:
    """material, map_kind, oid, size of every pointer file below ``root``."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.png").text(root, wholetext=True)
    path, at = F.col("_metadata.file_path"), r"([^/]+/[^/]+)/([^/]+)\.png$"
    return text.select(F.regexp_extract(path, at, 1).alias("material"), F.regexp_extract(path, at, 2).alias("map_kind"), *parse_pointer(F.col("value")))


def lock_digest(pointers: DataFrame) -> DataFrame:
    """One hash over all oids in order, the key of a build cache, and the number of pointers; null oids are counted but not hashed.

    A hash of a sequence is one task's work; the oids, 64 bytes a file, reach it as a sorted stream, and it holds one batch of them.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, n, joined = hashlib.sha256(), 0, b""
        for batch in batches:
            n += pc.sum(batch.column(1)).as_py() or 0
            for oid in batch.column(0).drop_null().to_pylist():
                state.update(joined + oid.encode())
                joined = b"\n"
        yield pa.RecordBatch.from_arrays([pa.array([state.hexdigest()]), pa.array([n], pa.int64())], names=["digest", "n"])

    nothing = pointers.sparkSession.range(1).select(F.lit(None).cast("string").alias("oid"), F.lit(0).alias("one"))  # so that an empty table has its digest
    rows = pointers.select("oid", F.lit(1).alias("one")).unionByName(nothing)
    return rows.repartition(1).sortWithinPartitions("oid").mapInArrow(digest, "digest string, n long")


def lock_tree(pointers: DataFrame, digits: int = 3) -> DataFrame:
    """The key of a build cache as a hash of hashes, and the number of pointers: oids are hashed in order by their first ``digits``, and these digests in order.

    Oids are even, so each of the 16 ** digits parts is a sorted stream of its share; no task sees all of them. Null oids are counted but not hashed.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, n, out = None, None, 0, []

        def done() -> None:
            if n:
                out.append((now, None if state is None else state.hexdigest(), n))

        for batch in batches:
            for part, oid in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part != now:
                    done()
                    now, state, n = part, None, 0
                n += 1
                if oid is not None:
                    state, joint = (hashlib.sha256(), b"") if state is None else (state, b"\n")
                    state.update(joint + oid.encode())
        done()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["part", "digest", "n"])

    parts = pointers.select(F.coalesce(F.substring("oid", 1, digits), F.lit("")).alias("part"), "oid").repartition("part").sortWithinPartitions("part", "oid")
    known = F.filter(F.array_sort(F.collect_list(F.struct("part", "digest"))), lambda x: x["digest"].isNotNull())  # 16 ** digits digests
    digests = F.array_join(F.transform(known, lambda x: x["digest"]), "\n")
    return parts.mapInArrow(digest, "part string, digest string, n long").agg(F.sha2(digests, 256).alias("digest"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def upsert_metadata(derived: DataFrame, existing: DataFrame) -> DataFrame:
    """Derived records, but hand-edited ones (``derived`` false) as they are."""
    kept = existing.filter(~F.coalesce("derived", F.lit(True)))
    return kept.unionByName(derived.join(kept.select("id"), "id", "left_anti"))


def write_metadata(records: DataFrame, path: str) -> None:
    """Records as JSON, in a folder for each tpage, the first part of an id behind the game."""
    with_tpage(records).write.partitionBy("tpage").json(path)


def with_tpage(records: DataFrame) -> DataFrame:
    return records.withColumn("tpage", F.substring_index("id", "/", 1))


def read_metadata(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema + ", tpage string").json(path)


def upsert_written(derived: DataFrame, path: str, schema: str) -> None:
    """Put derived records into the folder of written ones: hand-edited records stay, others of the same id are replaced, new ones come in.

    Only folders of tpages that the derived records have are read for it and overwritten; those of others aren't touched. The new rows are in
    the shared scratch folder before the first old one goes.
    """
    spark = derived.sparkSession
    new = with_tpage(derived)
    existing = read_metadata(spark, path, schema).join(new.select("tpage").distinct(), "tpage", "left_semi")
    same = existing.join(new.select("id"), "id", "left_anti").unionByName(existing.join(new.select("id"), "id", "left_semi").filter(~F.coalesce("derived", F.lit(True))))
    rows = same.unionByName(new.join(existing.filter(~F.coalesce("derived", F.lit(True))).select("id"), "id", "left_anti"), allowMissingColumns=True)
    held = scratch(spark, "upsert")
    rows.write.parquet(held)
    spark.read.parquet(held).repartition("tpage").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tpage").json(path)
