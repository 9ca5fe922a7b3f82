"""Packs as files: written in one shuffle, read by seeks, verified as streams; blobs hashed as streams."""

import hashlib
import io
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shardloom.sources import catalog, files, pack_source, packs
from shardloom.sources.batches import SETTINGS


def entries(n, seed=1, families=("hot", "hot", "hot", "cold", "a/b")):
    pick = random.Random(seed)
    return [(pick.choice(families), f"k{i:04}", m, bytes(pick.randrange(256) for _ in range(pick.randint(1, 400)))) for i in range(n) for m in pick.sample(["albedo", "height", "normal"], pick.randint(1, 3))]


def frame(spark, rows):
    return spark.createDataFrame([(*r[:3], bytearray(r[3])) for r in rows], "fam string, key string, map string, payload binary")


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder, rows = f"file://{tmp_path_factory.mktemp('packs')}/out", entries(120)
    before = [spark.conf.get(x) for x in SETTINGS]
    listed = packs.write_packs(frame(spark, rows), ["fam"], folder, 6000)
    assert [spark.conf.get(x) for x in SETTINGS] == before  # batches are bounded for the write alone
    return folder, rows, listed


def test_packs_hold_every_entry_once(spark, written):
    folder, rows, listed = written
    got = {(r["pack"], r["key"], r["map"]): r["sha256"] for r in packs.scan_pack_files(spark, folder).collect()}
    fam = {r["name"]: r["fam"] for r in listed.collect()}
    assert {(fam[p], k, m): h for (p, k, m), h in got.items()} == {(f, k, m): hashlib.sha256(b).hexdigest() for f, k, m, b in rows}
    assert len(got) == len(rows)
    assert listed.count() > 8 and listed.agg(F.max("size")).first()[0] < 6000 + 3 * (400 + 16 + 24 + packs.RECORD)
    keys = listed.join(packs.scan_pack_files(spark, folder).select(F.col("pack").alias("name"), "key"), "name")
    assert keys.groupBy("fam", "key").agg(F.count_distinct("name").alias("n")).filter("n > 1").count() == 0


def test_packs_are_the_same_whatever_the_order_and_partitioning(spark, written, tmp_path):
    _, rows, listed = written
    mixed = random.Random(2).sample(rows, len(rows))
    again = packs.write_packs(frame(spark, mixed).repartition(7), ["fam"], f"file://{tmp_path}/again", 6000)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in listed.collect()}


def test_payloads_are_shuffled_once(spark, tmp_path):
    rows = frame(spark, entries(40))
    plan = packs.build_packs(rows, ["fam"], 4000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "BroadcastExchange" not in plan and "payload" in plan


class Counting(io.BytesIO):
    """A file that counts the bytes that are read from it."""

    def __init__(self, content):
        super().__init__(content)
        self.n, self.length = 0, len(content)

    def size(self):
        return self.length

    def read(self, n=-1):
        got = super().read(n)
        self.n += len(got)
        return got


def test_an_index_is_read_without_the_payloads():
    content = packs.pack_bytes({"game": "g"}, [("a", "albedo", b"x" * 5_000_000), ("b", "height", b"y" * 3_000_000)])
    file = Counting(content)
    text, error = packs.read_index(file)
    assert error is None and file.n == packs.HEADER + packs.TRAILER + len(text)
    assert [e["key"] for e in json.loads(text)["entries"]] == ["a", "b"]


def test_filters_on_pack_key_and_map_reach_the_source(spark, written):
    folder, rows, _ = written
    scan = packs.scan_pack_files(spark, folder)
    _, key, kind, payload = rows[5]
    one = scan.filter((F.col("key") == key) & (F.col("map") == kind))
    assert [r["sha256"] for r in one.collect()] == [hashlib.sha256(payload).hexdigest()]
    reader = pack_source.PackReader({"path": folder, "splits": "3"})
    pack = one.first()["pack"]
    left = list(reader.pushFilters([pack_source.EqualTo(("key",), key), pack_source.In(("map",), (kind, "mask")), pack_source.EqualTo(("pack",), pack), pack_source.EqualTo(("size",), 3)]))
    assert [f.attribute for f in left] == [("size",)]
    parts = reader.partitions()
    assert sum(len(p.paths) for p in parts) == 1
    assert [b.num_rows for p in parts for b in reader.read(p)] == [1]
    assert len(pack_source.PackReader({"path": folder, "splits": "3"}).partitions()) == 3
    assert scan.filter("key = 'nowhere'").count() == 0


def test_broken_packs_have_a_row_with_their_error(spark, tmp_path):
    good = packs.pack_bytes({"game": "g"}, [("a", "albedo", b"q" * 40)])
    cases = {"good": good, "magic": b"X" + good[1:], "short": good[:-1], "tiny": b"RPK1", "index": good[:-40] + bytes([good[-40] ^ 1]) + good[-39:]}
    for name, content in cases.items():
        (tmp_path / f"{name}.rpack").write_bytes(content)
    got = {r["pack"]: (r["error"], r["key"]) for r in packs.scan_pack_files(spark, f"file://{tmp_path}").collect()}
    assert got == {"good.rpack": (None, "a"), "magic.rpack": ("bad header magic", None), "short.rpack": ("bad trailer magic", None), "tiny.rpack": ("too small", None), "index.rpack": ("index hash differs", None)}
    assert packs.scan_pack_files(spark, f"file://{tmp_path}").filter("key = 'a'").count() == 1
    (tmp_path / "none").mkdir()
    assert packs.scan_pack_files(spark, f"file://{tmp_path}/none").count() == 0


def test_files_and_manifest_are_compared_on_both_sides(spark, tmp_path):
    def pack(i):
        return packs.pack_bytes({"game": "g"}, [("a", "albedo", bytes([i]) * 3_000_000), ("b", "height", bytes([i]) * 50)])

    sound = {f"p{i}.rpack": pack(i) for i in range(7)}
    manifest = spark.createDataFrame([(n, hashlib.sha256(c).hexdigest(), len(c)) for n, c in sound.items() if n != "p1.rpack"] + [("gone.rpack", "0" * 64, 9)], "name string, sha256 string, size long")
    held = dict(sound)
    del held["p0.rpack"]
    flip = bytearray(held["p2.rpack"])
    flip[packs.HEADER + 2_999_999] ^= 1
    held["p2.rpack"], held["p3.rpack"], held["p4.rpack"] = bytes(flip), sound["p3.rpack"][:-1], sound["p4.rpack"] + b"x"
    held["p5.rpack"] = packs.pack_bytes({"game": "h"}, [("a", "albedo", bytes([5]) * 3_000_000), ("b", "height", bytes([5]) * 50)])
    for name, content in held.items():
        (tmp_path / name).write_bytes(content)
    want = {("p0.rpack", None, None, "missing"), ("gone.rpack", None, None, "missing"), ("p1.rpack", None, None, "unlisted"), ("p2.rpack", None, None, "altered"), ("p2.rpack", "a", "albedo", "altered"), ("p3.rpack", None, None, "short"), ("p4.rpack", None, None, "long"), ("p5.rpack", None, None, "altered")}
    assert {tuple(r) for r in packs.verify_pack_files(spark, f"file://{tmp_path}", manifest).collect()} == want
    alone = {tuple(r) for r in packs.verify_pack_files(spark, f"file://{tmp_path}").collect()}
    assert alone == {("p2.rpack", "a", "albedo", "altered"), ("p3.rpack", None, None, "bad trailer magic"), ("p4.rpack", None, None, "bad trailer magic")}


def test_a_pack_is_checked_in_one_pass():
    content = packs.pack_bytes({"game": "g"}, [(f"k{i}", "albedo", bytes([i]) * 900_001) for i in range(9)])
    file = Counting(content)
    digest, error, wrong = packs.check_file(file)
    assert (digest, error, wrong) == (hashlib.sha256(content).hexdigest(), None, [])
    assert file.n < len(content) + 20_000  # the index is read twice
    assert max(map(len, files.chunks(pa.BufferReader(content)))) <= files.CHUNK


def test_refused_entries_are_reported(spark):
    rows = [("a", "albedo", b"x"), ("b", "albedo", b""), ("c", "depth", b"x"), ("d", None, b"x"), (None, "albedo", b"x"), ("e", "albedo", None)]
    df = spark.createDataFrame([(k, m, None if p is None else bytearray(p)) for k, m, p in rows], "key string, map string, payload binary")
    got = {tuple(r) for r in packs.refused_entries(df).collect()}
    assert got == {("b", "albedo", "empty payload"), ("c", "depth", "unknown map"), ("d", None, "unknown map"), (None, "albedo", "no key"), ("e", "albedo", "empty payload")}
    with pytest.raises(Exception, match="can't pack"):
        packs.build_packs(df.withColumn("fam", F.lit("f")), ["fam"]).collect()
    assert packs.build_packs(df.limit(0).withColumn("fam", F.lit("f")), ["fam"]).count() == 0


def test_blobs_are_hashed_as_streams(spark, tmp_path):
    (tmp_path / "t page" / "n%20").mkdir(parents=True)
    big = random.Random(4).randbytes(5_000_003)
    cases = {"albedo": big, "height": b"", "normal": b"x" * files.CHUNK}
    for name, content in cases.items():
        (tmp_path / "t page" / "n%20" / f"{name}.png").write_bytes(content)
    got = {r["map_kind"]: (r["tpage"], r["name"], r["sha256"], r["size"]) for r in catalog.scan_blobs(spark, f"file://{tmp_path}").collect()}
    assert got == {k: ("t page", "n%20", hashlib.sha256(v).hexdigest(), len(v)) for k, v in cases.items()}
    assert not files.can_stream("viewfs://store/in") and files.can_stream(f"file://{tmp_path}")


def test_blobs_are_written_by_their_tasks_and_listed_below_few_folders(spark, tmp_path):
    rows = [(f"t{i % 2}", f"n{i}", kind, bytearray(f"{i}{kind}\n".encode() * (i % 3))) for i in range(300) for kind in ("albedo", "height")]
    root = f"file://{tmp_path}/blobs"
    catalog.write_blobs(spark.createDataFrame(rows, "tpage string, name string, map_kind string, content binary"), root)
    want = {(t, n, k, hashlib.sha256(c).hexdigest(), len(c)) for t, n, k, c in rows}
    assert {tuple(r) for r in catalog.scan_blobs(spark, root).collect()} == want
    assert len([*(tmp_path / "blobs").rglob("*.png")]) == 600 == len([x for x in (tmp_path / "blobs").rglob("*") if x.is_file()])
    (tmp_path / "blobs" / "top.png").write_bytes(b"x")
    (tmp_path / "blobs" / "t0" / "_hidden").mkdir()
    (tmp_path / "blobs" / "t0" / "_hidden" / "no.png").write_bytes(b"x")
    listed = files.list_files(spark, root, "*.png")
    assert listed.count() == 601 and listed.columns == ["path", "size"]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2  # what lies below a folder's folders is dealt out again
    with pytest.raises(Exception, match="no content"):
        files.write_files(spark.createDataFrame([("a", None)], "path string, content binary"), f"file://{tmp_path}/bad")


def test_lock_tree_hashes_parts_in_order(spark):
    oids = [hashlib.sha256(bytes([i])).hexdigest() for i in range(200)]
    parts = {}
    for oid in sorted(oids):
        parts.setdefault(oid[:1], []).append(oid)
    want = hashlib.sha256("\n".join(hashlib.sha256("\n".join(v).encode()).hexdigest() for _, v in sorted(parts.items())).encode()).hexdigest()
    rows = spark.createDataFrame([(x,) for x in [*oids, None, None]], "oid string")
    assert tuple(catalog.lock_tree(rows, 1).first()) == (want, 202)
    assert tuple(catalog.lock_tree(rows.repartition(5), 1).first()) == (want, 202)
    assert tuple(catalog.lock_tree(rows.limit(0)).first()) == (hashlib.sha256(b"").hexdigest(), 0)


def test_upserts_write_touched_folders_alone(spark, tmp_path):
    path = f"file://{tmp_path}/m"
    schema = "id string, derived boolean, v int"
    catalog.write_metadata(spark.createDataFrame([("a/1", False, 1), ("a/2", True, 1), ("a/3", None, 1), ("b/1", True, 1)], schema), path)
    untouched = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "m" / "tpage=b").iterdir()}
    catalog.upsert_written(spark.createDataFrame([("a/1", True, 2), ("a/2", True, 2), ("a/4", True, 2), ("c/1", True, 2)], schema), path, schema)
    got = {(r["id"], r["derived"], r["v"], r["tpage"]) for r in catalog.read_metadata(spark, path, schema).collect()}
    assert got == {("a/1", False, 1, "a"), ("a/2", True, 2, "a"), ("a/3", None, 1, "a"), ("a/4", True, 2, "a"), ("b/1", True, 1, "b"), ("c/1", True, 2, "c")}
    assert {f.name: f.stat().st_mtime_ns for f in (tmp_path / "m" / "tpage=b").iterdir()} == untouched
