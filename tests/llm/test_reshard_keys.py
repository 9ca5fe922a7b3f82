"""Resharding with ids that repeat, are null, or fill a third of the rows."""

import random
import zlib

from pyspark.sql import functions as F

from shardloom.llm import reshard


def test_repeated_and_null_ids_keep_their_texts(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        doc = None if i % 3 == 0 else 8 if i % 3 == 1 else i
        text = None if i % 50 == 0 else "same text" if i % 4 == 0 else "x" * rng.randrange(300) + str(i % 7)
        rows.append((doc, text))
    df = spark.createDataFrame([(*r, "c", 2) for r in rows], "doc_id long, text string, shard string, slot int")
    placed, files = reshard.reshard(df, 5, rows_per_block=20)
    got = placed.collect()
    count = lambda xs: sorted(((x, xs.count(x)) for x in set(xs)), key=repr)
    want = [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows]
    assert count([(r["doc_id"], r["size"], r["text_crc32"]) for r in got]) == count(want)
    shards = {}
    for r in got:
        shards.setdefault(r["shard"], []).append(r)
    assert set(shards) == set(range(5))
    sizes = [sum(r["size"] for r in v) for v in shards.values()]
    assert max(sizes) - min(sizes) < 0.1 * sum(sizes) / 5 + 600
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in shards.values())
    moved = files.collect()
    held = {(r["shard"], r["slot"]): (r["doc_id"], r["size"], r["text_crc32"]) for r in got}
    assert moved and all(held[r["shard"], r["slot"]] == (r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in moved)


def test_texts_pass_through_no_window(spark):
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    _, files = reshard.reshard(df, 3)
    assert {c for c, _ in files.dtypes} == {"doc_id", "text", "size", "text_crc32", "old_shard", "shard", "slot"}
