"""Minimum-cost-flow resharding.

Old shards hold blocks of documents (a size class and a hash bucket of one shard). From the
old shard sizes and the new capacities a min-cost flow on the shards' graph, where a byte
that stays costs 0 and a byte that moves costs 1, gives how many bytes each pair of shards
exchanges. Blocks are laid along every old shard from the largest documents to the smallest;
the flow cuts that line, so what moves lies at its end and a cut is never wrong by more than
a small document. Only blocks that lose a row are rewritten.

Scale: places are found on light rows (id, size, checksum) alone; each affected text, repeated rows as one, then meets its run of slots by a
hash join, and runs are dealt out by slots before copies are written. The driver holds the block table alone: old shards x size classes x buckets, at
most ``old_shards * 128 * max_buckets`` rows, where a block has some ``rows_per_block`` light rows.

Edge cases: a null text has size 1 and checksum 0; a null doc_id is a key like any other;
repeated rows are placed one by one; an empty table gives an empty plan; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import materialize, scratch

BLOCK = ["old_shard", "size_class", "bucket"]


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> np.ndarray:
    """Flow[i, j] >= 0 with row sums ``supply`` and column sums at most ``capacity`` of least total cost.

    Successive shortest paths (Bellman-Ford on the residual graph); both sides are shards, so a few dozen nodes.
    """
    n, m = len(supply), len(capacity)
    flow = np.zeros((n, m), dtype=np.int64)
    left, room = np.array(supply, dtype=np.int64), np.array(capacity, dtype=np.int64)
    cost = np.array(cost, dtype=np.int64)
    far = np.iinfo(np.int64).max // 4
    while left.any():
        source, sink = np.where(left > 0, 0, far), np.full(m, far)
        via_row, via_col = np.full(n, -1), np.full(m, -1)
        for _ in range(n + m):
            reach = source[:, None] + cost
            best = reach.argmin(axis=0)
            new_sink = reach[best, np.arange(m)]
            via_col = np.where(new_sink < sink, best, via_col)
            sink = np.minimum(sink, new_sink)
            back = np.where(flow > 0, sink[None, :] - cost, far)
            best = back.argmin(axis=1)
            new_source = back[np.arange(n), best]
            better = new_source < source
            if not better.any():
                break
            via_row = np.where(better, best, via_row)
            source = np.minimum(source, new_source)
        end = int(np.where(room > 0, sink, far).argmin())
        if room[end] <= 0 or sink[end] >= far:
            raise ValueError("capacities are smaller than the supplies")
        path, j = [], end
        while True:
            i = int(via_col[j])
            path.append((i, j, 1))
            if via_row[i] < 0 or source[i] == 0 and left[i] > 0:
                break
            j = int(via_row[i])
            path.append((i, j, -1))
        push = min(left[path[-1][0]], room[end], *[flow[i, j] for i, j, sign in path if sign < 0])
        for i, j, sign in path:
            flow[i, j] += sign * push
        left[path[-1][0]] -= push
        room[end] -= push
    return flow


def block_columns(size: Column, old_shard: Column, buckets: int) -> list[Column]:
    """The block of a row: its old shard, its size class (four to a power of two) and a hash bucket."""
    return [
        old_shard.cast("int").alias("old_shard"),
        F.floor(4 * F.log2(size)).cast("int").alias("size_class"),
        F.pmod(F.xxhash64("doc_id", F.lit("bucket")), F.lit(buckets)).cast("int").alias("bucket"),
    ]


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, text, size in bytes plus one, unsigned crc32 of the UTF-8 bytes."""
    return docs.select("doc_id", "text", *_digest())


def cuts(blocks: list, new_shards: int) -> tuple[list[tuple[int, int, int, int]], np.ndarray]:
    """From block sizes: (old shard, from byte, to byte, new shard) along each old shard's line, and the flow."""
    old = max((b["old_shard"] for b in blocks), default=-1) + 1
    supply = [0] * old
    for b in blocks:
        supply[b["old_shard"]] += b["bytes"]
    total = sum(supply)
    capacity = [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    flow = min_cost_flow(supply, capacity, [[int(i != j) for j in range(new_shards)] for i in range(old)])
    out = []
    for i in range(old):
        at = 0
        for j in sorted(range(new_shards), key=lambda j: (j != i, j)):
            if flow[i, j]:
                out.append((i, at, at + int(flow[i, j]), j))
                at += int(flow[i, j])
    return out, flow


def reshard(
    docs: DataFrame, new_shards: int = 16, old_shard: Column | None = None, old_shards: int = 12, rows_per_block: int = 50_000, max_buckets: int = 2048, path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Give every document a new shard of near equal bytes, moving the fewest; rewrite the affected files.

    ``old_shard``: where a row lies now (default: a hash of its id modulo ``old_shards``).
    Returns (placement, files): placement has doc_id, size, text_crc32, old_shard, shard, slot (gapless from 0
    in each shard) of all rows; files are the rewritten rows as read back from ``path``, partitioned by shard.
    """
    spark = docs.sparkSession
    home = F.pmod(F.xxhash64("doc_id"), F.lit(old_shards)) if old_shard is None else old_shard
    n = docs.count()
    buckets = int(min(max_buckets, max(1, n // (old_shards * 24 * rows_per_block) + 1)))
    rows = sized(docs)
    rows = rows.select("*", *block_columns(F.col("size"), home, buckets))
    light = materialize(rows.drop("text"), "reshard-light")

    blocks = light.groupBy(*BLOCK).agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    blocks.sort(key=lambda b: (b["old_shard"], -b["size_class"], b["bucket"]))
    segments, _ = cuts(blocks, new_shards)
    base, at = [], {}
    for b in blocks:
        begin = at.get(b["old_shard"], 0)
        at[b["old_shard"]] = begin + b["bytes"]
        homes = [j for i, lo, hi, j in segments if i == b["old_shard"] and lo < begin + b["bytes"] and hi > begin]
        base.append((b["old_shard"], b["size_class"], b["bucket"], begin, homes != [b["old_shard"]]))
    bases = spark.createDataFrame(base, "old_shard int, size_class int, bucket int, base long, affected boolean")
    middle = F.col("base") + F.col("before") + F.col("size") / 2
    shard = F.lit(None).cast("int")
    for i, _, hi, j in reversed(segments):
        shard = F.when((F.col("old_shard") == i) & (middle <= hi), j).otherwise(shard)
    order = Window.partitionBy(*BLOCK).orderBy(F.desc("size"), "doc_id", "text_crc32")

    def placed(part: DataFrame) -> DataFrame:
        part = part.join(F.broadcast(bases), BLOCK)
        part = part.withColumn("rank", F.row_number().over(order)).withColumn("before", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        return part.withColumn("before", F.coalesce("before", F.lit(0))).withColumn("shard", shard)

    piece = ["shard", *BLOCK]
    pieces = placed(light).groupBy(*piece).agg(F.count("*").alias("n"), F.min("rank").alias("first"))
    line = Window.partitionBy("shard").orderBy("old_shard", F.desc("size_class"), "bucket").rowsBetween(Window.unboundedPreceding, -1)
    pieces = materialize(pieces.select(*piece, "first", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("piece_base")), "reshard-pieces")

    slotted = placed(light).join(F.broadcast(pieces), piece)
    slotted = slotted.select("doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("piece_base") + F.col("rank") - F.col("first")).cast("long").alias("slot"), "affected")
    slotted = materialize(slotted, "reshard-slots")

    path = path or scratch(spark, "reshard-files")
    # Equal ids, sizes and checksums stand together in a block's order, so what they share is a text and a run of slots.
    same = {"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_null": F.col("doc_id").isNull()}
    key = [*same, "size", "text_crc32"]
    part = F.floor(F.col("slot") / rows_per_block).alias("_part")
    runs = slotted.filter("affected").withColumns(same).groupBy(*key, "doc_id", "old_shard", "shard", part).agg(F.min("slot").alias("_slot"), F.count("*").alias("_n"))
    hit = F.broadcast(bases.filter("affected").select(*BLOCK))
    texts = rows.join(hit, BLOCK, "left_semi").withColumns(same).groupBy(*key).agg(F.max("text").alias("text"))
    moved = runs.join(texts, key).repartition("shard", "old_shard", "_part")
    moved = moved.select("doc_id", "text", "size", "text_crc32", "old_shard", "shard", F.explode(F.sequence(F.col("_slot"), F.col("_slot") + F.col("_n") - 1)).alias("slot"))
    moved.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    files = spark.read.schema(moved.schema).parquet(path)
    again = files.select("doc_id", *_digest(), "old_shard", "shard", "slot")
    stay = slotted.filter(~F.col("affected")).drop("affected")
    return stay.unionByName(again), files


def _digest() -> list[Column]:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return [(F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")]
