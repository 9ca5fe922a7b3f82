"""SimHash fingerprints and all fingerprints within a Hamming radius.

Terms are pairs of neighbouring words (single words where there is only one), weighted by their
count and their length. Each term's 64-bit hash votes with its weight on every bit, and a bit is set where the
votes are positive. Fingerprints within the radius are found by permuted block tables:
the 64 bits are cut into ``blocks`` blocks; two fingerprints at most ``radius`` apart agree on at least
``blocks - radius`` of them, so each choice of that many blocks is a table keyed by their bits.

Scale: fingerprints are one pass. The pairing with the next document is one shuffle of the texts
into ranges of ids, sorted within; an id (or null) with more rows than a range is dealt out further, by a hash of their texts. The first row of each following
range comes along as a guest, so a range never needs another's rows. Search explodes distinct fingerprints (so copies count once) into
C(blocks, radius) narrow rows and joins the queries on them.

Edge cases: null texts are empty; texts without words have fingerprint 0; a null doc_id sorts below all
others; rows of one id are in the order of a hash of their texts (equal rows of one id stay together); the only document is followed by itself; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._ranges import partitions, range_of
from ._store import small_batches
from ._text import BLANK, LOWER, buffer, mix, prefix_hash, span_hash, words

U = np.uint64
_LEAST = -(1 << 63)


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    data, offsets = buffer(texts)
    start, end, doc = words(data, offsets, BLANK)
    w = span_hash(prefix_hash(LOWER[data]), start, end)
    size = np.minimum(end - start, 12)
    n = len(offsets) - 1
    counts = np.bincount(doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])
    pair = mix(w[:-1] * U(0x9E3779B97F4A7C15) + w[1:]) if len(w) > 1 else np.zeros(0, U)
    weight = (size[:-1] + size[1:]).astype(np.float64)
    out = np.zeros(n, U)
    powers = U(1) << np.arange(64, dtype=U)
    for d in np.flatnonzero(counts):
        a, b = first[d], first[d + 1] - 1
        votes = np.zeros(64)
        total = 0.0
        if b == a:
            bits, each = w[a : a + 1], np.ones(1)
            votes, total = each @ np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), 1.0
        for i in range(a, b, 65_536):
            bits, each = pair[i : min(b, i + 65_536)], weight[i : min(b, i + 65_536)]
            votes = votes + each @ np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += each.sum()
        out[d] = powers[2 * votes > total].sum(dtype=U)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits."""
    return 1 - np.bitwise_count(a ^ b) / 64


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as a signed long: one pass, no shuffle."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(batch.column(1)).view(np.int64))], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, fingerprint long")


def followed(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (part, place, tie, doc_id, text, guest) whose order within a part, by place descending and tie, is that of the documents.

    A part's last row is a guest: the document that follows the part. Parts are ranges of places, from the highest number on; a place that
    fills more than one range has as many parts of its own, by ranges of the tie.
    """
    spark = docs.sparkSession
    place, tie = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)), F.xxhash64(F.coalesce("text", F.lit("")))
    n = 2 * partitions(spark)
    found = docs.select(F.percentile_approx(place, [i / n for i in range(1, n)], 10 * n + 1000)).first()[0] or []
    full = {v: found.count(v) for v in set(found) if found.count(v) > 1}
    most = max(full.values(), default=1)
    ways = F.try_element_at(F.create_map(*[F.lit(x).cast("long") for v in full.items() for x in v]), F.col("place")) if full else F.lit(None).cast("long")
    uniform = F.col("tie") / F.lit(2.0**64) + 0.5  # a place that fills ranges is the least of the range that it begins, so its parts come after the rest of it
    sub = F.coalesce(F.least(F.floor(uniform * ways), ways - 1), F.lit(-1))
    part = (range_of(F.col("place"), sorted(set(found))) * (most + 1) + most - 1 - sub).cast("int")
    light = docs.select(place.alias("place"), tie.alias("tie")).withColumn("part", part)
    first = F.max(F.struct("place", F.bitwise_not("tie").alias("not_tie"))).alias("head")
    heads = sorted((r["part"], r["head"]["place"], ~r["head"]["not_tie"]) for r in light.groupBy("part").agg(first).collect())  # a row a part
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), place.alias("place"), tie.alias("tie")).withColumn("part", part)
    guests = [(*heads[i - 1][1:], heads[i][0]) for i in range(len(heads))]
    wanted = spark.createDataFrame(guests, "place long, tie long, for_part int")
    visit = rows.join(F.broadcast(wanted), ["place", "tie"]).groupBy("for_part", "place", "tie").agg(F.min("text").alias("text"))
    visit = visit.select(F.col("for_part").alias("part"), "place", "tie", F.lit(None).cast("long").alias("doc_id"), "text", F.lit(1).alias("guest"))
    every = rows.select("part", "place", "tie", "doc_id", "text", F.lit(0).alias("guest")).unionByName(visit)
    return every.repartition(len(heads) or 1, "part").sortWithinPartitions("part", "guest", F.desc("place"), "tie", "text"), len(heads)


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_and_follow(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its text with its later half replaced by the next document's start, and their likeness."""
    small_batches(docs.sparkSession)
    rows, _ = followed(docs)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            parts, ids, texts, guest = (batch.column(i).to_pylist() for i in (0, 3, 4, 5))
            prints = fingerprints(batch.column(4))
            if held is not None:
                parts, ids, texts, guest = [held[0], *parts], [held[1], *ids], [held[2], *texts], [0, *guest]
                prints = np.concatenate([[held[3]], prints]).astype(U)
            last = len(parts) - 1
            held = None if guest[last] else (parts[last], ids[last], texts[last], prints[last])
            now = [i for i in range(last) if not guest[i]]
            if not now:
                continue
            edited = []
            for i in now:
                half = len(texts[i]) // 2
                edited.append(texts[i][: len(texts[i]) - half] + texts[i + 1][:half])
            other = fingerprints(pa.array(edited, pa.string()))
            mine, after = prints[now], prints[[i + 1 for i in now]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[i] for i in now], pa.int64()),
                    pa.array([len(texts[i]) for i in now], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
                    pa.array([f"{int(x):016x}" for x in mine]),
                    pa.array([f"{int(x):016x}" for x in other]),
                    pa.array(likeness(mine, other)),
                    pa.array(likeness(mine, after)),
                ],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    return rows.mapInArrow(scan, SCHEMA)


def tables(fingerprint: Column, radius: int, blocks: int) -> Column:
    """Array of (table, key): the bits of every choice of ``blocks - radius`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    chosen = list(combinations(range(blocks), blocks - radius))

    def mask(pick: tuple[int, ...]) -> int:
        m = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in pick)
        return m - (1 << 64) if m >> 63 else m

    return F.array(*[F.struct(F.lit(t).alias("t"), fingerprint.bitwiseAND(F.lit(mask(p)).cast("long")).alias("key")) for t, p in enumerate(chosen)])


def neighbours(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """(query, fingerprint, distance, n): each distinct fingerprint within ``radius`` of a query's, with its number of rows.

    ``queries`` has (query, fingerprint), ``prints`` a row (fingerprint) per document.
    """
    index = prints.groupBy("fingerprint").agg(F.count("*").alias("n"))
    index = index.select("fingerprint", "n", F.explode(tables(F.col("fingerprint"), radius, blocks)).alias("x")).select("fingerprint", "n", "x.*")
    wanted = queries.groupBy(F.col("fingerprint").alias("mine")).agg(F.count("*").alias("askers"))
    asked = wanted.select("mine", F.explode(tables(F.col("mine"), radius, blocks)).alias("x")).select("mine", "x.*")
    distance = F.bit_count(F.col("mine").bitwiseXOR(F.col("fingerprint")))
    hits = asked.join(index, ["t", "key"]).select("mine", "fingerprint", "n", distance.alias("distance")).filter(F.col("distance") <= radius).distinct()
    return queries.select("query", F.col("fingerprint").alias("mine")).join(hits, "mine").select("query", "fingerprint", "distance", "n")


def count_within(rows: DataFrame, radius: int = 3, every: int = 100) -> DataFrame:
    """``rows`` (doc_id, fingerprint in hex) with ``n_within_<radius>``: how many other rows lie within the radius; null where doc_id isn't divisible by ``every``.

    A query is a fingerprint of such an id; each row leaves out itself only, so rows that share an id count for each other.
    """
    number = F.conv("fingerprint", 16, -10).cast("long")
    ids = rows.filter(F.col("doc_id") % every == 0).select("doc_id", "fingerprint").distinct()
    asked = ids.select(number.alias("query"), number.alias("fingerprint")).distinct()
    found = neighbours(asked, rows.select(number.alias("fingerprint")), radius).groupBy("query").agg((F.sum("n") - 1).alias(f"n_within_{radius}"))
    found = ids.join(found.withColumn("fingerprint", F.lower(F.lpad(F.hex("query"), 16, "0"))).drop("query"), "fingerprint")
    return rows.join(found, ["doc_id", "fingerprint"], "left").select(*rows.columns, f"n_within_{radius}")
