"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's shingles are its ``width`` consecutive words, repeats included; each has an XXH64, and a bit of the fingerprint is set
where more than half of the hashes have it. Fingerprints at most ``radius`` bits apart are linked, and components follow.

Covering masks: each of the 64 bits gets a non-zero vector of ``radius + 1`` binary digits, and each non-zero vector v gives a table, keyed by
the bits whose vectors have an odd product with v. The vectors of up to ``radius`` differing bits span less than the whole space,
so some v is orthogonal to all of them: that table's key leaves those bits out, and the pair meets in it. With radius 4
these are 31 tables of some 33 bits, and no pair is missed.

Scale: fingerprints are one pass over the texts; equal ones are one node from then on, so that copies cost nothing. Each distinct
fingerprint gives 31 narrow rows, combined on the map side to a count and two members a bucket, which is all that a bucket of two needs. Members of larger
buckets are gathered, up to ``bucket`` of them in a task; a bucket above that is dealt out again by covering masks over the bits
that its own mask leaves open, after which at most 16 bits are open, and so no bucket can hold more than 65,536 fingerprints. Inside
a bucket a forest is grown that joins what the links join, so rows stay below the members; nothing lists pairs.

Edge cases: null and empty texts, and texts without words, have fingerprint 0 and are linked like any other; with fewer words than ``width``
the whole sequence is the one shingle; repeated ids are rows of their own; a row with a null id takes part, but an id of a component is the
least of the others (null if there is none); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import materialize, small_batches
from .components import connected_components

U = np.uint64


def fingerprint(text: str | None, width: int = 4, seed: int = 42, chunk: int = 65_536) -> int:
    """The majority of the shingles' hashes, bit by bit; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    votes = np.zeros(64, np.int64)
    for i in range(0, n, chunk):
        some = words[i : min(n, i + chunk) + width - 1]
        grams = zip(*(some[j:] for j in range(width)), strict=False) if len(words) >= width else [words]
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(g), seed) for g in grams], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((U(1) << np.flatnonzero(2 * votes > n).astype(U)).sum(dtype=U))


def fingerprint_documents(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id, fingerprint as a signed long: one pass, no shuffle."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], U)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, fingerprint long")


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """A mask for each non-zero vector; for any ``radius`` of ``bits``, one of the masks has none of them."""
    vectors = (1 << radius + 1) - 1
    return [sum(1 << b for j, b in enumerate(bits) if ((1 + j % vectors) & v).bit_count() & 1) for v in range(1, vectors + 1)]


def _literals(masks: list[int]) -> Column:
    return F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks])


def forest(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges (of at most ``radius`` bits) that join what all such edges would; fewer than there are fingerprints."""
    rest, out = prints[1:], []
    queue = [prints[0]] if len(prints) else []
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
            continue
        at = queue.pop()
        near = np.bitwise_count((rest ^ at).view(U)) <= radius  # of signed numbers it would count the bits of the magnitude
        found = rest[near]
        out += [(int(at), int(x)) for x in found]
        queue += list(found)
        rest = rest[~near]
    return out


def links(prints: DataFrame, radius: int = 4, bucket: int = 1024) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that give the components of all links within ``radius`` bits."""
    small_batches(prints.sparkSession)
    masks = covering_masks(list(range(64)), radius)
    rows = prints.select("fp", F.posexplode(_literals(masks)).alias("t", "mask")).select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")
    sizes = materialize(sizes, "covering-sizes")
    pairs = sizes.filter((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")
    crowd = materialize(rows.join(sizes.filter("n > 2").select("t", "key", "n"), ["t", "key"]), "covering-members")
    inner = F.array(*[_literals(covering_masks([i for i in range(64) if not m >> i & 1], radius)) for m in masks])
    dealt = crowd.filter(F.col("n") > bucket).select("t", "key", "fp", F.posexplode(F.element_at(inner, F.col("t") + 1)).alias("t2", "mask"))
    dealt = dealt.select("t", "key", "t2", F.col("fp").bitwiseAND(F.col("mask")).alias("key2"), "fp")
    whole = crowd.filter(F.col("n") <= bucket).select("t", "key", F.lit(-1).alias("t2"), F.lit(0).cast("long").alias("key2"), "fp")
    groups = whole.unionByName(dealt).groupBy("t", "key", "t2", "key2").agg(F.collect_list("fp").alias("fps")).select("fps").filter(F.size("fps") > 1)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = [e for fps in batch.column(0) for e in forest(fps.values.to_numpy(zero_copy_only=False), radius)]
            a, b = zip(*edges, strict=True) if edges else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return pairs.unionByName(groups.mapInArrow(grow, "a long, b long")).distinct()


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4, bucket: int = 1024) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id, the least doc_id that links reach, for every row of ``docs``."""
    prints = materialize(fingerprint_documents(docs, width), "covering-prints")
    nodes = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first"))
    nodes = materialize(nodes, "covering-nodes")
    joined = connected_components(links(nodes.select("fp"), radius, bucket)).select(F.col("node").alias("fp"), "component")
    nodes = nodes.join(joined, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    least = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = nodes.join(least, "component").select(F.col("fp").alias("fingerprint"), "component_id")
    return prints.join(named, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
