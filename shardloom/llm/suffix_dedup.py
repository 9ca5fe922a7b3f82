"""Exact substring deduplication with a logarithmic family of suffix arrays.

Which suffixes: of every ``length``-byte string, the suffix that starts at its minimizer (the
least hash among its ``k``-byte strings). Equal strings have equal minimizers at equal places, so
every repeat shows up among these suffixes, about one in 39 of all positions. An
entry of a suffix array holds the suffix's leading k bytes as they are, a 64-bit hash of the context (all bytes
that the match extends over on both sides, as far as the entry's strings reach), and its place. Entries are in the order of the suffixes' bytes, ties by
context, and cut into buckets by bounds from a sample of that order; each bucket is packed into one blob.

Batches of documents come in the order of doc_id. A new batch gets its suffix array, which is
merge-scanned bucket by bucket against all existing levels: an entry with equal leading bytes and context in an
older level, or earlier in the batch, repeats all its strings. Entries whose leading bytes
are shared and whose contexts differ, but agree on one side (the edges of a repeat), are kept as candidates, with their strings on that side. Equal-sized levels then merge:
after batch i the new array is merged with levels 0..t-1 into level t, t being the number of trailing ones of i, and a
merge keeps the earliest of equal entries. At last the candidates' strings are compared one by one, by two hashes (96 bits) of all
``length`` bytes grouped over the corpus, and the earliest of each is kept.

Hot groups: in a task and in a level the earliest of equal entries stands for all, so a passage in
a third of the documents is one entry per task. Leading bytes with very many contexts (a common opening, blanks) are cut into buckets by context;
as those buckets don't see each other's, all their entries are candidates. Nothing is held but a bucket and a batch of texts.

Edge cases: a null text is empty; texts under ``length`` bytes lose nothing; every row is a document of its own: rows that
share a doc_id come in the order of their texts' hashes, of equal ones any is the earliest, and null ids sort first. Where ids
repeat, rows are numbered in that order and written once, so that each keeps its number. Very long texts are scanned in
slices; an empty table gives no rows; extra columns, whatever their names, stay as they are or are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._ranges import partitions, split_points
from ._store import discard, free_name, freeze, materialize, release, scratch, small_batches, thaw
from ._text import buffer, mix, prefix_hash, ragged, span_hash, window_hashes

U, I = np.uint64, np.int64
_LEAST = -(1 << 63)
REMOVED, CANDIDATE, NEW = -2, -3, -1
ROWS = "bucket int, level int, doc long, data binary"
_NAMES = ["bucket", "level", "doc", "data"]
_POS = 22  # bits of a place in a slice


def slices(offsets: np.ndarray, length: int, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from byte, to byte, bounds within, position of each bound's start in its document, first document) of slices of about ``most`` bytes.

    A document over ``most`` is cut into slices that overlap by length - 1 bytes, so each of its strings lies in one.
    """
    n, d = len(offsets) - 1, 0
    while d < n:
        e = int(np.searchsorted(offsets, offsets[d] + most, side="right")) - 1
        if e > d:
            yield int(offsets[d]), int(offsets[e]), offsets[d : e + 1] - offsets[d], np.zeros(e - d, I), d
            d = e
            continue
        for a in range(0, max(1, int(offsets[d + 1] - offsets[d]) - length + 1), most):
            b = min(int(offsets[d + 1] - offsets[d]), a + most + length - 1)
            yield int(offsets[d]) + a, int(offsets[d]) + b, np.array([0, b - a]), np.array([a]), d
        d += 1


def string_starts(bounds: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask over n - length + 1 places: where a string of ``length`` bytes lies within one document."""
    step = np.zeros(n + 1, np.int32)
    long = np.diff(bounds) >= length
    np.add.at(step, bounds[:-1][long], 1)
    np.add.at(step, bounds[1:][long] - length + 1, -1)
    return np.cumsum(step)[: n - length + 1] > 0


def sampled_suffixes(data: np.ndarray, offsets: np.ndarray, length: int, k: int, most: int = 1 << 19) -> Iterator[tuple[np.ndarray, ...]]:
    """(leading bytes as big-endian words, context, document, first string, its bytes left of the leading ones and the side hashes, strings) of the entries of each slice; k is a multiple of 8.

    A string that holds the minimizer has at least half of its other bytes on one side of it. So
    entries share a string only if they agree on that many bytes to the left or to the right, of
    which 8-bit hashes are kept; 0 where the document (or slice) is too short for any string of the entry to need it.
    """
    w = length - k + 1
    half = (length - k + 1) // 2
    for a, b, bounds, shift, d in slices(offsets, length, most):
        part = data[a:b]
        n = len(part)
        if n < length:
            continue
        ok = string_starts(bounds, length, n)
        if not ok.any():
            continue
        p = prefix_hash(part)
        h = window_hashes(p, k)
        low = U((1 << _POS) - 1)
        v = (h & ~low) | np.arange(len(h), dtype=U)
        span = 1
        while 2 * span <= w:
            v = np.minimum(v[:-span], v[span:])
            span *= 2
        if span < w:
            v = np.minimum(v[: -(w - span)], v[w - span :])
        x = (v & low).astype(I)
        cut = x[1:] != x[:-1]
        first, last = ok.copy(), ok.copy()
        first[1:] &= ~ok[:-1] | cut
        last[:-1] &= ~ok[1:] | cut
        s, e = np.flatnonzero(first), np.flatnonzero(last)
        at = x[s]
        context = mix(span_hash(p, s, e + length) + (at - s).astype(U) * U(0x9FB21C651E98DF25))
        doc = np.searchsorted(bounds, s, side="right") - 1
        left, right = np.maximum(at - half, 0), np.minimum(at + k + half, n)
        side_l = np.where(at - half >= bounds[doc], 1 + span_hash(p, left, at) % U(255), U(0))
        side_r = np.where(at + k + half <= bounds[doc + 1], 1 + span_hash(p, at + k, right) % U(255), U(0))
        lead = np.ascontiguousarray(part[at[:, None] + np.arange(k)]).view(">u8").astype(U)
        yield lead, context, doc + d, s - bounds[doc] + shift[doc], (at - s) << 16 | (side_l << U(8) | side_r).astype(I), e - s + 1


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    b, v, d, x = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(v, pa.int32()), pa.array(d, pa.int64()), pa.array(x, pa.binary())], names=_NAMES)


def per_document(kind: int, doc: np.ndarray, start: np.ndarray, n: np.ndarray, buckets: int) -> list[tuple]:
    """A row for each document with its (start, n) pairs; runs of neighbouring starts become one pair."""
    if not len(doc):
        return []
    order = np.lexsort((start, doc))
    doc, start, n = doc[order], start[order], n[order]
    run = np.ones(len(doc), bool)
    run[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + n[:-1])
    if kind == REMOVED:
        end = start + n
        group = np.cumsum(run) - 1
        far = np.zeros(group[-1] + 1, I)
        np.maximum.at(far, group, end)
        doc, start = doc[run], start[run]
        n = far - start
    edge = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]]))
    spread = (mix(doc[edge[:-1]].astype(I).view(U)) % U(buckets)).astype(I)
    return [(int(s), kind, int(doc[a]), freeze(start[a:b].astype("<i8"), n[a:b].astype("<i4"))) for a, b, s in zip(edge[:-1], edge[1:], spread, strict=True)]


class Entries:
    """Sorted entries of a suffix array: leading bytes, context, document, place (first string, its bytes left of the leading ones, side hashes and count packed)."""

    def __init__(self, lead: np.ndarray, context: np.ndarray, doc: np.ndarray, place: np.ndarray, source: np.ndarray | None = None):
        self.lead, self.context, self.doc, self.place = lead, context, doc, place
        self.source = np.zeros(len(context), np.int8) if source is None else source

    def __len__(self) -> int:
        return len(self.context)

    def take(self, at: np.ndarray) -> Entries:
        return Entries(self.lead[at], self.context[at], self.doc[at], self.place[at], self.source[at])

    def sort(self) -> Entries:
        return self.take(np.lexsort((self.place, self.doc, self.context, *self.lead.T[::-1])))

    def new_leads(self) -> np.ndarray:
        """Of sorted entries: which have other leading bytes than the one before."""
        out = np.ones(len(self), bool)
        out[1:] = (self.lead[1:] != self.lead[:-1]).any(axis=1)
        return out

    def repeats(self) -> np.ndarray:
        """Of sorted entries: which have an earlier one of equal leading bytes and context."""
        out = ~self.new_leads()
        out[1:] &= self.context[1:] == self.context[:-1]
        return out

    def strings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, first string, strings)."""
        return self.doc, self.place >> 32, self.place & 0xFF

    def strings_near(self, left: np.ndarray, right: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``strings`` of the side (half of a string's other bytes or more) on which an entry agrees with another one."""
        doc, start, n = self.strings()
        other = length - 8 * self.lead.shape[1]
        half, before = (other + 1) // 2, (self.place >> 24) & 0xFF
        first = np.where(left, 0, np.maximum(0, before - (other - half)))
        end = np.where(right, n, np.minimum(n, before - half + 1))
        has = (left | right) & (end > first)
        return doc[has], (start + first)[has], (end - first)[has]

    def ordered_bytes(self) -> np.ndarray:
        """Leading bytes and context as byte strings, whose order is that of the entries."""
        words = np.column_stack([self.lead, self.context]).astype(">u8")
        return words.view(f"S{words.shape[1] * 8}").ravel()

    def blob(self) -> bytes:
        lead = self.lead.copy()
        lead[1:, 0] -= self.lead[:-1, 0]
        sides = (self.place >> 8).astype("<u2")
        left = (self.place >> 24).astype("<u1")
        return freeze(*lead.T, self.context, self.doc, (self.place >> 32).astype("<u4"), left, sides, self.place.astype("<u1"))

    @classmethod
    def of(cls, blob: bytes, words: int, source: int) -> Entries:
        *lead, context, doc, start, left, sides, n = thaw(blob, *["<u8"] * words, "<u8", "<i8", "<u4", "<u1", "<u2", "<u1")
        lead[0] = np.cumsum(lead[0], dtype=U)
        return cls(np.column_stack(lead), context, doc, start.astype(I) << 32 | left.astype(I) << 24 | sides.astype(I) << 8 | n, np.full(len(n), source, np.int8))

    @classmethod
    def concat(cls, many: list[Entries]) -> Entries:
        return cls(*[np.concatenate([getattr(e, x) for e in many]) for x in ("lead", "context", "doc", "place", "source")])


class Buckets:
    """Ranges of the order of entries, by ascending bounds of leading bytes and context."""

    def __init__(self, bounds: list[bytes], k: int):
        self.words, self.count = k // 8, len(bounds) + 1
        self.bounds = np.array(bounds, f"S{k + 8}")
        self.leads = self.bounds.view(">u8").reshape(-1, self.words + 1)[:, : self.words].astype(U)

    def slices(self, entries: Entries) -> list[tuple[int, int, int]]:
        """(bucket, from, to) of sorted entries."""
        edge = np.concatenate([[0], np.searchsorted(entries.ordered_bytes(), self.bounds), [len(entries)]])
        return [(int(b), int(edge[b]), int(edge[b + 1])) for b in np.flatnonzero(edge[1:] > edge[:-1])]

    def cut(self, bucket: int, entries: Entries) -> np.ndarray:
        """Which entries of a bucket have leading bytes that a neighbouring bucket may have too."""
        out = np.zeros(len(entries), bool)
        for bound in self.leads[max(0, bucket - 1) : bucket + 1]:
            out |= (entries.lead == bound).all(axis=1)
        return out


def removed_strings(entries: Entries, length: int, buckets: int) -> list[tuple]:
    doc, start, n = entries.strings()
    return per_document(REMOVED, doc, start, n + length - 1, buckets)


def by_leading_bits(key: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys; a bucket is the key's leading bits."""
    if not len(key):
        return []
    b = (key >> U(64 - bits)).astype(I)
    edge = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]]))
    return [(int(b[x]), int(x), int(y)) for x, y in zip(edge[:-1], edge[1:], strict=True)]


def scan_batch(docs: DataFrame, length: int, k: int, buckets: Buckets, flush: int = 400_000) -> DataFrame:
    """Packed sorted entries (level NEW) of the rows (doc, text), the earliest of equal ones, and what the others repeat (REMOVED)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Entries] = []

        def give() -> Iterator[pa.RecordBatch]:
            entries = Entries.concat(held).sort()
            again = entries.repeats()
            rows = removed_strings(entries.take(again), length, buckets.count)
            entries = entries.take(~again)
            for b, x, y in buckets.slices(entries):
                rows.append((b, NEW, 0, entries.take(np.arange(x, y)).blob()))
            for i in range(0, len(rows), 2000):
                yield batch_of(rows[i : i + 2000])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = buffer(batch.column(1))
            for lead, context, doc, start, sides, n in sampled_suffixes(data, offsets, length, k):
                held.append(Entries(lead, context, ids[doc], start << 32 | sides << 8 | n))
                if sum(map(len, held)) >= flush:
                    yield from give()
                    held = []
        if held:
            yield from give()

    return docs.mapInArrow(scan, ROWS)


def by_bucket(rows: DataFrame, width: int, work: Callable[[int, list[tuple[int, bytes]]], list[tuple]]) -> DataFrame:
    """``work(bucket, [(level, blob)])`` on each bucket in turn; rows of removed strings and candidates pass through."""
    dealt = rows.repartition(width, "bucket").sortWithinPartitions("bucket", "level")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            out: list[tuple] = []
            for b, level, doc, blob in zip(*[batch.column(x).to_pylist() for x in _NAMES], strict=True):
                if level in (REMOVED, CANDIDATE):
                    out.append((b, level, doc, blob))
                    continue
                if b != now:
                    if held:
                        out += work(now, held)
                    now, held = b, []
                held.append((level, blob))
            if out:
                yield batch_of(out)
        if held and (out := work(now, held)):
            yield batch_of(out)

    return dealt.mapInArrow(scan, ROWS)


def merge_scan(bucket: int, blobs: list[tuple[int, bytes]], length: int, buckets: Buckets, merged: int | None, into: int | None) -> list[tuple]:
    """Scan a batch's entries of a bucket against those of all levels; give the merge of the batch with levels below ``merged`` as level ``into``."""
    entries = Entries.concat([Entries.of(x, buckets.words, level) for level, x in blobs]).sort()
    again = entries.repeats()
    rows = removed_strings(entries.take(again & (entries.source == NEW)), length, buckets.count)
    entries = entries.take(~again)
    new = entries.source == NEW
    if new.any():
        group = np.cumsum(entries.new_leads()) - 1
        fresh = np.bincount(group, weights=new)
        edge = ((np.bincount(group) > 1) & (fresh > 0))[group]
        near = [buckets.cut(bucket, entries) & new] * 2
        for i, bit in enumerate((16, 8)):
            side = (entries.place >> bit) & 0xFF
            _, back, count = np.unique(group * 256 + side, return_inverse=True, return_counts=True)
            near[i] = near[i] | edge & (count[back] > 1) & (side > 0)
        doc, start, n = entries.strings_near(*near, length)
        rows += per_document(CANDIDATE, doc, start, n, buckets.count)
    if into is not None:
        own = entries.take(entries.source < merged)
        if len(own):
            rows.append((bucket, into, 0, own.blob()))
    return rows


def bucket_bounds(docs: DataFrame, length: int, k: int, expected: float, buckets: int, per_bucket: int = 8) -> Buckets:
    """Bounds of some ``buckets`` even ranges of the ``expected`` entries of the rows (doc, text), from a sample of documents; they decide how work is dealt and nothing else.

    A 64th of the documents or more is read, as much as gives ``per_bucket`` entries for each bucket; Spark sorts them, and the driver gets the bounds alone.
    """
    share = min(1.0, max(1 / 64, per_bucket * buckets / max(1.0, expected)))
    step = max(per_bucket, int(expected * share / buckets))
    small_batches(docs.sparkSession)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lead, context, doc, start, *_ in sampled_suffixes(*buffer(batch.column(0)), length, k):
                raw = Entries(lead, context, doc, start).ordered_bytes().tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([raw[i : i + k + 8] for i in range(0, len(raw), k + 8)], pa.binary())], names=["entry"])

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Partitions can be shorter than a step: each begins elsewhere in one, evenly spread by the golden ratio.
        passed = int(step * (TaskContext.get().partitionId() * 0.6180339887498949 % 1))
        for batch in batches:
            yield batch.take(pa.array(np.arange((-passed - 1) % step, len(batch), step)))
            passed += len(batch)

    sample = docs.filter(F.pmod(F.xxhash64("doc"), F.lit(4096)) < math.ceil(4096 * share)).select("text")
    found = sample.mapInArrow(order, "entry binary").distinct().orderBy("entry").mapInArrow(every, "entry binary").toArrow()
    return Buckets(sorted(set(found["entry"].to_pylist())), k)


class SuffixIndex:
    """The levels of an index, as tables in the shared folder, and what has been found so far."""

    def __init__(self, docs: DataFrame, length: int = 100, k: int = 24, entries_per_bucket: int = 20_000):
        self.spark, self.length, self.k = docs.sparkSession, length, k
        expected = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) * 2 / (length - k + 2)
        self.bits = min(20, max(8, int(expected / entries_per_bucket).bit_length()))
        self.buckets = bucket_bounds(docs, length, k, expected, 1 << self.bits)
        self.levels: dict[int, tuple[str, int]] = {}
        self.count, self.paths = 0, []

    def _read(self, path: str, level: int) -> DataFrame:
        rows = self.spark.read.schema(ROWS).parquet(path)
        return rows.filter(F.col("level") == level)

    def add(self, batch: DataFrame, keep: bool = True) -> None:
        """Index a batch of rows (doc, text), all of whose ids are above those indexed before. ``keep``: more batches may follow."""
        small_batches(self.spark)
        into = None
        if keep:
            into = 0
            while into in self.levels:
                into += 1
        rows = scan_batch(batch, self.length, self.k, self.buckets)
        for level, (path, _) in self.levels.items():
            rows = rows.unionByName(self._read(path, level))
        length, buckets = self.length, self.buckets
        done = by_bucket(rows, min(buckets.count, 2 * partitions(self.spark)), lambda b, x: merge_scan(b, x, length, buckets, into, into))
        path = scratch(self.spark, f"suffix-{self.count}")
        done.write.partitionBy("level").option("compression", "none").parquet(path)
        self.paths.append(path)
        self.count += 1
        if keep:
            for level in [x for x in self.levels if x < into]:
                old, _ = self.levels.pop(level)
                discard(self.spark, f"{old}/level={level}")
            self.levels[into] = (path, into)
        del rows, done
        release(self.spark)

    def close(self) -> None:
        """Delete the levels; what has been found stays."""
        for level, (path, _) in self.levels.items():
            discard(self.spark, f"{path}/level={level}")
        self.levels = {}

    def found(self, kind: int) -> DataFrame:
        """Rows (doc, data) of a kind, over all batches."""
        out = self.spark.createDataFrame([], "doc long, data binary")
        for path in self.paths:
            out = out.unionByName(self._read(path, kind).select("doc", "data"))
        return out


def compare_edges(docs: DataFrame, candidates: DataFrame, length: int, bits: int, broadcast_rows: int = 1_000_000, flush: int = 400_000) -> DataFrame:
    """REMOVED rows of the candidates' strings that start earlier somewhere among them."""
    spark = docs.sparkSession
    wanted = materialize(candidates.groupBy("doc").agg(F.collect_list("data").alias("data")), "suffix-candidates", "none")
    ids = wanted.select("doc")
    texts = docs.join(F.broadcast(ids) if wanted.count() <= broadcast_rows else ids, "doc", "left_semi")
    rows = texts.join(wanted, "doc").select("doc", "text", "data")

    def give(held: list[np.ndarray], last: bool = False) -> Iterator[pa.RecordBatch]:
        gram, check, doc, start = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((start, doc, check, gram))
        gram, check, doc, start = gram[order], check[order], doc[order], start[order]
        again = np.zeros(len(gram), bool)
        again[1:] = (gram[1:] == gram[:-1]) & (check[1:] == check[:-1])
        out = per_document(REMOVED, doc[again], start[again], np.full(int(again.sum()), length), 1 << bits)
        gram, check, doc, start = gram[~again], check[~again], doc[~again], start[~again]
        if not last:
            for b, x, y in by_leading_bits(gram, bits):
                out.append((b, NEW, 0, freeze(np.diff(gram[x:y], prepend=U(0)), check[x:y], doc[x:y], start[x:y].astype("<u4"))))
        for i in range(0, len(out), 2000):
            yield batch_of(out[i : i + 2000])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            data, offsets = buffer(batch.column(1))
            for i, (doc, blobs) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                text = data[offsets[i] : offsets[i + 1]]
                pairs = [thaw(x, "<i8", "<i4") for x in blobs]
                start, n = (np.concatenate(x).astype(I) for x in zip(*pairs, strict=True))
                row, j = ragged(n)
                at = np.unique(start[row] + j)
                at = at[at + length <= len(text)]
                if not len(at):
                    continue
                gram, other = (span_hash(prefix_hash(x), at, at + length) for x in (text, ~text))
                held.append((gram, other.astype("<u4"), np.full(len(at), doc, I), at))
                size += len(at)
                if size >= flush:
                    yield from give(held)
                    held, size = [], 0
        if held:
            yield from give(held)

    small_batches(spark)
    packed = rows.mapInArrow(scan, ROWS)

    def work(_: int, blobs: list[tuple[int, bytes]]) -> list[tuple]:
        out: list[tuple] = []
        held = []
        for _, x in blobs:
            step, check, doc, start = thaw(x, "<u8", "<u4", "<i8", "<u4")
            held.append((np.cumsum(step, dtype=U), check, doc, start.astype(I)))
        for b in give(held, last=True):
            out += [tuple(r.values()) for r in b.to_pylist()]
        return out

    return by_bucket(packed, max(1, min(1 << bits, 2 * partitions(spark))), work)


def spans_of(blobs: list[bytes] | None, size: int) -> list[tuple[int, int]]:
    """Maximal spans of the union of packed (start, n) pairs, within ``size`` bytes."""
    if not blobs:
        return []
    start, n = (np.concatenate(x).astype(I) for x in zip(*[thaw(b, "<i8", "<i4") for b in blobs], strict=True))
    end = np.minimum(start + n, size)
    start, end = start[start < end], end[start < end]
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    if not len(start):
        return []
    new = np.concatenate([[True], start[1:] > end[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])
    return list(zip(start[new].tolist(), end[last].tolist(), strict=True))


def repeated_spans(docs: DataFrame, length: int = 100, batches: int = 4, k: int = 24, entries_per_bucket: int = 20_000) -> DataFrame:
    """Rows (doc, data): packed spans of the strings of ``length`` bytes that also start earlier. ``docs`` has (doc, text), doc not null."""
    splits = split_points(docs.select("doc"), F.col("doc"), batches)
    index = SuffixIndex(docs, length, k, entries_per_bucket)
    for i in range(len(splits) + 1):
        batch = docs
        if i:
            batch = batch.filter(F.col("doc") >= splits[i - 1])
        if i < len(splits):
            batch = batch.filter(F.col("doc") < splits[i])
        index.add(batch, keep=i < len(splits))
    index.close()
    edges = materialize(compare_edges(docs, index.found(CANDIDATE), length, index.bits).select("doc", "data"), "suffix-edges", "none")
    release(docs.sparkSession)
    return index.found(REMOVED).unionByName(edges)


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a long column that tells its rows apart, in the order of doc_id, and that column's name."""
    name = free_name(docs, "doc")
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST))
    if not docs.groupBy(own.alias("id")).count().filter("count > 1").head(1):
        return docs.withColumn(name, own), name
    rows = docs.withColumn(name, F.xxhash64("text")).repartitionByRange(2 * partitions(docs.sparkSession), own, name).sortWithinPartitions(own, name)
    return materialize(rows.withColumn(name, F.monotonically_increasing_id()), "suffix-rows"), name


def spanned(docs: DataFrame, **options) -> tuple[DataFrame, str]:
    """``docs`` with a column of the packed spans to remove, and that column's name."""
    rows, key = keyed(docs)
    spans = free_name(rows, "spans")
    found = repeated_spans(rows.select(F.col(key).alias("doc"), "text"), **options).groupBy(F.col("doc").alias(key)).agg(F.collect_list("data").alias(spans))
    return rows.join(found, key, "left").drop(key), spans


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every repeated byte cut from ``text``; a character that loses a byte goes whole. n_chars follows where it is a column."""
    small_batches(docs.sparkSession)
    rows, spans = spanned(docs, **options)
    names = docs.columns
    at = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            columns = list(batch.columns[:-1])
            for i, blobs in enumerate(batch.column(len(names)).to_pylist()):
                if blobs and texts[i]:
                    texts[i] = kept_bytes(texts[i].encode(), spans_of(blobs, len(texts[i].encode()))).decode(errors="ignore")
            columns[at] = pa.array(texts, pa.string())
            if "n_chars" in names:
                columns[names.index("n_chars")] = pa.array([len(t or "") for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select(*names, spans).mapInArrow(cut, docs.schema)


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join(out) + raw[at:]


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def removal_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, sizes, the removed spans and the SHA-256 of the remaining bytes of every row."""
    small_batches(docs.sparkSession)
    rows, found = spanned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), **options)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            raw = [(t or "").encode() for t in batch.column(1).to_pylist()]
            spans = [spans_of(x, len(r)) for x, r in zip(batch.column(2).to_pylist(), raw, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(r) for r in raw], pa.int64()),
                    pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                    pa.array([len(s) for s in spans], pa.int64()),
                    pa.array([hashlib.sha256(kept_bytes(r, s)).hexdigest() for r, s in zip(raw, spans, strict=True)]),
                    pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], span),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return rows.select("doc_id", "text", found).mapInArrow(report, SCHEMA)
