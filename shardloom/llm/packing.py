"""Packing along a space-filling curve.

Each document's token counts are hashed into a vector, projected to a few dimensions and
placed on a Hilbert curve; documents are sorted by their place and their tokens laid end to end,
so that a sequence holds neighbouring documents and only the last one is padded.

Scale: one pass tokenizes and keeps the ids (two bytes each) in the shared folder; a sketch of the keys gives
ranges of near equal document counts, the low key bits being a hash of the id, so copies that share a
place on the curve spread too; the driver holds one token sum per range; one shuffle brings
each range together in order, and the cuts follow from its first token's position.

Edge cases: null and empty texts are documents of the end id alone; a null doc_id is a key like any other;
repeated rows are packed one by one; very long texts are cut over many sequences; an empty table packs nothing;
extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._ranges import partitions, range_of, split_points
from ._store import materialize, small_batches
from ._text import BLANK, LOWER, buffer, mix, prefix_hash, ragged, span_hash, words

U = np.uint64

def _bytes_in(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Bytes of letters in a plain part: ASCII letters and two-byte characters.
_LETTER = _bytes_in((65, 90), (97, 122), (128, 255))
#: Bytes that make a part not plain: the apostrophe, which may begin a suffix, and leading bytes of characters outside U+00C0 to U+023F.
_ODD = _bytes_in((39, 39), (0, 8), (14, 31), (127, 127), (0xC0, 0xC2), (0xC9, 0xFF))
_NO_MARK = re.compile(rb"[0-9]")


class Tokens:
    """Ids of texts from the ids of their units, which no token crosses.

    Parts between ASCII white space are units. A plain part, of ASCII and letters below U+0240 without apostrophes, is cut further where
    letters meet other characters, as the tokenizer's pattern does, and its ASCII letters are lower-cased, as the
    tokenizer does. Units are told apart by a 64-bit hash of their bytes and their length; a batch looks up each
    distinct one once. Runs of letters or of marks are one unit of the pattern, whose last id is one that ends a word; so many of them
    are encoded as one text and cut apart at those ids. Up to ``most`` units are cached.
    """

    def __init__(self, path: str, most: int = 600_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.odd = _ODD.copy()
        for token in self.tokenizer.get_added_tokens_decoder().values():
            self.odd[token.content.encode()[0]] = True
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.row = np.zeros(0, U), np.zeros(0, np.int64)  # sorted hashes and the rows of their ids
        self.store = np.zeros(1 << 20, self.kind)
        self.first = np.zeros(self.most + 1, np.int64)

    def _one_by_one(self, units: list[bytes]) -> list[bytes]:
        out = []
        for i in range(0, len(units), 256):
            out += [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast([w.decode("utf-8", "surrogatepass") for w in units[i : i + 256]], add_special_tokens=False)]
        return out

    def _together(self, units: list[bytes]) -> list[bytes]:
        out = []
        for i in range(0, len(units), 512):
            some = units[i : i + 512]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, self.kind)
            cut = ((np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize).tolist()
            if len(cut) != len(some):
                out += self._one_by_one(some)
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *cut[:-1]], cut, strict=True)]
        return out

    def _learn(self, hashes: np.ndarray, units: list[bytes], plain: np.ndarray) -> None:
        """Add rows for these units; a plain one with a digit is several units of the pattern."""
        single = plain & np.array([not _NO_MARK.search(u) for u in units], bool)
        order = np.concatenate([np.flatnonzero(single), np.flatnonzero(~single)])
        k, n = int(single.sum()), len(self.hashes)
        ids = self._together([units[i] for i in order[:k]]) + self._one_by_one([units[i] for i in order[k:]])
        bounds = self.first[n] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize)
        if n + len(ids) + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros(n + len(ids), np.int64)])
        if bounds[-1] > len(self.store):
            self.store = np.concatenate([self.store, np.zeros(int(bounds[-1]), self.kind)])
        self.store[self.first[n] : bounds[-1]] = np.frombuffer(b"".join(ids), self.kind)
        self.first[n + 1 : n + 1 + len(ids)] = bounds
        every, row = np.concatenate([self.hashes, hashes[order]]), np.concatenate([self.row, np.arange(n, n + len(ids))])
        order = np.argsort(every, kind="stable")
        self.hashes, self.row = every[order], row[order]

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, whether known) of each hash."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.row[at], self.hashes[at] == hashes

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """(bytes, start, end, document, whether plain) of every unit."""
        start, end, doc = words(data, offsets, BLANK)
        odd = self.odd[data]
        odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))  # the multiplication and division signs
        odd[1:] |= (data[:-1] == 0xC4) & (data[1:] == 0xB0)  # the dotted capital I, whose lower case has a mark
        count = np.concatenate([[0], np.cumsum(odd)])
        plain = count[end] == count[start]
        letter = _LETTER[data]
        edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        part = np.searchsorted(start, edge, side="right") - 1
        ok = part >= 0
        edge, part = edge[ok], part[ok]
        inner = plain[part] & (edge > start[part]) & (edge < end[part])
        edge, part = edge[inner], part[inner]
        first = np.concatenate([start, edge])
        order = np.argsort(first, kind="stable")
        owner = np.concatenate([np.arange(len(start)), part])[order]
        first = first[order]
        last = np.append(first[1:], 0)
        whole = np.append(owner[1:] != owner[:-1], True)
        last[whole] = end[owner[whole]]
        step = np.zeros(len(data) + 1, np.int8)
        step[start[plain]] += 1
        step[end[plain]] -= 1
        low = np.where(np.cumsum(step[:-1], dtype=np.int8) > 0, LOWER[data], data)
        return low, first, last, doc[owner], plain[owner]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the texts of a buffer."""
        n = len(offsets) - 1
        if BLANK[data].all():
            return np.zeros(0, self.kind), np.zeros(n + 1, np.int64)
        data, start, end, doc, plain = self._units(data, offsets)
        found, at, back = np.unique(span_hash(prefix_hash(data), start, end) ^ plain.astype(U), return_index=True, return_inverse=True)
        row, known = self._find(found)
        if not known.all():
            if len(self.hashes) + len(found) > self.most:
                self._clear()
                known[:] = False
            raw, where = data.tobytes(), at[~known]
            self._learn(found[~known], [raw[x:y] for x, y in zip(start[where].tolist(), end[where].tolist(), strict=True)], plain[where])
            row, _ = self._find(found)
        row = row[back]
        size = self.first[row + 1] - self.first[row]
        unit, j = ragged(size)
        return self.store[self.first[row][unit] + j], np.concatenate([[0], np.cumsum(np.bincount(doc, weights=size, minlength=n))]).astype(np.int64)


_LOADED: dict[str, Tokens] = {}


def tokens_of(path: str) -> Tokens:
    """One tokenizer per worker process, whose cache outlives a task."""
    if path not in _LOADED:
        _LOADED[path] = Tokens(path)
    return _LOADED[path]


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``x``, non-negative integers below 2**bits (Skilling's transpose)."""
    x = x.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & p
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = np.where(high, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def vectors(ids: np.ndarray, bounds: np.ndarray, width: int, dimensions: int, seed: int = 11) -> np.ndarray:
    """Hashed, damped and normalized token counts of each document, projected to ``dimensions``."""
    project = np.random.default_rng(seed).normal(size=(width, dimensions))
    slot = (mix(ids.astype(U)) % U(width)).astype(np.int64)
    out = np.zeros((len(bounds) - 1, dimensions))
    for i in np.flatnonzero(np.diff(bounds)):
        v = np.sqrt(np.bincount(slot[bounds[i] : bounds[i + 1]], minlength=width))
        out[i] = (v / np.linalg.norm(v)) @ project
    return out


def curve_key(doc_id: np.ndarray, ids: np.ndarray, bounds: np.ndarray, width: int = 512, dimensions: int = 4, bits: int = 11) -> np.ndarray:
    """44 bits of the curve, then 19 of a hash of the id."""
    share = 1 / (1 + np.exp(-1.702 * vectors(ids, bounds, width, dimensions)))
    place = hilbert(np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)
    return (place << 19) | (mix(doc_id.astype(np.int64).view(U)) >> U(45)).astype(np.int64)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = 1, slice_bytes: int = 2_000_000) -> DataFrame:
    """doc_id, key on the curve, n tokens, ids (little-endian) of each document, the end id last."""
    small_batches(docs.sparkSession, 1024)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer)
        width = tokens.kind.itemsize
        for batch in batches:
            data, offsets = buffer(batch.column(1))
            a = 0
            while a < len(batch):  # a slice has one document at least
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + slice_bytes, side="right")) - 1)
                b = min(b, len(batch))
                ids, bounds = tokens.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                doc_id = batch.column(0).slice(a, b - a)
                key = curve_key(doc_id.fill_null(0).to_numpy(zero_copy_only=False), ids, bounds)
                full = np.insert(ids, bounds[1:], np.array(end_id, tokens.kind))
                edge = (bounds + np.arange(b - a + 1)) * width
                blobs = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(edge.astype(np.int32).tobytes()), pa.py_buffer(full.tobytes())])
                yield pa.RecordBatch.from_arrays([doc_id, pa.array(key), pa.array(np.diff(edge) // width), pa.array(np.full(b - a, width, np.int32)), blobs], names=["doc_id", "key", "n", "width", "ids"])
                a = b

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, key long, n long, width int, ids binary")


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, keep_ids: bool = True) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, its checksum and (``keep_ids``) its ids."""
    spark = docs.sparkSession
    rows = materialize(tokenize(docs, tokenizer, end_id), "packing-ids", "zstd")
    splits = split_points(rows, F.col("key"), 2 * partitions(spark))
    part = range_of(F.col("key"), splits)
    sums = sorted((r["part"], r["n"]) for r in rows.groupBy(part.alias("part")).agg(F.sum("n").alias("n")).collect())
    base = dict(zip([p for p, _ in sums], np.cumsum([0, *[n for _, n in sums]]).tolist(), strict=False))
    # A range's neighbours go to the same task, in order.
    dealt = rows.withColumn("part", part).repartition(len(base) or 1, "part").sortWithinPartitions("part", "key", "doc_id", "n", "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")] + ["ids"] * keep_ids
        now, at = None, 0
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*[batch.column(x).to_pylist() for x in ("doc_id", "n", "width", "ids", "part")], strict=True):
                doc_id, n, width, raw, p = row
                if p != now:
                    now, at = p, base[p]
                ids = np.frombuffer(raw, "<u2" if width == 2 else "<u4").astype("<u4")
                edges = sorted({at, at + n, *range(-(-at // length) * length, at + n, length)})
                for a, b in pairwise(edges):
                    piece = ids[a - at : b - at].tobytes()
                    out.append((doc_id, a - at, b - a, zlib.crc32(piece), n, a // length, a % length, piece)[: 7 + keep_ids])
                at += n
            columns = [pa.array(c, pa.binary() if i == 7 else pa.int64()) for i, c in enumerate(zip(*out, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return dealt.mapInArrow(cut, SCHEMA + ", ids binary" * keep_ids)
