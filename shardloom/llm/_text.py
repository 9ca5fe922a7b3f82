"""Vectorized byte kernels over the text column of an Arrow batch.

A batch's texts lie in one buffer of UTF-8 bytes, so words, hashes and counts are
computed for all of its documents at once with numpy; no kernel loops over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_B = U(0x9E3779B97F4A7C15)  # odd, so invertible modulo 2**64
_B_INV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that separate words: ASCII blank and \t \n \v \f \r.
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes that are not a letter, a digit or part of a non-ASCII character.
MARK = np.ones(256, dtype=bool)
MARK[48:58] = MARK[65:91] = MARK[97:123] = MARK[128:] = False


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_TABLE = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))


def buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    wide = pa.types.is_large_string(column.type)
    _, at, data = column.buffers()
    if n == 0 or at is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        have = np.full(size, base, U)
        have[0] = U(1)
        have = _POWERS[name] = np.multiply.accumulate(have)
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with len(data)+1 entries; ``span_hash`` of any span follows from it in constant time."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum(_TABLE[data] * _powers("down", _B_INV, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span [start, end)."""
    up = _powers("up", _B, len(prefix))
    return mix((prefix[end] - prefix[start]) * up[start] + (end - start).astype(U) * U(0xA24BAED4963EE407))


def window_hashes(prefix: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive bytes, as ``span_hash`` gives it."""
    return mix((prefix[width:] - prefix[:-width]) * _powers("up", _B, len(prefix))[: len(prefix) - width] + U(width * 0xA24BAED4963EE407 & (1 << 64) - 1))


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of every word; words never cross documents."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~separator[data]
    full = offsets[1:] > offsets[:-1]
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    before[offsets[:-1][full]] = False
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][full] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document index) of every lower-cased word."""
    start, end, doc = words(data, offsets, separator)
    return span_hash(prefix_hash(LOWER[data]), start, end), doc


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, as (values, bounds); values are sorted within a document.

    A document with 1 to width-1 words has its whole word sequence as its one shingle,
    one without words has none.
    """
    w, doc = word_hashes(data, offsets, BLANK)
    n = len(offsets) - 1
    counts = np.bincount(doc, minlength=n)
    k = len(w)
    step = [U(pow(0xC6A4A7935BD1E995, j, 1 << 64)) for j in range(width + 1)]
    hashes, owner = np.zeros(0, U), np.zeros(0, np.int64)
    if k >= width:
        acc = np.zeros(k - width + 1, U)
        for j in range(width):
            acc += w[j : k - width + 1 + j] * step[j]
        same = doc[: k - width + 1] == doc[width - 1 :]
        hashes, owner = mix(acc[same] + U(width)), doc[: k - width + 1][same]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.concatenate([[0], np.cumsum(counts)])[short]
        acc = np.zeros(len(short), U)
        for j in range(width - 1):
            has = counts[short] > j
            acc[has] += w[first[has] + j] * step[j]
        hashes, owner = np.concatenate([hashes, mix(acc + counts[short].astype(U))]), np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        keep = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
        hashes, owner = hashes[keep], owner[keep]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int64)


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position in row) of a ragged array with these row lengths."""
    total = int(lengths.sum())
    row = np.repeat(np.arange(len(lengths)), lengths)
    return row, np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def list_array(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from flat values and row bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))
