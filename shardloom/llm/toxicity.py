"""Toxicity by multiple-instance learning: sentence scores joined by noisy-or, trained from document labels.

A document is a bag of sentences. A sentence's probability is a logistic function of its words;
the document is toxic if any sentence is: P = 1 - prod(1 - p). Only document labels are given,
and the gradient of the bag's likelihood tells the sentences apart, so that scoring locates them.

Training: a bounded sample of labelled rows (at most ``max_docs`` documents, the smallest by a hash of the id, and at most
``max_bytes`` bytes in all, of which documents over a 200th come last and those that don't fit are passed over) is gathered as hashed words, one row for each sampled
id; so the driver holds no more than that of text whatever the input. Scoring is one pass over all texts
without a shuffle, with ``2**bits`` weights sent along.

Edge cases: null and empty texts have no sentence and so score 0 words' worth, the background rate of one
empty sentence; without labelled rows of both classes every score is their share of 1 (0.5 if
none); rows whose label is null teach nothing; repeated rows are scored one by one; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import small_batches
from ._text import LOWER, MARK, buffer, prefix_hash, span_hash, words
from .quality import bucket, labelled_rows

_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True
STEMS = (4, 5, 6, 7)


def sentence_words(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """(feature slot, its sentence; start, end, document of each sentence): sentences end at . ! ? or a line's end.

    Features are whole words and, for stems, the word beginnings of 4 to 7 bytes.
    """
    s_start, s_end, s_doc = words(data, offsets, _ENDS)
    start, end, _ = words(data, offsets, MARK)
    sentence = np.searchsorted(s_start, start, side="right") - 1
    prefix = prefix_hash(LOWER[data])
    hashes, owner = [span_hash(prefix, start, end)], [sentence]
    for n in STEMS:
        longer = end - start > n
        hashes.append(span_hash(prefix, start[longer], start[longer] + n) ^ np.uint64(n))
        owner.append(sentence[longer])
    return (np.concatenate(hashes) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(owner), s_start, s_end, s_doc


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def noisy_or(logits: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """1 - prod(1 - sigmoid(logit)) over the sentences of each document."""
    return -np.expm1(-np.bincount(doc, weights=softplus(logits), minlength=n))


class Model:
    """Weights of hashed words and the bias of a sentence."""

    def __init__(self, bits: int):
        self.bits, self.weights, self.bias, self.constant = bits, np.zeros(1 << bits, np.float32), -4.0, None

    def logits(self, slot: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        """The logits of n sentences; a feature counts once in a sentence, as in training."""
        known = self.weights[slot] != 0
        once = np.unique(sentence[known] << self.bits | slot[known])
        return np.bincount(once >> self.bits, weights=self.weights[once & (1 << self.bits) - 1], minlength=n) + self.bias


def bag_gradient(w: np.ndarray, bias: float, slot: np.ndarray, sentence: np.ndarray, doc: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, float]:
    """(loss, gradient by w, by bias) of the mean negative log-likelihood of the bags' labels.

    Feature ``slot[i]`` is in sentence ``sentence[i]``, and ``doc`` has the bag of each sentence.
    """
    logit = np.bincount(sentence, weights=w[slot], minlength=len(doc)) + bias
    s = np.maximum(np.bincount(doc, weights=softplus(logit), minlength=len(y)), 1e-9)
    loss = np.where(y == 1, -np.log(-np.expm1(-s)), s).mean()
    per_doc = np.where(y == 1, -np.exp(-s) / -np.expm1(-s), 1.0)
    grad = per_doc[doc] / (1 + np.exp(-logit)) / len(y)
    return float(loss), np.bincount(slot, weights=grad[sentence], minlength=len(w)), float(grad.sum())


def train(bags: list[tuple], y: np.ndarray, bits: int, least: int = 5, most_words: int = 1500, steps: int = 150, rate: float = 0.15, decay: float = 5e-3) -> Model:
    """Full-batch Adam on the bags' likelihood. A bag is (word slots, their sentences, number of sentences); the list is emptied.

    Features seen in fewer than ``least`` documents, and beyond the ``most_words`` that differ most
    between the classes, keep weight 0.
    """
    model = Model(bits)
    if not len(y) or y.min() == y.max():
        model.constant = float(y.mean()) if len(y) else 0.5
        return model
    count = np.array([b[2] for b in bags])
    first = np.cumsum(count) - count
    slot = np.concatenate([b[0] for b in bags])
    sentence = np.concatenate([b[1] + np.asarray(f, b[1].dtype) for b, f in zip(bags, first, strict=True)])
    doc = np.repeat(np.arange(len(bags)), count)
    bags.clear()
    pair = doc[sentence] << bits
    pair |= slot
    pair.sort()
    pair = pair[np.concatenate([[True], pair[1:] != pair[:-1]])] if len(pair) else pair
    word = pair % (1 << bits)
    seen = np.bincount(word, minlength=1 << bits)
    hit = np.bincount(word, weights=y[pair >> bits], minlength=1 << bits)
    share = y.mean()
    apart = np.abs(hit - seen * share) / np.sqrt(seen * share * (1 - share) + 1)
    use = np.flatnonzero(seen >= least)
    use = np.sort(use[np.argsort(-apart[use], kind="stable")[:most_words]])
    index = np.full(1 << bits, -1)
    index[use] = np.arange(len(use))
    keep = index[slot] >= 0
    slot, sentence = index[slot[keep]], sentence[keep]
    once = np.unique(sentence * np.int64(max(1, len(use))) + slot)
    sentence, slot = once // max(1, len(use)), once % max(1, len(use))
    w, bias = np.zeros(len(use)), float(np.log(share / max(1.0, count.mean())))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        _, g, gb = bag_gradient(w, bias, slot, sentence, doc, y)
        g = g + decay * w / np.sqrt(len(y))
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix = np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        w -= rate * fix * m / (np.sqrt(v) + 1e-8)
        bias -= rate * fix * mb / (np.sqrt(vb) + 1e-8)
    model.weights[use] = w
    model.bias = bias
    return model


def within_bytes(listed: list[tuple[int, tuple]], most: int) -> list[tuple]:
    """Of (size, row) in order those that fit into ``most`` bytes together: small ones first, then those over a 200th of it; what doesn't fit is passed over."""
    out, left = [], most
    for size, row in sorted(listed, key=lambda x: 200 * x[0] > most):
        if size <= left:
            out.append(row)
            left -= size
    return out


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, out: int = 2, bits: int = 18, max_docs: int = 6000, max_bytes: int = 24_000_000, **options) -> Model:
    """Learn from labelled rows outside fold ``out``: a sample of at most ``max_docs`` documents and ``max_bytes`` bytes.

    Of rows that share an id, the one with the longest text is taken, of equal length that of the greatest hash.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length("text").alias("size"), F.xxhash64("text").alias("print")).filter(F.col("size").between(1, max_bytes))
    sample = labelled_rows(ids, labels, "toxic", F.coalesce(bucket("doc_id", folds) != out, F.lit(False)))
    sample = sample.groupBy("doc_id", "y").agg(F.max(F.struct("size", "print")).alias("x")).select("doc_id", "y", "x.*")
    turn = [F.xxhash64("doc_id", F.lit("sample")), F.col("doc_id")]
    listed = [(r["size"], (r["doc_id"], r["y"], r["print"])) for r in sample.orderBy(*turn).limit(max_docs).collect()]
    chosen = docs.sparkSession.createDataFrame(within_bytes(listed, max_bytes), "doc_id long, y double, print long")  # at most max_docs rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("print")).join(F.broadcast(chosen), ["doc_id", "print"])
    texts = texts.dropDuplicates(["doc_id", "print", "y"])

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffer(batch.column(0))
            slot, sentence, s_start, _, s_doc = sentence_words(data, offsets, bits)
            n = np.bincount(s_doc, minlength=len(batch))
            first = np.cumsum(n) - n
            order = np.argsort(sentence, kind="stable")
            slot, sentence = slot[order], sentence[order]
            of = s_doc[sentence] if len(sentence) else sentence
            cut = np.searchsorted(of, np.arange(len(batch) + 1))
            slot, inner = slot.astype(np.int32), (sentence - first[of]).astype(np.int32)
            rows = [(slot[a:b].tobytes(), inner[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()), pa.array(n, pa.int64()), batch.column(1)], names=["slots", "sentences", "n", "y"])

    got = texts.select("text", "y").mapInArrow(bag, "slots binary, sentences binary, n long, y double").toArrow()
    bags = [(np.frombuffer(a.as_py(), np.int32), np.frombuffer(b.as_py(), np.int32), c.as_py(), y.as_py()) for a, b, c, y in zip(got["slots"], got["sentences"], got["n"], got["y"], strict=True)]
    del got  # the driver holds the sample once
    bags.sort(key=lambda x: (x[2], x[0].tobytes()))
    return train(bags, np.array([x[3] for x in bags], float), bits, **options)


SCHEMA = "doc_id long, score double, offending array<struct<start:long,end:long,score:double>>"


def score_documents(docs: DataFrame, model: Model, offends: float = 0.3) -> DataFrame:
    """doc_id, score, and the byte spans of the sentences whose own probability is at least ``offends``."""
    small_batches(docs.sparkSession)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            data, offsets = buffer(batch.column(1))
            slot, sentence, s_start, s_end, s_doc = sentence_words(data, offsets, model.bits)
            logit = model.logits(slot, sentence, len(s_start))
            empty = np.flatnonzero(np.bincount(s_doc, minlength=n) == 0)
            score = noisy_or(np.concatenate([logit, np.full(len(empty), model.bias)]), np.concatenate([s_doc, empty]), n)
            if model.constant is not None:
                score[:] = model.constant
            p = 1 / (1 + np.exp(-logit))
            bad = np.flatnonzero(p >= offends)
            spans = pa.StructArray.from_arrays([pa.array(s_start[bad] - offsets[s_doc[bad]]), pa.array(s_end[bad] - offsets[s_doc[bad]]), pa.array(p[bad])], fields=list(span))
            bounds = np.concatenate([[0], np.cumsum(np.bincount(s_doc[bad], minlength=n))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(score, 0, 1)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans)], names=["doc_id", "score", "offending"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, SCHEMA)


def classify_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, out: int = 2, threshold: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending spans of every row; labels of fold ``out`` are never used."""
    model = fit(docs, labels, folds, out, **options)
    held = F.coalesce(bucket("doc_id", folds) == out, F.lit(False))
    return score_documents(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "offending")
