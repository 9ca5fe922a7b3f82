"""Benchmark decontamination: a BM25 inverted index of the test items, queried by every training passage with block-max WAND.

A document is cut into segments; a passage is two neighbouring segments, so an item no longer than a segment lies whole in one. Items are taken
in classes by their length (up to 64 words, 128, 256 and so on), each with segments of that length, so that an item's passages never depend on other items.
An item is a contamination of a passage that holds at least ``least_question`` of the shingles of its question and ``least_answer`` of
those of its answer. The index's terms are such shingles of three words too (all words of a shorter item), with their own frequencies. A posting's impact is its BM25 share of the item's score for its own text. Each item has the threshold that every such
passage must reach: the shares of the lightest shingles that could do are added up. So what is retrieved
leaves out no contamination, and whether an item is found depends on its text and the passage alone; BM25 over all items decides what has to be looked at.

Passages are first dropped, many at a time, by two upper bounds: the sum of
their terms' greatest impacts, and that of each block of items. Those with a block left go through block-max WAND: cursors in the
terms' lists sorted by item, a pivot where the greatest impacts reach the threshold, a skip behind the pivot's block where
its block maxima don't, and a score only where all cursors up to the pivot stand on it. Every item at or above its threshold is retrieved and verified.

Question and answer: an item's text up to its last question mark and the rest; without one, all
but the last sentence and the last sentence. An item of one sentence is all question.

Scale: one pass over the texts without a shuffle. The index goes with the tasks; items are taken in
blocks of at most ``index_bytes`` bytes of text or so, one pass for each, so its size is bounded. Document frequencies and the mean
length are those of all items, whatever the blocks and classes.

Edge cases: null and empty texts, and items without words, hit nothing; items of equal text and different ids are each reported, repeated rows once;
an empty table on either side gives no rows; repeated rows are reported one by one; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import materialize, small_batches
from ._text import LOWER, MARK, buffer, mix, prefix_hash, ragged, span_hash, words

U, I = np.uint64, np.int64
TERM = 3  # words of an index term


def shingles(hashes: np.ndarray, width: int = 3) -> np.ndarray:
    """Hashes of all ``width`` consecutive words, of the whole if there are fewer."""
    width = min(width, len(hashes))
    if not width:
        return np.zeros(0, U)
    out = np.zeros(len(hashes) - width + 1, U)
    for j in range(width):
        out = mix(out * U(31) + hashes[j : len(hashes) - width + 1 + j])
    return out


def terms_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """Index terms of a text: its words, or its shingles of more words."""
    return hashes if width == 1 else shingles(hashes, width)


def word_hashes(text: str) -> np.ndarray:
    data, offsets = buffer(pa.array([text]))
    start, end, _ = words(data, offsets, MARK)
    return span_hash(prefix_hash(LOWER[data]), start, end)


def question_and_answer(text: str) -> tuple[str, str]:
    if "?" in text.rstrip()[:-1]:
        at = text.rstrip()[:-1].rindex("?") + 1
        return text[:at], text[at:]
    ends = [m.end() for m in re.finditer(r"[.!?](?=\s)|\n", text.rstrip())]
    at = ends[-1] if ends else len(text)
    return text[:at], text[at:]


class Corpus:
    """Statistics of all items: their number, mean length in terms, and the number of items that hold a term."""

    def __init__(self, items: int, average: float, terms: np.ndarray, df: np.ndarray):
        self.items, self.average, self.terms, self.df = items, average, terms, df

    @classmethod
    def of(cls, bags: list[np.ndarray]) -> Corpus:
        terms, df = np.unique(np.concatenate([np.unique(x) for x in bags]) if bags else np.zeros(0, U), return_counts=True)
        size = [len(x) for x in bags]
        return cls(len(bags), float(np.mean(size)) if bags else 0.0, terms, df)

    def frequencies(self, terms: np.ndarray) -> np.ndarray:
        return self.df[np.searchsorted(self.terms, terms)] if len(terms) else np.zeros(0, I)


def lightest(shares: np.ndarray, terms: list[np.ndarray], parts: list[tuple[list[np.ndarray], float]]) -> float:
    """A bound that the shares of a passage's terms reach if it holds enough of the shingles of each part.

    ``shares`` are those of ``terms``; a part has the terms of each of its distinct shingles and the part of them that a passage must hold. A
    term's share is dealt evenly to the shingles with it, so the shares of the terms of some shingles are at least what these were dealt.
    """
    every = [np.searchsorted(terms, np.unique(g)) for grams, _ in parts for g in grams]
    holders = np.bincount(np.concatenate(every), minlength=len(terms)) if every else np.zeros(len(terms))
    dealt = [float((shares[t] / holders[t]).sum()) for t in every]
    bound, at = 0.0, 0
    for grams, least in parts:
        own = sorted(dealt[at : at + len(grams)])
        at += len(grams)
        bound += sum(own[: int(np.ceil(least * len(grams) - 1e-9))])
    return bound


class Index:
    """Postings in term order, items in blocks, and the greatest impact of each term in each block.

    Terms are ``term_words`` words in a row, words by default. With ``least``, the parts of a question's and an answer's shingles that a passage must
    hold, impacts are in units of each item's threshold.
    """

    def __init__(self, ids: list[int], texts: list[str], k1: float = 1.2, b: float = 0.75, block: int = 4, corpus: Corpus | None = None, least: tuple[float, float] | None = None, stride: int = 64, term_words: int = 1):
        self.ids, self.block, self.stride, self.term_words = ids, block, stride, term_words
        hashed = [word_hashes(t or "") for t in texts]
        bags = [terms_of(x, term_words) for x in hashed]
        length = np.array([len(x) for x in bags], float)
        corpus = corpus or Corpus.of(bags)
        average = max(corpus.average, 1.0)
        pairs = [np.unique(x, return_counts=True) for x in bags]
        term = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, U)
        item = np.repeat(np.arange(len(bags)), [len(p[0]) for p in pairs])
        tf = np.concatenate([p[1] for p in pairs]).astype(float) if pairs else np.zeros(0)
        self.terms, at = np.unique(term, return_inverse=True)
        own_df = np.bincount(at, minlength=len(self.terms))
        df = corpus.frequencies(self.terms)
        idf = np.log1p((corpus.items - df + 0.5) / (df + 0.5))
        score = idf[at] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length[item] / average))
        own = np.bincount(item, weights=score, minlength=len(bags))
        share = score / own[item]
        self.width = [max(1, min(3, len(x))) for x in hashed]
        self.question, self.answer, self.floor = [], [], np.ones(len(bags))
        edge = np.searchsorted(item, np.arange(len(bags) + 1))
        for i, (bag, text, width) in enumerate(zip(hashed, texts, self.width, strict=True)):
            n = len(word_hashes(question_and_answer(text or "")[0]))
            every = shingles(bag, width)
            cut = max(0, n - width + 1)  # a shingle with a word of the answer is the answer's
            (q, q_at), (a, a_at) = (np.unique(x, return_index=True) for x in (every[:cut], every[cut:]))
            self.question.append(q)
            self.answer.append(a)
            if least is not None and len(bag):
                grams = [[terms_of(bag[k : k + width], term_words) for k in at] for at in (q_at, cut + a_at)]
                self.floor[i] = lightest(share[edge[i] : edge[i + 1]], term[edge[i] : edge[i + 1]], list(zip(grams, least, strict=True)))
        order = np.lexsort((item, at))
        self.item, self.impact = item[order], (share / self.floor[item])[order]
        self.first = np.concatenate([[0], np.cumsum(own_df)])
        self.most = np.zeros(len(self.terms))
        np.maximum.at(self.most, at[order], self.impact)
        key = at[order] * I(len(bags) // block + 1) + self.item // block
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        where = np.flatnonzero(new)
        self.block_of = (self.item // block)[where]
        self.block_most = np.maximum.reduceat(self.impact, where) if len(where) else np.zeros(0)
        self.block_first = np.concatenate([[0], np.cumsum(np.bincount(at[order][where], minlength=len(self.terms)))])
        self.read = 0  # postings that search has looked at

    @staticmethod
    def _spread(first: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``term``, place in the lists) of all list entries of these terms."""
        row, j = ragged(first[term + 1] - first[term])
        return row, first[term[row]] + j

    def search(self, passage: np.ndarray, term: np.ndarray, threshold: float, chunk: int = 2000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, score) of all items scoring at least ``threshold``; rows are the distinct terms of each passage, sorted by it."""
        out: list[tuple[int, int, float]] = []
        names = np.unique(passage)
        blocks = len(self.ids) // self.block + 1
        for i in range(0, len(names), chunk):
            some = names[i : i + chunk]
            a, b = np.searchsorted(passage, [some[0], some[-1] + 1])
            own, t = np.searchsorted(some, passage[a:b]), term[a:b]
            row, at = self._spread(self.block_first, t)
            key = own[row] * I(blocks) + self.block_of[at]
            if blocks > chunk:  # many blocks: only those that a passage meets
                met, key = np.unique(key, return_inverse=True)
            else:
                met = np.arange(len(some) * blocks)
            bound = np.bincount(key, weights=self.block_most[at], minlength=len(met))
            alive = np.unique(met[bound >= threshold - 1e-9] // blocks)
            edge = np.searchsorted(own, np.stack([alive, alive + 1]))
            for p, x, y in zip(alive.tolist(), *edge.tolist(), strict=True):
                out += [(int(some[p]), item, score) for item, score in self.wand(t[x:y].tolist(), threshold)]
        p, item, score = zip(*out, strict=True) if out else ((), (), ())
        return np.array(p, I), np.array(item, I), np.array(score, float)

    def wand(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """(item, score) of all items that reach the threshold for these terms, by block-max WAND."""
        least, size = threshold - 1e-9, self.block
        item, first, most = self.item, self.first, self.most
        cursors = [[int(item[first[t]]), int(first[t]), int(first[t + 1]), float(most[t]), t] for t in terms]
        out = []

        def forward(cursor: list, to: int) -> None:
            cursor[1] = at = bisect_left(item, to, cursor[1], cursor[2])
            cursor[0] = int(item[at]) if at < cursor[2] else -1

        while cursors:
            cursors.sort(key=lambda c: c[0])
            reach, pivot = 0.0, 0
            for c in cursors:
                reach += c[3]
                if reach >= least:
                    break
                pivot += 1
            else:
                break
            here = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == here:
                pivot += 1
            upto = cursors[: pivot + 1]
            block = here // size
            bound = 0.0
            for c in upto:
                lo, hi = int(self.block_first[c[4]]), int(self.block_first[c[4] + 1])
                at = bisect_left(self.block_of, block, lo, hi)
                if at < hi and self.block_of[at] == block:
                    bound += float(self.block_most[at])
            if bound < least:  # nothing up to the block's end, or to where another list begins, can reach the threshold
                to = (block + 1) * size
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                for c in upto:
                    forward(c, to)
            elif upto[0][0] == here:
                score = float(sum(self.impact[c[1]] for c in upto))
                self.read += len(upto)
                if score >= least:
                    out.append((here, score))
                for c in upto:
                    forward(c, here + 1)
            else:
                for c in upto:
                    if c[0] < here:
                        forward(c, here)
            cursors = [c for c in cursors if c[0] >= 0]
        return out


def contaminations(data: np.ndarray, offsets: np.ndarray, indexes: list[Index], least: tuple[float, float]) -> Iterator[tuple]:
    """(document, item's id, first word of the passage, score, question overlap, answer overlap) of all verified hits."""
    start, end, doc = words(data, offsets, MARK)
    if len(start):
        h = span_hash(prefix_hash(LOWER[data]), start, end)
        for index in indexes:
            yield from hits(h, doc, len(offsets) - 1, index, least)


def hits(h: np.ndarray, doc: np.ndarray, documents: int, index: Index, least: tuple[float, float]) -> Iterator[tuple]:
    """``contaminations`` by the items of one index, for hashed words and the document of each."""
    stride, threshold = index.stride, 1.0
    if not len(index.terms):
        return
    counts = np.bincount(doc, minlength=documents)
    first_word = np.cumsum(counts) - counts
    per = -(-counts // stride)  # segments of each document
    first_segment = np.cumsum(per) - per
    segment = first_segment[doc] + (np.arange(len(h)) - first_word[doc]) // stride
    total = int(per.sum())
    v, pairs = I(len(index.terms)), [np.zeros(0, I)]
    for width in sorted({min(index.term_words, w) for w in index.width}):  # a term belongs to the segment of its first word
        term = (h if index.term_words == 1 else shingles(h, width)) if len(h) >= width else np.zeros(0, U)
        inside = doc[: len(term)] == doc[width - 1 :]
        at = np.minimum(np.searchsorted(index.terms, term), len(index.terms) - 1)
        known = inside & (index.terms[at] == term)
        pairs.append(segment[: len(term)][known] * v + at[known])
    pair = np.unique(np.concatenate(pairs))
    seg, term = pair // v, pair % v
    bound = np.bincount(seg, weights=index.most[term], minlength=total)
    last = np.zeros(total, bool)
    last[(first_segment + per - 1)[per > 0]] = True
    alone = np.zeros(total, bool)
    alone[first_segment[per == 1]] = True
    window = bound.copy()
    window[:-1] += np.where(last[:-1], 0, bound[1:])
    alive = (window >= threshold - 1e-9) & (~last | alone)
    # A segment's terms belong to the passage that starts with it and to the one before.
    mine, before = alive[seg], np.zeros(len(seg), bool)
    inner = seg > 0
    before[inner] = alive[seg[inner] - 1] & ~last[seg[inner] - 1]
    both = np.unique(np.concatenate([seg[mine] * v + term[mine], (seg[before] - 1) * v + term[before]]))
    passages, items, scores = index.search(both // v, both % v, threshold)
    for p, i, score in zip(passages.tolist(), items.tolist(), scores.tolist(), strict=True):
        d = int(np.searchsorted(first_segment, p, side="right")) - 1
        a = int(first_word[d]) + (p - int(first_segment[d])) * stride
        here = shingles(h[a : min(a + 2 * stride, int(first_word[d] + counts[d]))], index.width[i])
        question = float(np.isin(index.question[i], here).mean()) if len(index.question[i]) else 1.0
        answer = float(np.isin(index.answer[i], here).mean()) if len(index.answer[i]) else 1.0
        if question >= least[0] - 1e-9 and answer >= least[1] - 1e-9:
            yield d, index.ids[i], a - int(first_word[d]), score * float(index.floor[i]), question, answer


def by_length(rows: list, least: tuple[float, float], least_stride: int, corpus: Corpus | None = None) -> list[Index]:
    """An index for each class of item lengths: up to ``least_stride`` words, twice that, four times and so on."""
    bags = [word_hashes(r["text"]) for r in rows]
    corpus = corpus or Corpus.of([terms_of(x, TERM) for x in bags])
    classes: dict[int, list] = {}
    for row, bag in zip(rows, bags, strict=True):
        classes.setdefault(max(0, (max(1, len(bag)) - 1) // least_stride).bit_length(), []).append(row)
    return [Index([r["item_id"] for r in got], [r["text"] for r in got], corpus=corpus, least=least, stride=least_stride << k, term_words=TERM) for k, got in sorted(classes.items())]


def build_indexes(benchmark: DataFrame, least: tuple[float, float], least_stride: int, index_bytes: int) -> Iterator[list[Index]]:
    """The indexes of each block of items of about ``index_bytes`` bytes; all have the statistics of the whole benchmark."""
    if min(least) < 0 or max(least) > 1 or not all(least):
        raise ValueError("parts of shingles are above 0 and at most 1")
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // index_bytes))

    def ordered(some: DataFrame) -> list:
        return sorted(some.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))

    if parts == 1:
        yield by_length(ordered(rows), least, least_stride)
        return
    rows = materialize(rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))), "benchmark-items")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bag = terms_of(word_hashes(text), TERM)
                terms = np.unique(bag).view(I)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([len(bag)], pa.int64()), pa.array([terms], pa.list_(pa.int64()))], names=["part", "words", "terms"])

    items = materialize(rows.select("part", "text").mapInArrow(count, "part long, words long, terms array<long>"), "benchmark-terms")
    head = items.agg(F.count("*").alias("n"), F.avg("words").alias("average")).first()
    terms = items.select("part", F.explode("terms").alias("term"))
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    known = materialize(terms.distinct().join(df, "term"), "benchmark-frequencies")
    for i in range(parts):
        own = known.filter(F.col("part") == i).select("term", "df").toArrow()
        term, n = own["term"].to_numpy().astype(I).view(U), own["df"].to_numpy().astype(I)
        order = np.argsort(term)
        yield by_length(ordered(rows.filter(F.col("part") == i)), least, least_stride, Corpus(head["n"], head["average"], term[order], n[order]))


SCHEMA = "doc_id long, item_id long, passage_word long, score double, question_overlap double, answer_overlap double"


def find_contaminations(docs: DataFrame, benchmark: DataFrame, least_question: float = 0.6, least_answer: float = 0.5, least_stride: int = 64, index_bytes: int = 32_000_000) -> DataFrame:
    """One row for each document and item found in it: the passage that scores best, with its overlaps."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    least = (least_question, least_answer)

    def finder(indexes: list[Index]):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, best = batch.column(0).to_pylist(), {}
                for d, item, at, score, q, a in contaminations(*buffer(batch.column(1)), indexes, least):
                    if (d, item) not in best or (score, -at) > (best[d, item][1], -best[d, item][0]):
                        best[d, item] = (at, score, q, a)
                if best:
                    rows = [(ids[d], item, *x) for (d, item), x in sorted(best.items(), key=lambda x: (x[0][0], x[0][1] is None, x[0][1] or 0))]
                    types = [pa.int64()] * 3 + [pa.float64()] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        return scan

    out = None
    for indexes in build_indexes(benchmark, least, least_stride, index_bytes):
        found = texts.mapInArrow(finder(indexes), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, least_question: float = 0.6, least_answer: float = 0.5, least_stride: int = 64, index_bytes: int = 32_000_000) -> DataFrame:
    """``docs`` without the documents that hold a test item; columns and values as they were."""
    small_batches(docs.sparkSession)
    names, at, least = docs.columns, docs.columns.index("text"), (least_question, least_answer)

    def keeper(indexes: list[Index]):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(len(batch), bool)
                keep[[x[0] for x in contaminations(*buffer(batch.column(at)), indexes, least)]] = False
                yield pa.RecordBatch.from_arrays(batch.filter(pa.array(keep)).columns, names=names)

        return scan

    for indexes in build_indexes(benchmark, least, least_stride, index_bytes):
        docs = docs.mapInArrow(keeper(indexes), docs.schema)
    return docs
