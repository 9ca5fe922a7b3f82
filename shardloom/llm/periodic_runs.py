"""Periodic runs of words, by the algorithm of Kolpakov and Kucherov.

A run is a stretch of words with smallest period q, of at least ``least`` words and ``times`` periods, that no neighbouring word extends with that
period. The text is cut into Lempel-Ziv factors with a suffix automaton, whose states know where they first end. Runs that touch a factor's
start are found there by Main's method: for each period, how far the words before and behind the start agree with those a period
away, from four Z arrays of the neighbouring factors. All other runs lie strictly inside a factor, and are copied from its earlier occurrence.

Before that, words outside any possible run are set aside, for all documents of a batch at once: every five words of a run occur again a
period away, so runs lie within maximal stretches in which each five words recur within the stretch. Equal
words have equal hashes, so none is lost; the algorithm then works on whole stretches and compares words themselves.

Scale: one pass, no shuffle; a task holds a batch of at most ``small_batches`` size or one longer text, and some 150 bytes a word of a stretch.

Edge cases: null and empty texts have no words, no runs and an empty collapsed text; rows are taken one by one, so repeated or null ids
give a row each; very long texts are taken whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import small_batches
from ._text import BLANK, U, buffer, mix, prefix_hash, span_hash, words

Run = tuple[int, int, int]


class Automaton:
    """Suffix automaton of a list of numbers; ``first_end`` of a state is where its strings first end."""

    def __init__(self, text: list[int]):
        #: A state's first transition lies in two arrays; only further ones need a dictionary.
        self.symbol, self.target, self.more = array("q", [-1]), array("q", [0]), {}
        self.length, self.link, self.first_end = array("q", [0]), array("q", [-1]), array("q", [-1])
        last = 0
        for i, c in enumerate(text):
            last = self._extend(last, c, i)

    def _new(self, length: int, end: int) -> int:
        self.symbol.append(-1)
        self.target.append(0)
        self.length.append(length)
        self.link.append(0)
        self.first_end.append(end)
        return len(self.length) - 1

    def step(self, state: int, c: int) -> int:
        """The state behind ``c``, or -1."""
        if self.symbol[state] == c:
            return self.target[state]
        more = self.more.get(state)
        return -1 if more is None else more.get(c, -1)

    def _put(self, state: int, c: int, to: int) -> None:
        if self.symbol[state] in (-1, c):
            self.symbol[state], self.target[state] = c, to
        else:
            self.more.setdefault(state, {})[c] = to

    def _extend(self, last: int, c: int, i: int) -> int:
        now = self._new(self.length[last] + 1, i)
        p = last
        while p >= 0 and (q := self.step(p, c)) < 0:
            self._put(p, c, now)
            p = self.link[p]
        if p < 0:
            return now
        if self.length[q] == self.length[p] + 1:
            self.link[now] = q
            return now
        copy = self._new(self.length[p] + 1, self.first_end[q])
        self.symbol[copy], self.target[copy], self.link[copy] = self.symbol[q], self.target[q], self.link[q]
        if q in self.more:
            self.more[copy] = dict(self.more[q])
        while p >= 0 and self.step(p, c) == q:
            self._put(p, c, copy)
            p = self.link[p]
        self.link[q] = self.link[now] = copy
        return now


def factors(text: list[int]) -> list[Run]:
    """(start, end, source) of each factor: the longest prefix of the rest that also starts earlier, at ``source``; a new symbol has source -1."""
    automaton, out, i, n = Automaton(text), [], 0, len(text)
    while i < n:
        state, j = 0, i
        while j < n:
            to = automaton.step(state, text[j])
            if automaton.first_end[to] >= j:
                break
            state, j = to, j + 1
        out.append((i, i + 1, -1) if i == j else (i, j, automaton.first_end[state] - (j - i) + 1))
        i = out[-1][1]
    return out


def z_array(text: list[int]) -> list[int]:
    """For each position, how many symbols from there on equal those from the start on."""
    n = len(text)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and text[k] == text[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def touching(text: list[int], at: int, left: int, end: int, most: int) -> Iterator[Run]:
    """(start, end, period) of stretches that touch ``at`` and keep a period up to ``most`` over two periods, seen from ``left`` to ``end``."""
    before, behind = text[left:at], text[at:end]
    n, m = len(before), len(behind)
    forward = z_array(behind + [-1] + before + behind)  # -1 occurs in no text
    back = z_array(before[::-1] + [-1] + behind[::-1] + before[::-1])
    for q in range(1, min(most, n) + 1):  # a whole period before
        ahead, over = min(forward[m + 1 + n - q], m) if m else 0, back[n + 1 + m + q] if q < n else 0
        if ahead + over >= q:
            yield at - q - over, at + ahead, q
    for q in range(1, min(most, m) + 1):  # a whole period behind
        ahead, over = forward[q] if q < m else 0, min(back[n + 1 + m - q], n) if n else 0
        if ahead + over >= q:
            yield at - over, at + q + ahead, q


def find_periodic(text: list[int], least: int = 6, times: int = 4) -> list[Run]:
    """(start, length, period) of all runs of a sequence of non-negative numbers, by start, then period; ``times`` is 2 or more."""
    cut, n = factors(text), len(text)
    runs: dict[tuple[int, int], int] = {}
    starts: dict[int, list[tuple[int, int]]] = {}

    def add(s: int, e: int, q: int) -> None:
        if e - s >= max(least, times * q) and (s, e) not in runs:
            runs[s, e] = q
            starts.setdefault(s, []).append((e, q))

    size = [0, 0] + [e - s for s, e, _ in cut] + [0]
    for k, (b, r, source) in enumerate([*cut, (n, n, -1)]):
        third, second, own = size[k : k + 3]
        if b:
            # A run that ends behind b starts less than 2 * second + own before it, one that ends at b less than twice the last two factors.
            most = max(second + own, third + second)
            reach = max(2 * second + own, 2 * (third + second))
            for s, e, q in sorted(touching(text, b, max(0, b - reach), r, most), key=lambda x: x[2]):
                if e < r or r == n:
                    add(s, e, q)
        if source >= 0:
            shift = b - source
            for s in range(source + 1, r - shift):
                if s in starts:
                    for e, q in starts[s]:
                        if e < r - shift:
                            add(s + shift, e + shift, q)
    return sorted(((s, e - s, q) for (s, e), q in runs.items()), key=lambda x: (x[0], x[2]))


def stretches(hashes: np.ndarray, doc: np.ndarray, gram: int, rounds: int = 3) -> list[tuple[int, int]]:
    """(first word, end) of stretches in which every ``gram`` words recur; every run lies within one, and what bounds the run is bounded there too."""
    n = len(hashes) - gram + 1
    if n < 1:
        return []
    key = np.zeros(n, U)
    for j in range(gram):
        key = mix(key * U(31) + hashes[j : j + n])
    at = np.flatnonzero(doc[:n] == doc[gram - 1 :])
    part = doc[at].astype(U)
    for _ in range(rounds):  # each round sees the stretches of the one before as texts of their own
        mine = mix(key[at] + mix(part + U(1)))
        order = np.argsort(mine, kind="stable")
        same = mine[order[1:]] == mine[order[:-1]]
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        at, part = at[again], part[again]
        if not len(at):
            return []
        part = np.cumsum(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (part[1:] != part[:-1])])).astype(U)
    edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    last = np.concatenate([edge[1:], [len(at)]]) - 1
    return list(zip(at[edge].tolist(), (at[last] + gram).tolist(), strict=True))


def runs_of_batch(texts: pa.Array, least: int, times: int) -> tuple[dict[int, list[Run]], np.ndarray]:
    """The runs of each text that has any, and the number of words of each."""
    data, offsets = buffer(texts)
    start, end, doc = words(data, offsets, BLANK)
    counts = np.bincount(doc, minlength=len(offsets) - 1)
    first = np.cumsum(counts) - counts
    hashes, raw, out = span_hash(prefix_hash(data), start, end), data.tobytes(), {}
    # A run of ``least`` words and ``times`` periods has so many words in a row that are equal to those a period away.
    gram = min(5, least - 1)
    for a, b in stretches(hashes, doc, gram):
        if b - a < least:
            continue
        number: dict[bytes, int] = {}
        text = [number.setdefault(raw[x:y], len(number)) for x, y in zip(start[a:b].tolist(), end[a:b].tolist(), strict=True)]
        d = int(doc[a])
        out.setdefault(d, []).extend((int(a - first[d]) + s, length, q) for s, length, q in find_periodic(text, least, times))
    return out, counts


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """``words`` without those that a run contains behind its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for s, length, q in runs:
        change[s + q] += 1
        change[s + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """doc_id, n_words, runs and the collapsed text (kept words joined by a blank) of every row. ``least`` >= 6 or so, ``times`` >= 3."""
    if least < 4 or times < 3:
        raise ValueError("runs have at least 4 words and 3 periods")
    small_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = runs_of_batch(batch.column(1), least, times)
            kept = []
            for d, text in enumerate(batch.column(1)):
                split = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                kept.append(b" ".join(collapse(split, found[d]) if d in found else split).decode("utf-8", "surrogatepass"))
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in found.get(d, ())] for d in range(len(batch))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(rows, kind), pa.array(kept, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, SCHEMA)


def strongest(runs: Column) -> Column:
    """The run with the greatest length over period, compared exactly; then the least start, then the least period; null without runs."""

    def better(best: Column, run: Column) -> Column:
        one, other = run["length"] * best["period"], best["length"] * run["period"]
        return F.when(best.isNull() | (one > other), run).otherwise(best)  # runs come by start, then period

    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


def run_report(found: DataFrame) -> DataFrame:
    """Per row of ``find_runs``: the number of runs, the strongest one, and digests of all runs and of the collapsed text."""
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    top = found.withColumn("top", strongest(F.col("runs")))
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.floor(F.col("top.length") * 1000 / F.col("top.period")).cast("long").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def plant_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which the texts of a tenth of the ids are periodic from some word on; null ids and texts without words stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    picked = F.when(h % 10 == 0, F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.expr("crc32(cast(doc_id as string)) div 10").alias("_g"), picked.alias("_w"))
    rows = rows.withColumn("_n", F.size("_w")).withColumn("_a", F.when(F.col("_n") > 0, F.expr("cast(_g % _n as int)")))
    rows = rows.withColumn("_p", F.expr("cast(1 + (_n - _a) div (3 + _g % 8) as int)"))
    tail = F.expr("flatten(array_repeat(slice(_w, _a + 1, _p), cast((_n - _a + _p - 1) div _p as int)))")
    text = F.concat_ws(" ", F.slice(F.concat(F.expr("slice(_w, 1, _a)"), tail), F.lit(1), F.col("_n")))
    return rows.select("doc_id", F.when(F.col("_n") > 0, text).otherwise(F.col("text")).alias("text"))
