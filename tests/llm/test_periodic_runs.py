"""Periodic runs against a plain search for every period, and the planted texts against their definition."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shardloom.llm import periodic_runs as p


def plain(w, least=6, times=4):
    """All runs by trying every period at every place."""
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda x: (x[0], x[2]))


pieces = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 30)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(pieces, st.sampled_from([(6, 4), (6, 3), (2, 2)]))
def test_all_runs_are_found(made, bounds):
    text = [c for unit, n in made for c in (unit * 30)[:n]]
    assert p.find_periodic(text, *bounds) == plain(text, *bounds)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_factors_are_longest_earlier_occurrences(text):
    at = 0
    for s, e, source in p.factors(text):
        assert s == at
        earlier = [max((k for k in range(len(text) - s + 1) if text[i : i + k] == text[s : s + k]), default=0) for i in range(s)]
        assert e - s == max(1, max(earlier, default=0))
        assert source == -1 and not max(earlier, default=0) or text[source : source + e - s] == text[s:e] and source < s
        at = e
    assert at == len(text)


def test_batches_lose_no_run():
    random.seed(3)
    texts = []
    for _ in range(400):
        w = []
        for _ in range(random.randint(0, 12)):
            unit = random.choices("ab cd ef gh ij".split(), k=random.randint(1, 6))
            w += (unit * 9)[: random.randint(1, len(unit) * 7)] + random.choices("kl mn op qr".split(), k=random.randint(0, 3))
        texts.append(random.choice([" ", "\n", "\t \x0b"]).join(w) if random.random() > 0.05 else None)
    found, counts = p.runs_of_batch(pa.array(texts, pa.string()), 6, 4)
    for d, t in enumerate(texts):
        assert found.get(d, []) == plain((t or "").split())
        assert counts[d] == len((t or "").split())


def test_long_text_in_linear_time():
    unit = [f"w{i}" for i in range(50_000)]
    began = time.time()
    found, _ = p.runs_of_batch(pa.array([" ".join(unit * 5)]), 6, 4)
    assert found == {0: [(0, 250_000, 50_000)]}
    assert time.time() - began < 30


def expected(rows):
    out = []
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            per = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % per] for i in range(n)]
        runs = plain(w)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
        out.append((doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, *digest))
    return sorted(out, key=repr)


def test_query_over_documents_equals_the_definition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    planted = p.plant_periods(docs)
    got = p.run_report(p.find_runs(planted))
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert rows == expected([tuple(r) for r in docs.collect()])
    assert sum(r[1] for r in rows) > 5


def test_awkward_rows(spark):
    rows = [(None, "a " * 9), (7, None), (7, ""), (7, " \t"), (8, "x y " * 5), (8, "x y " * 5), (18, "a b c d e f g"), (None, None), (5, "  " * 6 + "A a"), (4, "one")]
    rows += [(i, "q w e r t z") for i in range(40)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, runs string, n_words int")
    got = p.run_report(p.find_runs(p.plant_periods(docs)))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)
    assert p.run_report(p.find_runs(docs.limit(0))).count() == 0
    with pytest.raises(ValueError):
        p.find_runs(docs, times=2)


def test_collapse_keeps_one_period(spark):
    docs = spark.createDataFrame([(1, "so a b a b a b a b a b end")], "doc_id long, text string")
    row = p.find_runs(docs).first()
    assert row["collapsed"] == "so a b end" and [tuple(r) for r in row["runs"]] == [(1, 10, 2)]
