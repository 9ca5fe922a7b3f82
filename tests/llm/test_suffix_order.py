"""The suffix index: order of entries, buckets and hot leading bytes."""

import bisect
import random

import numpy as np
import pytest

from shardloom.llm import suffix_dedup
from shardloom.llm.suffix_dedup import Buckets, Entries

from .test_llm import brute_removal, frame, text


def entries_of(texts, length=100, k=24):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = [Entries(lead, context, doc, start << 32 | sides << 8 | n) for lead, context, doc, start, sides, n in suffix_dedup.sampled_suffixes(np.frombuffer(b"".join(raw), np.uint8), offsets, length, k)]
    return raw, Entries.concat(got).sort()


def test_entries_are_in_the_order_of_their_suffixes():
    pick = random.Random(3)
    texts = ["".join(pick.choice("ab é\0߿") for _ in range(400)) for _ in range(20)] + ["\0" * 300]
    raw, entries = entries_of(texts)
    leads = [bytes(x) for x in entries.lead.astype(">u8").view(np.uint8).reshape(len(entries), 24)]
    assert leads == sorted(leads)
    for lead, doc, start, n in zip(leads, *entries.strings(), strict=True):
        assert any(raw[doc].startswith(lead, at) for at in range(start + n - 1, start + 100 - 23))


def test_strings_of_the_agreeing_side():
    _, entries = entries_of([text(60, random.Random(i)) for i in range(9)])
    yes, no = np.ones(len(entries), bool), np.zeros(len(entries), bool)
    doc, start, n = entries.strings()
    before = (entries.place >> 24) & 0xFF
    for left, right in ((yes, yes), (yes, no), (no, yes), (no, no)):
        got = {(d, s + j) for d, s, m in zip(*entries.strings_near(left, right, 100), strict=True) for j in range(m)}
        assert got == {(d, s + j) for d, s, m, b in zip(doc, start, n, before, strict=True) for j in range(m) if (left[0] and b - j >= 38) or (right[0] and 76 - (b - j) >= 38)}


def test_buckets_are_ranges_of_bytes_and_blobs_give_entries_back():
    pick = random.Random(4)
    _, entries = entries_of(["".join(pick.choice("aé\0") for _ in range(500)) for _ in range(20)])
    every = entries.lead.astype(">u8").tobytes(), entries.context.astype(">u8").tobytes()
    ordered = [every[0][24 * i : 24 * i + 24] + every[1][8 * i : 8 * i + 8] for i in range(len(entries))]
    bounds = sorted({*pick.sample(ordered, 10), bytes(32), b"\xff" * 32})
    slices = Buckets(bounds, 24).slices(entries)
    assert [b for b, x, y in slices for _ in range(x, y)] == [bisect.bisect_right(bounds, e) for e in ordered]
    again = Entries.of(entries.blob(), 3, 5)
    assert all(np.array_equal(getattr(again, c), getattr(entries, c)) for c in ("lead", "context", "doc", "place")) and (again.source == 5).all()


@pytest.mark.parametrize("batches", [1, 4])
def test_leading_bytes_with_many_contexts_are_cut_into_buckets(spark, batches):
    """A third of the documents hold a phrase of least hash, each between words of its own; some repeat an edge of another one."""
    pick = random.Random(8)
    least = lambda x: int(suffix_dedup.window_hashes(suffix_dedup.prefix_hash(np.frombuffer(x.encode(), np.uint8)), 24).min())
    phrase = min((text(8, pick)[:40] for _ in range(1500)), key=least)
    own = [text(20, pick) + phrase + text(20, pick) for _ in range(120)]
    texts = own + [text(40, pick) for _ in range(240)] + [x[30:] for x in own[:20]] + [x[: len(x) // 2 + 50] for x in own[20:40]]
    pick.shuffle(texts)
    index = suffix_dedup.SuffixIndex(frame(spark, texts).selectExpr("doc_id as doc", "text"))
    _, entries = entries_of(texts)
    assert max(y - x for _, x, y in index.buckets.slices(entries)) <= 64 < max(np.unique(entries.lead, axis=0, return_counts=True)[1])
    got = sorted(suffix_dedup.removal_report(frame(spark, texts), batches=batches).drop("spans").collect())
    assert [tuple(r)[1:] for r in got] == brute_removal(texts, 100)
