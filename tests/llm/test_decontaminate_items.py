"""Whether a test item is found depends on its text and the passage alone; hits against a plain search of all passages."""

import random
import re

import numpy as np
import pytest

from shardloom.llm import decontaminate as d

pick = random.Random(11)
WORDS = ["".join(pick.choice("abcdefghij") for _ in range(pick.randint(2, 7))) for _ in range(300)]


def text(n, rng=pick):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def plain(docs, items, question=0.6, answer=0.5):
    """Every passage of every document against every item's shingles."""
    split = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    out = set()
    for j, item in enumerate(items):
        w = split(item)
        if not w:
            continue
        width, cut = min(3, len(w)), len(split(d.question_and_answer(item)[0]))
        grams = [tuple(w[i : i + width]) for i in range(len(w) - width + 1)]
        cut = max(0, cut - width + 1)
        q, a = set(grams[:cut]), set(grams[cut:])
        stride = 64
        while stride < len(w):
            stride *= 2
        for i, doc in enumerate(docs):
            v = split(doc)
            for at in range(0, len(v), stride):
                p = v[at : at + 2 * stride]
                here = {tuple(p[k : k + width]) for k in range(len(p) - width + 1)}
                if (not q or len(q & here) / len(q) >= question - 1e-9) and (not a or len(a & here) / len(a) >= answer - 1e-9):
                    out.add((i, j))
                    break
    return out


def corpus():
    rng = random.Random(12)
    items = [text(rng.randint(4, 30), rng) + " " + text(rng.randint(1, 6), rng) for _ in range(30)] + [text(200, rng) + "? " + text(20, rng), "two words", "", "?!"]
    docs = []
    for i in range(120):
        w = items[rng.randrange(len(items))].split()
        if i % 3 == 1:  # some words of the item changed
            for _ in range(rng.randint(0, 6)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(WORDS)
        if i % 3 == 2 and len(w) > 6:  # an item in two parts
            at = rng.randrange(len(w))
            w = w[:at] + text(rng.choice([5, 60, 150]), rng).split() + w[at:]
        docs.append(text(rng.randint(0, 200), rng) + " " + " ".join(w) + " " + text(rng.randint(0, 100), rng))
    return items, docs


def found(spark, docs, items):
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in d.find_contaminations(rows, benchmark).collect()}


def test_hits_equal_a_search_of_all_passages(spark):
    items, docs = corpus()
    want = plain(docs, items)
    assert len(want) > 60
    assert found(spark, docs, items) == want


def test_other_items_change_no_hit(spark):
    items, docs = corpus()
    alone = found(spark, docs, items)
    rng = random.Random(13)
    more = [text(400, rng), text(1500, rng), *[text(rng.randint(5, 60), rng) for _ in range(40)], items[0] + " " + items[1]]
    for extra in (more[:1], more):
        both = found(spark, docs, items + extra)
        assert {x for x in both if x[1] < len(items)} == alone
    assert found(spark, docs, items[:10]) == {x for x in alone if x[1] < 10}


def test_an_item_far_apart_is_found_with_neither_a_short_nor_a_long_neighbour(spark):
    rng = random.Random(14)
    items = [text(25, rng) + " " + text(1, rng) for _ in range(40)]
    docs = []
    for i in range(200):
        w = items[i % 40].split()
        docs.append(" ".join([*w[:13], *text(160, rng).split(), *w[13:]]))
    assert found(spark, docs, items) == found(spark, docs, [*items, text(400, rng)]) == plain(docs, items)


def test_the_floor_is_below_every_passage_that_holds_enough():
    rng = random.Random(15)
    for _ in range(200):
        item = text(rng.randint(1, 30), rng) + rng.choice(["", " " + text(rng.randint(1, 9), rng)])
        others = [text(20, rng) for _ in range(5)]
        index = d.Index(list(range(6)), [item, *others], least=(0.6, 0.5))
        w = d.word_hashes(item)
        every, width = d.shingles(w, index.width[0]), index.width[0]
        keep = np.array([rng.random() < rng.choice([0.5, 0.8]) for _ in every])
        q, a = (float(np.isin(x, every[keep]).mean()) if len(x) else 1.0 for x in (index.question[0], index.answer[0]))
        if q < 0.6 or a < 0.5:
            continue
        terms = np.unique(np.concatenate([w[i : i + width] for i in np.flatnonzero(keep)]))
        at = np.flatnonzero(np.isin(index.terms, terms))
        score = sum(float(index.impact[k]) for t in at for k in range(index.first[t], index.first[t + 1]) if index.item[k] == 0)
        assert score >= 1 - 1e-9
        assert 0 in index.search(np.zeros(len(at), np.int64), at, 1.0)[1].tolist()


def test_parts_must_be_positive(spark):
    benchmark = spark.createDataFrame([(1, "a")], "item_id long, text string")
    with pytest.raises(ValueError):
        d.find_contaminations(spark.createDataFrame([(1, "a")], "doc_id long, text string"), benchmark, least_answer=0.0)
