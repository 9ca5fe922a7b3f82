"""Covering tables against all pairs, and fingerprints against their definition."""

import random
import re
from itertools import combinations

import numpy as np
import xxhash

from shardloom.llm import covering_lsh as c


def plain_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, near):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(nodes, 2):
        if near(a, b):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected(rows):
    prints = [plain_print(t) for _, t in rows]
    label = components(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (i, _), f in zip(rows, prints):
        if i is not None:
            least[label[f]] = min(i, least.get(label[f], i))
    return sorted(((i, f"{f:016x}", least.get(label[f])) for (i, _), f in zip(rows, prints)), key=repr)


def test_every_choice_of_bits_is_left_out_by_a_mask():
    for bits in (list(range(64)), [3, 5, 8, 21, 22, 23, 40, 41, 62]):
        masks = c.covering_masks(bits, 4)
        assert len(masks) == 31
        for chosen in combinations(bits, 4):
            hit = sum(1 << b for b in chosen)
            assert any(not m & hit for m in masks)


def test_two_levels_leave_at_most_16_bits_open():
    for m in c.covering_masks(list(range(64)), 4):
        rest = [b for b in range(64) if not m >> b & 1]
        assert all(len(rest) - inner.bit_count() <= 16 for inner in c.covering_masks(rest, 4))


def test_forest_joins_what_all_pairs_join():
    rng = random.Random(1)
    for _ in range(60):
        prints = list({rng.choice([0, 0xFFF]) ^ sum(1 << rng.randrange(16) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 60))})
        edges = set(c.forest(np.array(prints, np.int64), 4))
        assert len(edges) < len(prints)
        assert all((a ^ b).bit_count() <= 4 for a, b in edges)
        assert components(prints, lambda a, b: (a, b) in edges or (b, a) in edges) == components(prints, lambda a, b: (a ^ b).bit_count() <= 4)


def test_links_give_the_components_of_all_pairs(spark):
    rng = random.Random(2)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(40):  # crowded: a bucket of more than three goes to the second level
            prints.add(centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 7))))
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
    for bucket in (3, 1024):
        edges = {(r["a"], r["b"]) for r in c.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, bucket).collect()}
        assert all(near(a, b) for a, b in edges)
        assert components(signed, lambda a, b: (a, b) in edges or (b, a) in edges) == components(signed, near)


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = c.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected([tuple(r) for r in docs.collect()])


def test_awkward_rows(spark):
    body = " ".join(f"word{i}" for i in range(400))
    rows = [(9, body), (7, body.upper()), (8, body.replace("word5 ", "other ")), (None, body), (3, None), (2, ""), (None, " \t\n"), (5, "One two"), (5, "one TWO"), (5, "three"), (None, "lonely words of nobody here")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, component long")
    assert sorted(map(tuple, c.near_duplicates(docs).collect()), key=repr) == expected(rows)
    assert c.near_duplicates(docs.limit(0)).count() == 0


def test_very_long_text_is_taken_whole():
    rng = random.Random(4)
    text = " ".join(f"w{rng.randrange(9999)}" for _ in range(70_000))
    assert c.fingerprint(text) == c.fingerprint(text, chunk=1000)
    assert c.fingerprint(text) == plain_print(text)
