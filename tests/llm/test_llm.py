"""The ten operators against brute force, round trips, planted cases and awkward tables."""

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shardloom.llm import components, decontaminate, jaccard_join, licenses, packing, quality, reshard, simhash, suffix_dedup, toxicity, warc
from shardloom.llm._text import BLANK, buffer, shingle_sets, words
from shardloom.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, key string, part int"
rng = random.Random(5)
WORDS = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(400)]


def text(n, pick=rng):
    return " ".join(pick.choice(WORDS) for _ in range(n)) + "."


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names operators use themselves."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, None, "s", None, 1.5, None, "k", 3) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def awkward():
    base = text(120)
    return [None, "", " \t\n ", "!!!", "word", base, base, base, text(6000), "Ünïcode — 🙂 " + text(30), base[:-3] + " x", "a" * 500, text(40), "x\x00y\x00 z", text(40)]


@pytest.fixture(scope="module")
def odd(spark):
    texts = awkward()
    ids = [*range(len(texts) - 2), None, 3]  # a null id, and one that repeats with another text
    return frame(spark, texts, ids)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(10)] + [(5, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")


def rows(df):
    return [tuple(r) for r in df.collect()]


# Awkward and empty tables.


def test_every_operator_takes_awkward_and_empty_tables(spark, odd, labels):
    n = odd.count()
    benchmark = spark.createDataFrame([(0, None, 1), (1, "", 2), (2, text(20), 3)], "item_id long, text string, doc_id int")
    per_row = {
        "toxicity": lambda d: toxicity.classify_toxicity(d, labels),
        "suffix": lambda d: suffix_dedup.removal_report(d),
        "cut": lambda d: suffix_dedup.remove_repeats(d),
        "reshard": lambda d: reshard.reshard(d, 4)[0],
        "simhash": simhash.fingerprint_and_follow,
        "jaccard": jaccard_join.similar_components,
        "licenses": licenses.scan_licenses,
        "quality": lambda d: quality.classify_quality(d, labels, features=16),
    }
    for name, f in per_row.items():
        assert f(odd).count() == n, name
        assert f(odd.limit(0)).count() == 0, name
    for f in (lambda d: decontaminate.find_contaminations(d, benchmark), lambda d: decontaminate.decontaminate(d, benchmark), lambda d: quality.reject_low_quality(d, labels, features=16), jaccard_join.keep_representatives, lambda d: packing.pack(d, tokenizer_path())):
        f(odd).collect()
        assert f(odd.limit(0)).count() == 0
    assert decontaminate.find_contaminations(odd, benchmark.limit(0)).count() == 0
    pages = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", "x" * 3000), (2, "v\r\nw", "é" * 30_000)], "page_id long, url string, html string")
    for p in (pages, pages.limit(0)):
        path = reshard.scratch(spark, "test-warc")
        warc.write_archives(p, path)
        got = warc.read_pages(spark, path).collect()
        assert len(got) == p.count() and all(r["error"] is None for r in got)


# 1 and 9: classifiers.


def test_toxicity_finds_toxic_documents_and_sentences(spark):
    pick = random.Random(3)
    bad = [i % 6 == 0 for i in range(900)]
    texts = [". ".join(text(8, pick) + (" vilething " if b and j == 2 else "") for j in range(5)) for b in bad]
    labels = spark.createDataFrame([(i, 1, int(b)) for i, b in enumerate(bad)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.classify_toxicity(frame(spark, texts), labels).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] for i in held) and sum(r["held_out"] for r in got.values()) == len(held)
    assert np.mean([got[i]["predicted"] == bad[i] for i in held]) > 0.98
    for i in held[:40]:
        spans = [texts[i].encode()[s["start"] : s["end"]].decode() for s in got[i]["offending"]]
        assert all("vilething" in s for s in spans) and bool(spans) == bad[i]


def test_gradient_of_the_bag_likelihood():
    r = np.random.default_rng(3)
    doc = np.sort(np.concatenate([np.arange(12), r.integers(0, 12, 20)]))
    sentence, slot = r.integers(0, len(doc), 90), r.integers(0, 7, 90)
    y, w, bias = r.integers(0, 2, 12).astype(float), r.normal(size=7), -0.7

    def loss(w, bias):
        total = 0.0
        for d in range(12):
            none = 1.0
            for s in np.flatnonzero(doc == d):
                none *= 1 - 1 / (1 + np.exp(-(bias + w[slot[sentence == s]].sum())))
            total -= np.log(1 - none) if y[d] else np.log(none)
        return total / 12

    value, g, gb = toxicity.bag_gradient(w, bias, slot, sentence, doc, y)
    h = 1e-6
    assert value == pytest.approx(loss(w, bias))
    assert g == pytest.approx([(loss(w + h * e, bias) - loss(w - h * e, bias)) / (2 * h) for e in np.eye(7)], abs=1e-6)
    assert gb == pytest.approx((loss(w, bias + h) - loss(w, bias - h)) / (2 * h), abs=1e-6)


def test_a_repeated_word_counts_once_in_a_sentence(spark):
    model = toxicity.Model(12)
    one = toxicity.sentence_words(*buffer(pa.array(["bad"])), 12)[0]
    model.weights[one], model.bias = 1.5, -3.0
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(frame(spark, ["bad", "bad bad bad BAD", "bad. bad", "", None]), model).collect()}
    p = 1 / (1 + np.exp(1.5))
    assert [got[i] for i in range(3)] == pytest.approx([p, p, 1 - (1 - p) ** 2]) and got[3] == got[4] == pytest.approx(1 / (1 + np.exp(3)))


def test_the_sample_is_bounded_and_one_row_per_id(spark):
    texts = ["good words here. " * 4] * 30 + ["bad words here. " * 900] * 30
    docs = frame(spark, texts * 2, [*range(60), *range(60)])
    labels = spark.createDataFrame([(i, 1, int(i >= 30)) for i in range(60)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, max_docs=50, least=2)
    assert model.constant is None and model.weights.any()
    assert toxicity.fit(docs, labels, max_bytes=10).constant == 0.5


def test_noisy_or_of_sentences():
    p = np.array([0.5, 0.5, 0.1])
    assert toxicity.noisy_or(np.log(p / (1 - p)), np.array([0, 0, 1]), 2) == pytest.approx([0.75, 0.1])


def test_quality_separates_junk(spark):
    pick = random.Random(4)
    good = [i % 4 != 0 for i in range(800)]
    texts = [text(80, pick) if g else " | ".join(pick.choice(WORDS).upper() + "!!" for _ in range(40)) for g in good]
    labels = spark.createDataFrame([(i, int(g), 0) for i, g in enumerate(good)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classify_quality(frame(spark, texts), labels, features=64).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] for i in held) and np.mean([got[i]["predicted"] == good[i] for i in held]) > 0.98
    kept = {r["doc_id"] for r in quality.reject_low_quality(frame(spark, texts), labels, features=64).collect()}
    assert kept == {i for i, r in got.items() if r["predicted"]}


def test_statistics_match_plain_counts():
    for t in ["", "A cat. THE Cat, the dog!\nA cat. THE\n\n| x |", text(50), "Ünï  9,9"]:
        got = dict(zip(quality.NAMES, quality.statistics(*buffer(pa.array([t, "other text"])))[0], strict=True))
        raw, w, lines = t.encode(), re.findall(r"[^\x20\x09-\x0D]+", t), [x for x in t.split("\n") if x]
        full = max(len(raw), 1)
        assert got["log_bytes"] == pytest.approx(np.log1p(len(raw))) and got["upper"] * full == pytest.approx(sum(65 <= b <= 90 for b in raw))
        assert got["comma"] * full == pytest.approx(sum(t.count(c) for c in ",;:")) and got["digit"] * full == pytest.approx(sum(48 <= b <= 57 for b in raw))
        if w:
            size = [len(x.encode()) for x in w]
            assert got["mean_word"] == pytest.approx(np.mean(size)) and got["sd_word"] == pytest.approx(np.std(size))
            assert got["distinct_words"] == pytest.approx(len({x.lower() for x in w}) / len(w)) and got["distinct_lines"] == pytest.approx(len({x.lower() for x in lines}) / len(lines))


def test_features_approximate_the_kernel_and_the_solution_is_ridge(spark):
    r = np.random.default_rng(1)
    k = len(quality.NAMES)
    x = r.normal(size=(300, k))
    model = quality.Model(np.zeros(k), np.ones(k), 4000, 0.03, 7)
    z = model.transform(x[:40])[:, :-1]
    exact = np.exp(-0.03 * ((x[:40, None] - x[None, :40]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - exact).max() < 0.12
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    labelled = spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(300)], "doc_id long, stats array<double>, y double").repartition(7)
    model = quality.fit(labelled, features=32, groups=3)
    used = [row["doc_id"] for row in labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(5)) != 0).collect()]
    plain = quality.Model(x.mean(axis=0), x.std(axis=0), 32, 0.03, 7)
    z = plain.transform(x[used])
    penalty = np.eye(33)
    penalty[-1, -1] = 0
    assert model.beta == pytest.approx(np.linalg.solve(z.T @ z + penalty, z.T @ y[used]), abs=1e-8)


def test_isotonic_is_monotone_and_keeps_the_mean():
    r = np.random.default_rng(0)
    x, w = np.sort(r.random(50)), r.integers(1, 9, 50).astype(float)
    y = r.random(50)
    knots, values = quality.isotonic(x, y, w)
    assert (np.diff(values) > 0).all() and (np.diff(knots) > 0).all()
    assert quality.isotonic(x, np.sort(y), w)[1] == pytest.approx(np.sort(y))


# 2: suffix arrays.


def brute_removal(texts, length):
    seen, out = set(), []
    for t in texts:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for q in range(len(raw) - length + 1):
            g = raw[q : q + length]
            if g in seen:
                gone[q : q + length] = True
            seen.add(g)
        out.append((len(raw), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_repeats_match_brute_force(spark, batches):
    pick = random.Random(6)
    passage = [text(30, pick) for _ in range(4)]
    texts = [" ".join(pick.choice([text(10, pick), pick.choice(passage), pick.choice(passage)[:pick.randint(90, 160)], "ab" * 80, "é" * 60]) for _ in range(pick.randint(1, 6))) for _ in range(60)]
    texts += [texts[3], None, "", "a" * 1000, texts[3][:150], passage[0] * 20]
    got = sorted(suffix_dedup.removal_report(frame(spark, texts), batches=batches).drop("spans").collect())
    assert [tuple(r)[1:] for r in got] == brute_removal(texts, 100)


def test_rows_of_one_id_are_documents_of_their_own(spark):
    own = [text(90, random.Random(i)) for i in range(4)]
    shared = text(60, random.Random(9))
    texts = [own[0], own[1], own[2] + shared, own[3], own[3], shared + own[0][:50], None, ""]
    ids = [7, 7, None, None, 9, 12, 7, None]
    docs = frame(spark, texts, ids).withColumn("doc", F.lit("d")).withColumn("Doc_Spans", F.lit(2)).withColumn("spans", F.lit(3))
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"]) for r in suffix_dedup.removal_report(docs).collect())
    size = [len((t or "").encode()) for t in texts]
    gone = [0, 0, 0, 0, size[4], len(shared), 0, 0]
    assert got == sorted((i or -1, n, g) for i, n, g in zip(ids, size, gone, strict=True))
    cut = suffix_dedup.remove_repeats(docs)
    assert cut.columns == docs.columns
    want = [own[0], own[1], own[2] + shared, own[3], "", own[0][:50], None, ""]
    assert sorted((str(r["doc_id"]), str(r["text"]), r["doc"], r["Doc_Spans"], r["spans"]) for r in cut.collect()) == sorted((str(i), str(t), "d", 2, 3) for i, t in zip(ids, want, strict=True))
    same = frame(spark, [own[0]] * 3, [5, 5, 5])
    assert sorted(r["n_removed"] for r in suffix_dedup.removal_report(same).collect()) == [0, size[0], size[0]]


def test_long_texts_are_scanned_in_slices():
    raw = np.random.default_rng(1).integers(97, 100, 3000).astype(np.uint8)
    offsets = np.array([0, 40, 2900, 3000])
    whole = {(int(d), int(s) + j) for k, c, doc, start, shift, n in suffix_dedup.sampled_suffixes(raw, offsets, 100, 32) for d, s, m in zip(doc, start, n, strict=True) for j in range(m)}
    cut = {(int(d), int(s) + j) for k, c, doc, start, shift, n in suffix_dedup.sampled_suffixes(raw, offsets, 100, 32, most=257) for d, s, m in zip(doc, start, n, strict=True) for j in range(m)}
    assert whole == cut == {(1, i) for i in range(2860 - 99)} | {(2, 0)}


def test_levels_merge_geometrically(spark):
    docs = frame(spark, [text(60) for _ in range(8)]).select(F.col("doc_id").alias("doc"), "text")
    index = suffix_dedup.SuffixIndex(docs)
    seen = []
    for i in range(7):
        index.add(docs.filter(F.col("doc") == i))
        seen.append(sorted(index.levels))
    assert seen == [[0], [1], [0, 1], [2], [0, 2], [1, 2], [0, 1, 2]]


def test_cut_texts_are_valid_and_clean_ones_stay(spark):
    texts = ["é" * 200, "x" + "é" * 200, text(50)]
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(frame(spark, texts)).collect()}
    assert got[2]["text"] == texts[2] and got[1]["text"][0] == "x" and got[2]["n_chars"] == len(texts[2]) and got[0]["source"] == "s"


# 3: resharding.


def test_flow_moves_the_fewest_bytes():
    r = random.Random(2)
    for _ in range(60):
        n, m = r.randint(1, 3), r.randint(1, 3)
        supply = [r.randint(0, 4) for _ in range(n)]
        capacity = [r.randint(0, 5) for _ in range(m)]
        cost = [[r.randint(0, 3) for _ in range(m)] for _ in range(n)]
        if sum(capacity) < sum(supply):
            with pytest.raises(ValueError):
                reshard.min_cost_flow(supply, capacity, cost)
            continue
        flow = reshard.min_cost_flow(supply, capacity, cost)
        assert flow.sum(axis=1).tolist() == supply and (flow.sum(axis=0) <= capacity).all() and (flow >= 0).all()
        units = [i for i, s in enumerate(supply) for _ in range(s)]
        best = min((sum(cost[i][j] for i, j in zip(units, to, strict=True)) for to in itertools.product(range(m), repeat=len(units)) if all(to.count(j) <= capacity[j] for j in range(m))), default=0) if len(units) <= 7 else None
        assert best is None or (flow * np.array(cost)).sum() == best


def test_shards_are_near_equal_gapless_and_hold_their_texts(spark):
    texts = [text(rng.randint(1, 60)) for _ in range(600)] + [text(30)] * 200 + [None, ""]
    docs = frame(spark, texts)
    placed, files = reshard.reshard(docs, 5, old_shards=4)
    got = placed.collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        raw = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(sizes) == 5 and max(sizes.values()) - min(sizes.values()) <= 2 * max(len(t or "") for t in texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    old = defaultdict(int)
    for r in got:
        old[r["old_shard"]] += r["size"]
    least = sum(max(0, b - sum(old.values()) // 5) for b in old.values())
    moved = sum(r["size"] for r in got if r["shard"] != r["old_shard"])
    assert moved <= 1.02 * least
    moved_rows = {r["doc_id"] for r in got if r["shard"] != r["old_shard"]}
    assert moved_rows <= {r["doc_id"] for r in files.collect()}


# 4: SimHash.


def test_fingerprints_follow_and_neighbours(spark):
    texts = [text(rng.randint(0, 50)) for _ in range(120)] + [None, ""]
    texts[7] = texts[50]
    got = {r["doc_id"]: r for r in simhash.fingerprint_and_follow(frame(spark, texts)).collect()}
    n = len(texts)
    assert got[7]["fingerprint"] == got[50]["fingerprint"]
    for i in range(n):
        mine, other = texts[i] or "", texts[(i - 1) % n] or ""
        edited = mine[: len(mine) - len(mine) // 2] + other[: len(mine) // 2]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(mine)
        assert got[i]["near_next"] == 1 - bin(int(got[i]["fingerprint"], 16) ^ int(got[(i - 1) % n]["fingerprint"], 16)).count("1") / 64
        assert got[i]["edited_fingerprint"] == f"{int(simhash.fingerprints(pa.array([edited]))[0]):016x}"


def test_votes_match_a_plain_loop():
    def plain(t):
        w = [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", t.lower())]
        h = [int(simhash.span_hash(simhash.prefix_hash(np.frombuffer(x, np.uint8)), np.array([0]), np.array([len(x)]))[0]) for x in w]
        terms = [(h[0], 1)] if len(h) == 1 else []
        for (a, x), (b, y) in itertools.pairwise(zip(h, w, strict=True)):
            mixed = simhash.mix(np.array([(a * 0x9E3779B97F4A7C15 + b) % (1 << 64)], np.uint64))
            terms.append((int(mixed[0]), min(len(x), 12) + min(len(y), 12)))
        return sum(1 << bit for bit in range(64) if sum(n if h >> bit & 1 else -n for h, n in terms) > 0)

    texts = [text(n) for n in (1, 2, 3, 40, 200)] + ["", " \n", "One", "a " * 300, "ünïcode — 🙂 longerthantwelveletters x"]
    assert [int(x) for x in simhash.fingerprints(pa.array(texts))] == [plain(t) for t in texts]


def test_rows_within_a_radius_are_counted_for_repeated_ids(spark):
    prints = [(100, 5), (100, 5), (100, 1 << 40), (200, 4), (7, 7), (7, 5), (None, 5), (300, (1 << 64) - 1), (8, (1 << 64) - 2)]
    rows_ = spark.createDataFrame([(i, f"{p:016x}") for i, p in prints], "doc_id long, fingerprint string")
    got = sorted((str(r[0]), r[1], r[2]) for r in simhash.count_within(rows_).collect())
    want = [(str(i), f"{p:016x}", sum(bin(p ^ q).count("1") <= 3 for j, (_, q) in enumerate(prints) if j != k) if i and i % 100 == 0 else None) for k, (i, p) in enumerate(prints)]
    assert got == sorted(want)


@pytest.mark.parametrize(("radius", "blocks"), [(3, 5), (2, 4), (3, 6)])
def test_block_tables_lose_no_neighbour(spark, radius, blocks):
    r = np.random.default_rng(9)
    base = r.integers(0, 1 << 63, 40)
    prints = [int(b) ^ sum(1 << int(x) for x in r.choice(63, r.integers(0, 6), replace=False)) for b in base for _ in range(6)]
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    queries = spark.createDataFrame([(i, prints[i]) for i in range(0, len(prints), 10)], "query long, fingerprint long")
    got = sorted((q, f, d) for q, f, d, _ in rows(simhash.neighbours(queries, df, radius, blocks)))
    want = sorted({(i, p, bin(p ^ prints[i]).count("1")) for i in range(0, len(prints), 10) for p in prints if bin(p ^ prints[i]).count("1") <= radius})
    assert got == want


# 5: decontamination.


def brute_bm25(items, passage, k1=1.2, b=0.75):
    bags = [re.findall(r"[0-9a-z\x80-\U0010ffff]+", x.lower()) for x in items]
    avg, n = np.mean([len(x) for x in bags]), len(bags)
    df = defaultdict(int)
    for x in bags:
        for w in set(x):
            df[w] += 1

    def score(x, query):
        return sum(np.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * x.count(w) * (k1 + 1) / (x.count(w) + k1 * (1 - b + b * len(x) / avg)) for w in set(query) & set(x))

    return [score(x, passage) / score(x, x) for x in bags]


def test_wand_retrieves_all_above_the_threshold():
    items = [text(rng.randint(3, 25)) for _ in range(70)]
    index = decontaminate.Index(list(range(70)), items, block=8)
    sparse = decontaminate.Index(list(range(70)), items, block=3)
    for t in (0.1, 0.4, 0.8):
        for _ in range(10):
            query = re.findall(r"\w+", text(40) + " " + rng.choice(items)[:60])
            known = np.unique(decontaminate.word_hashes(" ".join(query)))
            term = np.flatnonzero(np.isin(index.terms, known))
            _, item, score = index.search(np.zeros(len(term), np.int64), term, t)
            want = brute_bm25(items, query)
            assert sorted(sparse.search(np.zeros(len(term), np.int64), term, t, chunk=5)[1].tolist()) == sorted(item.tolist())
            assert index.read <= sum(s > 0 for s in want) * len(term) if t == 0.1 else True
            assert sorted(item.tolist()) == [i for i, s in enumerate(want) if s >= t - 1e-9]
            assert score == pytest.approx([want[i] for i in item])


def test_wand_skips_most_postings():
    items = [text(20, random.Random(i)) for i in range(400)]
    index = decontaminate.Index(list(range(400)), items, block=8)
    term = np.flatnonzero(np.isin(index.terms, np.unique(decontaminate.word_hashes(items[3] + " " + text(40)))))
    _, item, _ = index.search(np.zeros(len(term), np.int64), term, 0.6)
    assert 3 in item.tolist() and index.read < 0.1 * (index.first[term + 1] - index.first[term]).sum()


def test_scores_do_not_depend_on_the_blocks_of_items(spark):
    items = [text(rng.randint(3, 40)) for _ in range(60)]
    docs = frame(spark, [text(30) + " " + items[i] + " " + text(30) for i in range(0, 60, 4)] + [None, ""])
    benchmark = spark.createDataFrame([*enumerate(items), (None, items[5]), (3, items[3]), (61, None)], "item_id long, text string")
    got = [sorted((r[0], -1 if r[1] is None else r[1], r[2], round(r[3], 9), r[4], r[5]) for r in decontaminate.find_contaminations(docs, benchmark, index_bytes=n).collect()) for n in (32_000_000, 4000, 600)]
    assert got[0] == got[1] == got[2] and {(i, 4 * i) for i in range(15)} <= {x[:2] for x in got[0]}


def test_leaks_are_found_and_clean_documents_left(spark):
    items = [text(rng.randint(8, 40)) + " " + text(3) for _ in range(30)]
    docs = [text(rng.randint(0, 300)) for _ in range(60)]
    for i in range(0, 60, 3):
        docs[i] += " " + items[i // 3] + " " + text(100)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for size in (32_000_000, 1500):
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_contaminations(frame(spark, docs), benchmark, index_bytes=size).collect()}
        assert got == {(i, i // 3) for i in range(0, 60, 3)}
        kept = {r["doc_id"] for r in decontaminate.decontaminate(frame(spark, docs), benchmark, index_bytes=size).collect()}
        assert kept == {i for i in range(60) if i % 3}


# 6: WARC.


def test_archives_round_trip(spark):
    pages = [(i, f"http://h/{i}", "é<p>" * rng.choice([0, 5, 300, 9000]) + ("\r\n\r\n" if i % 3 else "") + str(i % 7) * 20) for i in range(60)]
    pages += [(100 + i, "u", pages[3][2] if i % 2 else "same " * 400) for i in range(20)]
    path = reshard.scratch(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    records = warc.read_records(spark, path)
    assert records.filter("kind = 'continuation'").count() > 0
    payload = {r["page_id"]: r for r in warc.read_pages(spark, path).collect()}
    digest = {r["page_id"]: r for r in warc.digests(warc.read_pages(spark, path)).collect()}
    groups = defaultdict(list)
    for i, _, h in pages:
        groups[h].append(i)
    for i, _, h in pages:
        raw, holder = h.encode(), max(groups[h])
        visits = len(raw) >= 1000 and i != holder
        assert (digest[i]["record_type"], digest[i]["refers_to"]) == (("revisit", holder) if visits else ("response", None))
        assert (digest[i]["payload_bytes"], digest[i]["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert payload[i]["payload"] == (None if visits else raw) and payload[i]["error"] is None


def test_repeated_pages_have_records_of_their_own(spark):
    shared, longer, alone = "s" * 40_000, "l" * 50_000, "n" * 60_000
    pages = [(5, "u", longer), (5, "u", shared), (5, "u", shared), (4, "u", shared), (None, "u", alone), (None, "u", alone), (None, "v", alone)]
    path = reshard.scratch(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    got = warc.read_pages(spark, path)
    payloads = sorted((r["page_id"] or 0, r["record_type"], bytes(r["payload"] or b"").decode(), r["error"]) for r in got.collect())
    assert payloads == [(0, "response", alone, None)] * 3 + [(4, "revisit", "", None), (5, "response", longer, None)] + [(5, "response", shared, None)] * 2
    sizes = sorted((r["page_id"] or 0, r["payload_bytes"], r["refers_to"]) for r in warc.digests(got).collect())
    assert sizes == [(0, 60_000, None)] * 3 + [(4, 40_000, 5)] + [(5, 40_000, None)] * 2 + [(5, 50_000, None)]


def test_a_lost_segment_is_reported(spark):
    path = reshard.scratch(spark, "test-warc")
    row = {"page_id": 5, "url": "u", "html": "y" * 50_000, "payload_digest": hashlib.sha1(b"y" * 50_000).hexdigest(), "refers_to": None, "refers_to_url": None}
    parts = warc.records_of(row, "2024-01-02T03:04:05Z", 16_384, 4096)
    assert len(parts) == 4
    for drop in (1, 3):
        spark.createDataFrame([(p,) for i, p in enumerate(parts) if i != drop], "value string").write.option("lineSep", warc.END).text(f"{path}-{drop}")
        assert [r["error"] for r in warc.read_pages(spark, f"{path}-{drop}").collect()] != [None]


def test_standard_archives_are_read(spark):
    """Records as other writers give them: base32 digests, segments without page ids, other kinds of records."""
    import base64
    import gzip
    import os

    body = b"0123456789" * 30
    b32 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\n" + body

    def record(block, **fields):
        return b"WARC/1.0\r\n" + b"".join(f"{k.replace('_', '-')}: {v}\r\n".encode() for k, v in fields.items()) + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"

    own = {"WARC_Date": "2020-01-01T00:00:00Z", "WARC_Target_URI": "http://h/a"}
    first = record(http[:100], WARC_Type="response", WARC_Record_ID="<urn:uuid:1>", **own, WARC_Payload_Digest=f"sha1:{b32}", WARC_Segment_Number=1)
    rest = record(http[100:200], WARC_Type="continuation", WARC_Record_ID="<urn:uuid:2>", **own, WARC_Segment_Origin_ID="<urn:uuid:1>", WARC_Segment_Number=2)
    last = record(http[200:], WARC_Type="continuation", WARC_Record_ID="<urn:uuid:3>", **own, WARC_Segment_Origin_ID="<urn:uuid:1>", WARC_Segment_Number=3, WARC_Segment_Total_Length=len(http))
    info = record(b"software: x", WARC_Type="warcinfo", WARC_Record_ID="<urn:uuid:4>", WARC_Date="2020-01-01T00:00:00Z")
    plain = record(http, WARC_Type="response", WARC_Record_ID="<urn:uuid:5>", **own, WARC_Payload_Digest="md5:xx")
    bad = record(http, WARC_Type="response", WARC_Record_ID="<urn:uuid:6>", **own, WARC_Payload_Digest="SHA1:" + base64.b32encode(b"0" * 20).decode().lower())
    resource = record(b"raw", WARC_Type="resource", WARC_Record_ID="<urn:uuid:7>", **own)
    path = reshard.scratch(spark, "test-warc")
    os.makedirs(path.removeprefix("file://"))
    with open(path.removeprefix("file://") + "/a.warc.gz", "wb") as f:  # a member for each record, the segments out of order
        f.write(b"".join(gzip.compress(x) for x in (info, last, plain)))
    with open(path.removeprefix("file://") + "/b.warc", "wb") as f:
        f.write(first + bad + resource + rest)
    got = sorted((r["record_type"], r["uri"], r["page_id"], bytes(r["payload"] or b""), r["payload_digest"] == hashlib.sha1(body).hexdigest(), r["error"]) for r in warc.read_pages(spark, path).collect())
    assert got == sorted([("response", "http://h/a", None, body, True, None), ("response", "http://h/a", None, body, True, None), ("response", "http://h/a", None, body, False, "the digest is wrong"), ("resource", "http://h/a", None, b"raw", False, None)])


def test_written_records_hold_the_mandatory_fields(spark):
    path = reshard.scratch(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([(1, "u", "x" * 40_000), (2, "v", "x" * 40_000), (2, "v", "x" * 40_000)], "page_id long, url string, html string"), path)
    found = [f for r in spark.read.format("binaryFile").load(path).collect() for f, _ in warc.parse_archive(warc._plain(bytes(r["content"])))]
    assert all({"warc-type", "warc-record-id", "warc-date", "content-length"} <= set(f) for f in found)
    assert len({f["warc-record-id"] for f in found}) == len(found) == 7
    assert [(f["x-refers-to-page-id"], f["warc-refers-to-target-uri"]) for f in found if f["warc-type"] == "revisit"] == [("2", "v")]


def test_chunked_framing():
    for n in (0, 1, 4095, 4096, 9000):
        assert warc.dechunked(warc.chunked(b"z" * n)) == b"z" * n
    assert warc.dechunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: t\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc")


# 7: Jaccard join.


def brute_components(texts):
    low = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("options", [{}, {"least_frequent": 2, "list_rows": 3}, {"most_frequent": 0}, {"least_frequent": 2, "list_rows": 24, "short_rows": 5}])
def test_components_match_brute_force(spark, options):
    pick = random.Random(8)
    common = [text(12, pick) for _ in range(3)]
    texts = []
    for _ in range(40):
        base = text(pick.randint(1, 60), pick).split()
        for _ in range(pick.randint(1, 4)):
            w = list(base)
            for _ in range(pick.randint(0, 3)):
                w[pick.randrange(len(w))] = pick.choice(WORDS)
            texts.append(" ".join(w) + " " + pick.choice(["", common[0], common[1] + " " + common[2]]))
    base = text(100, pick).split()
    for _ in range(60):  # a large group of near copies
        w = list(base)
        w[pick.randrange(100)] = pick.choice(WORDS)
        texts.append(" ".join(w))
    for far in (4, 9):  # groups whose members are near the threshold of each other
        w = list(base)
        for _ in range(far):
            w[pick.randrange(100)] = pick.choice(WORDS)
        for _ in range(40):
            v = list(w)
            for _ in range(pick.randint(0, 3)):
                v[pick.randrange(100)] = pick.choice(WORDS)
            texts.append(" ".join(v))
    hot = text(60, pick)
    texts += [hot + " " + text(pick.randint(8, 40), pick) for _ in range(60)]  # a passage in many documents, most of them unlike
    texts += [texts[0].upper(), None, "", "  ", "one", "ONE", "one two", texts[-1]]
    got = sorted(rows(jaccard_join.similar_components(frame(spark, texts), **options)))
    assert [g[1:] for g in got] == brute_components(texts)
    kept = {r["doc_id"] for r in jaccard_join.keep_representatives(frame(spark, texts), **options).collect()}
    assert kept == {g[2] for g in got}


@pytest.mark.parametrize("list_rows", [5000, 16])
def test_a_passage_in_many_unlike_documents_gives_few_pairs(spark, list_rows):
    pick = random.Random(12)
    hot = text(40, pick)
    texts = [hot + " " + text(30, pick) for _ in range(2000)] + [text(30, pick) for _ in range(5)]
    texts += [texts[7], texts[7] + " x"]
    got = sorted(rows(jaccard_join.similar_components(frame(spark, texts), list_rows=list_rows)))
    assert [g[2] for g in got] == [*range(2005), 7, 7]


def test_documents_of_one_id_are_one_node(spark):
    a, b, c = (text(40, random.Random(i)) for i in range(3))
    docs = frame(spark, [a, a + " x", b, b + " y", "", c, None], [1, 3, 3, 9, 3, None, 9]).withColumn("gone", F.lit(1))
    got = sorted(rows(jaccard_join.similar_components(docs)), key=str)
    assert sorted((g[0] or -1, g[1] > 0, g[2] or -1) for g in got) == [(-1, True, -1), (1, True, 1), (3, False, 3), (3, True, 1), (3, True, 1), (9, False, 9), (9, True, 1)]
    kept = jaccard_join.keep_representatives(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) + str(r["text"]) for r in kept.collect()) == sorted(["1" + a, "3", "None" + c, "9None"])


def test_classes_of_a_heavily_copied_text_link_over_salts(spark):
    pick = random.Random(11)
    texts = []
    for _ in range(12):  # some thirteen documents hold a shingle, so that its list is dealt to two salts, but only two classes
        base = text(60, pick).split()
        texts += [" ".join(base)] * 12 + [" ".join([*base[:-1], "other"])]
    got = sorted(rows(jaccard_join.similar_components(frame(spark, texts), least_frequent=2, list_rows=6)))
    assert [g[2] for g in got] == [i // 13 * 13 for i in range(len(texts))]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    got = dict(rows(components.connected_components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_words_never_cross_documents():
    data, offsets = buffer(pa.array(["ab", "cd ef", None, "", "gh"]))
    start, end, doc = words(data, offsets, BLANK)
    assert [bytes(data[a:b]).decode() for a, b in zip(start, end, strict=True)] == ["ab", "cd", "ef", "gh"] and doc.tolist() == [0, 1, 1, 4]
    assert np.diff(shingle_sets(data, offsets, 5)[1]).tolist() == [1, 1, 0, 0, 1]


# 8: licences.


@pytest.mark.parametrize(
    ("expression", "want"),
    [
        ("MIT", (True, ["mit"])),
        ("MIT OR GPL-2.0", (True, ["mit", "gpl-2.0"])),
        ("MIT AND GPL-2.0", (False, ["mit", "gpl-2.0"])),
        ("GPL-2.0 OR MIT AND ISC", (True, ["gpl-2.0", "mit", "isc"])),
        ("(GPL-2.0 OR MIT) AND GPL-3.0", (False, ["gpl-2.0", "mit", "gpl-3.0"])),
        ("GPL-2.0 WITH Classpath-exception-2.0 OR MIT", (True, ["gpl-2.0 with classpath-exception-2.0", "mit"])),
        ("MIT */", (True, ["mit"])),
        ("MIT OR", None),
        ("(MIT", None),
        ("MIT)", None),
        ("OR MIT", None),
        ("", None),
    ],
)
def test_expressions(expression, want):
    assert licenses.evaluate(expression) == want


def test_phrases_and_tags(spark):
    cases = ["The MIT-License, and CC BY\nmit license", "x Apache  License", "gnu general public licenses", "// SPDX-License-Identifier: Apache-2.0 OR MIT\nfoo", None, "cc by cc by", "ümit license", "apache license license mit license"]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(frame(spark, cases)).collect()}
    for i, t in enumerate(cases):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        at = sorted((k, label) for p, label in licenses.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(at)) and (r["first_word"], r["last_word"]) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert r["base_labels"] == sorted({x for _, x in at}) and set(r["base_labels"]) <= set(r["labels"])
    assert {"apache-2.0", "mit"} <= set(got[3]["labels"]) and got[3]["permitted"] and got[4]["labels"] == []


def test_known_identifiers_become_labels(spark):
    cases = ["x SPDX-License-Identifier: MIT AND foo-1\nSPDX-License-Identifier:GPL-2.0+ WITH Classpath-exception-2.0 */", "SPDX License Identifier LicenseRef-a", "spdx-license-identifier : LicenseRef-a OR Zlib", "é SPDX-License-Identifier: ((MIT)"]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(frame(spark, cases)).collect()}
    assert got[0]["labels"] == ["gpl-2.0+ with classpath-exception-2.0", "mit"] and len(got[0]["expressions"]) == 2
    assert got[1]["expressions"] == [] and got[2]["labels"] == ["licenseref-a", "zlib"] and got[3]["labels"] == []


def test_the_scan_is_linear():
    automaton = licenses.build_automaton()
    part = "mit license cc by SPDX-License-Identifier: MIT\n"
    began = time.time()
    found = licenses.scan_text(part * (5_000_000 // len(part)), automaton)
    assert time.time() - began < 20 and len(found["places"]) == 2 * (5_000_000 // len(part)) and found["places"][-1][0] == found["n_words"] - 6


# 10: packing.


def test_hilbert_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        key = packing.hilbert(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_ids_are_the_tokenizers():
    tokens = packing.tokens_of(tokenizer_path())
    pick = random.Random(1)
    signs = [*"abzAZéÉñßçİıǅΣσς'’.,!?-—…£×÷ªº½\x1c\x85\t\n  \x0b123<|>%%", "don't", "<|endoftext|>", "we're ", "I'LL", "s' ", "日本", "🙂", "ﬁ", "é"]
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 40))) for _ in range(3000)] + [None]
    ids, bounds = tokens.encode(*buffer(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == tokens.tokenizer.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_packing_holds_every_id_once(spark):
    texts = [text(rng.randint(0, 400)) for _ in range(80)] + [None, "", text(9000)] + [text(50)] * 30
    got = packing.pack(frame(spark, texts), tokenizer_path(), length=256).collect()
    tokens = packing.tokens_of(tokenizer_path())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, t in enumerate(texts):
        ids = [*tokens.tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        assert np.concatenate([np.frombuffer(r["ids"], "<u4") for r in pieces]).tolist() == ids
        assert [r["start"] for r in pieces] == np.cumsum([0, *[r["length"] for r in pieces[:-1]]]).tolist() and {r["doc_tokens"] for r in pieces} == {len(ids)}
    full = [sum(r["length"] for r in by_sequence[s]) for s in sorted(by_sequence)]
    assert sorted(by_sequence) == list(range(len(full))) and set(full[:-1]) == {256}
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]


# The pipeline.


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = jaccard_join.materialize(stage(spark, docs, sf), f"test-{name}")
        assert docs.schema == before.schema
        n.append(docs.count())
        if name == "near_duplicates":
            got = {r["doc_id"] for r in docs.collect()}
            assert got == {r["component_id"] for r in jaccard_join.similar_components(before).collect()}
        if name == "repeated_substrings":
            texts = [(r["doc_id"], r["text"]) for r in before.orderBy("doc_id").collect()]
            want = [x[1] == x[0] for x in [(a, 0) for a, *_ in brute_removal([t for _, t in texts], 100)]]
            assert len(want) == n[-1]
            cut = {r["doc_id"]: r["text"] for r in docs.collect()}
            for (i, t), (_, removed, _, _) in zip(texts, brute_removal([t for _, t in texts], 100), strict=True):
                assert (cut[i] == t) == (removed == 0) and len(cut[i].encode()) <= len(t.encode()) - removed
    assert n[0] > n[1] > n[2] == n[3] >= n[4] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == n[4]
