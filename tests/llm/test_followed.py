"""Documents paired with the next one, with ids that repeat and are null."""

import random

import pyarrow as pa

from shardloom.llm import simhash


def test_hot_ids_are_dealt_out_and_every_row_meets_its_next(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(900)]
    ids = [None if i % 3 == 0 else 7 if i % 3 == 1 else rng.randrange(-50, 50) for i in range(900)]
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts)], "doc_id long, text string, part string, tie int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        placed, n = simhash.followed(rows)
        got = placed.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    own = [r for r in got if not r["guest"]]
    sizes = [sum(r["part"] == p for r in own) for p in {r["part"] for r in own}]
    assert len(own) == 900 and n == len(sizes) and max(sizes) < 200  # a third of the rows has one id, a third none
    order = sorted(own, key=lambda r: (-r["place"], r["tie"], r["text"]))
    follows = {}
    for a, b in zip(order, order[1:] + order[:1]):
        follows.setdefault((a["doc_id"], a["text"]), set()).add(b["text"])
    parts = {}
    for r in got:
        parts.setdefault(r["part"], []).append(r)
    for some in parts.values():
        some.sort(key=lambda r: (r["guest"], -r["place"], r["tie"], r["text"]))
        assert [r["guest"] for r in some] == [0] * (len(some) - 1) + [1]
        for a, b in zip(some, some[1:]):
            assert b["text"] in follows[a["doc_id"], a["text"]]


def test_results_do_not_depend_on_the_number_of_parts(spark):
    rng = random.Random(10)
    rows = [(None if i % 4 == 0 else 5 if i % 4 == 1 else i, " ".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) + f" {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before, out = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(map(tuple, simhash.fingerprint_and_follow(df).collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1] and len(out[0]) == 200
    assert {r[3] for r in out[0]} == {f"{int(x):016x}" for x in simhash.fingerprints(pa.array([t for _, t in rows]))}
