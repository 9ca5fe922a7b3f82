"""Conversation repair against every sequence of edits, and against a plain dynamic programme where those are too many."""

import hashlib
import random
import re
import zlib

import pytest

from shardloom.llm import conversation_repair as c

EXPECTED = {0: 2, 1: 2, 2: 3, 3: 2}


def every_repair(rows):
    """All (cost, letters, roles) of edits with at most two inserted turns before each row; rows are (initial, fault)."""

    def go(i, inserted):
        if i == len(rows):
            yield 0, "", ""
        else:
            initial, fault = rows[i]
            extra = 5 if fault == "truncated" else 0
            tails = list(go(i + 1, 0))
            for cost, letters, roles in tails:
                yield cost + 2, "D" + letters, roles
                if fault not in ("blank", "duplicate"):
                    yield cost + extra, "K" + letters, initial + roles
                    for r in "ua":
                        yield cost + extra + 1, "R" + letters, r + roles
        if inserted < 2:
            for cost, letters, roles in go(i, inserted + 1):
                for r in "ua":
                    yield cost + 5, "I" + letters, r + roles

    return go(0, 0)


def plain_audit(rows):
    """(cost, letters) by going backwards over rows, at most two inserted turns before each."""
    best = {0: (0, ""), 3: (0, "")}
    for i in range(len(rows), -1, -1):
        if i < len(rows):
            initial, fault = rows[i]
            new = {}
            for q in range(4):
                options = [(best[q][0] + 2, "D" + best[q][1])] if q in best else []
                if fault not in ("blank", "duplicate"):
                    extra = 5 if fault == "truncated" else 0
                    role = {"s": 1, "u": 2, "a": 3}.get(initial)
                    if role in best and (role == EXPECTED[q] or role == 1 and q == 0):
                        options.append((best[role][0] + extra, "K" + best[role][1]))
                    if EXPECTED[q] in best:
                        options.append((best[EXPECTED[q]][0] + extra + 1, "R" + best[EXPECTED[q]][1]))
                if options:
                    new[q] = min(options)
            best = new
        for _ in range(2):
            for q in range(4):
                to = best.get(EXPECTED[q])
                if to is not None and (q not in best or (to[0] + 5, "I" + to[1]) < best[q]):
                    best[q] = (to[0] + 5, "I" + to[1])
    return best[0]


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def expected(rows, audit=plain_audit):
    """Rows (turn, role, text) in order -> the digest columns."""
    found = faults(rows)
    cost, letters = audit([(role[:1], f) for (_, role, _), f in zip(rows, found)])
    lines, i, at = [], 0, 0
    for x in letters:
        if x in "IR":
            at = EXPECTED[at]
        if x == "I":
            lines.append({2: "user", 3: "assistant"}[at] + ":")
            continue
        if x == "R":
            lines.append({2: "user", 3: "assistant"}[at] + ":" + rows[i][2])
        if x == "K":
            at = {"s": 1, "u": 2, "a": 3}[rows[i][1][:1]]
            lines.append(f"{rows[i][1]}:{rows[i][2]}")
        i += 1
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (gaps, *(found.count(x) for x in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def grouped(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, role, text))
    return {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0)) for k, v in out.items()}


def table(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_walks_are_cheapest_and_least_of_all_edits():
    rng = random.Random(5)
    good = re.compile("(s?(ua)+)?")
    for _ in range(120):
        rows = [(rng.choice("suuaa?"), rng.choice(["", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randint(0, 3))]
        codes = bytes(c.code_of(r) | {"": 0, "truncated": c.CUT}.get(f, c.DEAD) for r, f in rows)
        dist = c.distances(codes, None)
        want = min((cost, letters) for cost, letters, roles in every_repair(rows) if good.fullmatch(roles))
        assert (dist[0], c.walk(codes, dist, 0, True)[0]) == want
        assert plain_audit(rows) == want


def test_chained_segments_equal_the_whole():
    rng = random.Random(6)
    for _ in range(200):
        rows = [(rng.choice("suaa?"), rng.choice(["", "", "blank", "truncated"])) for _ in range(rng.randint(1, 30))]
        codes = bytes(c.code_of(r) | {"": 0, "truncated": c.CUT}.get(f, c.DEAD) for r, f in rows)
        cut = sorted({0, len(codes), *(rng.randrange(len(codes)) for _ in range(4))})
        parts = [codes[a:b] for a, b in zip(cut, cut[1:])]
        goals, goal = [], None
        for part in reversed(parts):
            goals.insert(0, goal)
            goal = c.distances(part, goal)[:4]
        state, letters = 0, ""
        for part, goal_ in zip(parts, goals):
            more, state = c.walk(part, c.distances(part, goal_), state, goal_ is None)
            letters += more
        assert (goal[0], letters) == plain_audit(rows)


def made(seed, n, longest):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            if rng.random() > 0.1:
                text = rng.choice(["Yes.", "no", " \t", "What? ", f"turn {turn}!", f"t{rng.randrange(9)}.", ""])
                rows.append((conv, turn * 2 if rng.random() < 0.1 else turn, rng.choice(["user", "assistant", "system", "tool"]), text))
    return list({(r[0], r[1]): r for r in rows}.values())


@pytest.mark.parametrize("block_rows", [20, 100_000])
def test_repair_equals_the_plain_programme(spark, block_rows):
    rows = made(7, 60, 12) + [(1000 + i % 2, i, r, t) for i, (_, _, r, t) in enumerate(made(8, 150, 6))]
    got = table(c.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), block_rows))
    assert got == {k: expected(v) for k, v in grouped(rows).items()}


def test_query_over_conversations_equals_the_definition(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in df.collect()]
    damaged = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if kind:
            row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            damaged += [row] * (2 if kind == 3 else 1)
    found = grouped(damaged)
    result = c.repair_damaged(df)
    assert result.columns == c.RESULT
    assert [t for _, t in result.dtypes] == ["bigint"] * 7 + ["string"] * 2
    assert table(result) == {k: expected(found.get(k, [])) for k in {r[0] for r in rows}}


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (5, None, "user", "a."), (5, None, "assistant", "b."), (5, 2, "user", "a."), (6, 1, "", "x"), (6, 2, None, "y."), (7, 0, None, None)]
    rows += [(8, t, "user", "same.") for t in range(40)] + [(9, 1, "user", "long. " * 100_000), (9, 2, "assistant", "end" * 100_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, pos int")
    plain = [(a, b, " " if r is None else r, " " if t is None else t) for a, b, r, t in rows]
    order = {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for k, v in grouped(plain).items()}
    assert table(c.repair(df)) == {k: expected(v) for k, v in order.items()}
    assert c.repair_damaged(df.limit(0)).count() == 0
    every_dropped = [(i, 0, "user", "x.") for i in range(400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert table(c.repair_damaged(spark.createDataFrame(every_dropped, "conv_id long, turn long, role string, text string"))) == {r[0]: empty for r in every_dropped}
