"""Conversation structure repair by shortest paths in Dial's bucket queue.

A conversation's rows, in order, are to become turns whose role initials read ``(s?(ua)+)?``. Keeping a row costs 0, giving it the role that is
expected 1, deleting it 2, inserting an empty turn 5, and a truncated row that stays 5 more; blank rows and duplicates must go. Nodes are
(row, what may follow), arcs are edits. All costs are small whole numbers, so the distances to the end come from a ring of buckets, each emptied in turn; a walk along
tight arcs, smallest letter first, then gives the cheapest audit that is least in ASCII order.

Scale: rows are sorted by (conv_id, turn) into blocks and written, with their place as a number. A conversation inside a block is solved where
it is read. One that reaches a block's edge is a chain of segments, however long it is: each segment is solved alone for every state at its ends (a min-plus matrix of 4 by
4), the matrices are chained backwards to the distances at each edge, the segments are walked for every state they may be entered in, and those
walks are chained forwards. So no task holds a long conversation, only 16 numbers a segment of it. Its digest alone is sequential by
definition, and its repaired lines reach that task as a sorted stream. Whether a row is a duplicate is decided by grouping digests.

Edge cases: nulls in role and text are one blank, as in the damage's key; null turns come first; rows of one turn are ordered by role, then by
a hash of the text; a null conv_id is a conversation like any other; rows of unknown roles can be given a role or deleted; conversations without rows
have zeros, an empty audit and the digest of an empty string; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._ranges import partitions
from ._store import materialize, small_batches

BLANKS = " \t\n\x0b\f\r"
S, USER, ASSISTANT = 1, 2, 3
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: States: 0 nothing yet, 1 behind the system turn, 2 behind a user turn, 3 behind an assistant turn. A finished conversation is in 0 or 3.
EXPECTED = (USER, USER, ASSISTANT, USER)
ENDS = (0, 3)
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
DEAD, CUT = 4, 8  # of a row's code, beside its role
FAR = 1 << 60


def edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done to a row, in the order of letters."""
    out = [("D", DELETE, state)]
    if not code & DEAD:
        extra, role = TRUNCATED if code & CUT else 0, code & 3
        if role == EXPECTED[state] or role == S and state == 0:
            out.append(("K", extra, role))
        out.append(("R", REROLE + extra, EXPECTED[state]))
    return out


ONWARD = [[edits(code, q) for q in range(4)] for code in range(16)]
BACKWARD = [[[(q, w) for q in range(4) for _, w, to in edits(code, q) if to == x] for x in range(4)] for code in range(16)]
INSERTED_FROM = [[q for q in range(4) if EXPECTED[q] == x] for x in range(4)]
RING = 32  # above the longest arc and the spread of distances between the four states


def distances(codes: bytes, goal: list[int] | None) -> list[int]:
    """Cost from each node (4 * row + state) to the end, by Dial's queue; ``goal`` holds what lies behind the last row, None that nothing does."""
    n = len(codes)
    dist = [FAR] * (4 * n + 4)
    start = [0 if q in ENDS else FAR for q in range(4)] if goal is None else goal
    ring: list[list[int]] = [[] for _ in range(RING)]
    least = now = min(start)
    waiting = 0
    for q, x in enumerate(start):
        if x < FAR:
            dist[4 * n + q] = x
            ring[(x - least) % RING].append(4 * n + q)
            waiting += 1
    while waiting:
        bucket = ring[(now - least) % RING]
        while bucket:
            node = bucket.pop()
            waiting -= 1
            if dist[node] != now:
                continue
            i, q = node >> 2, node & 3
            before = [(4 * i + p, INSERT) for p in INSERTED_FROM[q]] if i < n or goal is None else []
            if i:
                before += [(4 * i - 4 + p, w) for p, w in BACKWARD[codes[i - 1]][q]]
            for to, w in before:
                if now + w < dist[to]:
                    dist[to] = now + w
                    ring[(now + w - least) % RING].append(to)
                    waiting += 1
        now += 1
    return dist


def walk(codes: bytes, dist: list[int], state: int, closing: bool) -> tuple[str, int]:
    """(letters, last state) of the tight walk from the first row that is least in ASCII order."""
    n, i, out = len(codes), 0, []
    while True:
        here = dist[4 * i + state]
        if i == n and (not closing or here == 0):
            return "".join(out), state
        options = [(letter, w, i + 1, to) for letter, w, to in ONWARD[codes[i]][state]] if i < n else []
        options.append(("I", INSERT, i, EXPECTED[state]))
        letter, _, i, state = min(x for x in options if here == x[1] + dist[4 * x[2] + x[3]])
        out.append(letter)


def repaired(letters: str, rows: list[tuple[str, str]], state: int) -> Iterator[str]:
    """The line of each turn that the edits leave."""
    i = 0
    for letter in letters:
        if letter == "I":
            state = EXPECTED[state]
            yield f"{NAMES[state]}:"
            continue
        role, text = rows[i]
        if letter == "R":
            state = EXPECTED[state]
            yield f"{NAMES[state]}:{text}"
        elif letter == "K":
            state = code_of(role)
            yield f"{role}:{text}"
        i += 1


def code_of(role: str) -> int:
    return {"s": S, "u": USER, "a": ASSISTANT}.get(role[:1], 0)


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with a quarter of the rows dropped, emptied, robbed of their stops, repeated or given to the user."""
    id_, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(id_, F.lit(":"), turn)) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def in_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """All rows with ``pos``, their place: the block in the upper bits, the row in the lower 33. Written, so that places stay."""
    spark = rows.sparkSession
    n = max(4 * partitions(spark), -(-rows.count() // block_rows))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("at", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "tie", "at"]
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("tie", "at")
    return materialize(placed.select(F.monotonically_increasing_id().alias("pos"), "*", last.alias("last")), "conversations")


_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(columns, kinds, strict=True)], names=names)


class Segment:
    """A conversation's rows in one block, as codes; ``rows`` are kept while it may turn out to be whole."""

    def __init__(self, conv: int | None, first: int, edge: bool):
        self.conv, self.first, self.edge = conv, first, edge
        self.codes, self.rows, self.turns, self.distinct = bytearray(), [], [None, None], 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, last: str, known: bool) -> None:
        code = code_of(role)
        if self.codes:
            self.illegal += not legal(self.codes[-1], code)
        if not last:
            self.blank, code = self.blank + 1, code | DEAD
        elif known:
            self.duplicate, code = self.duplicate + 1, code | DEAD
        elif last not in ".!?":
            self.truncated, code = self.truncated + 1, code | CUT
        self.codes.append(code)
        if turn is not None:
            self.distinct += turn != self.turns[1]
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn]
        if not self.edge:
            self.rows.append((role, text))

    def row(self, edge: bool) -> tuple:
        counts = (self.blank, self.duplicate, self.truncated, self.illegal)
        if edge:
            codes = bytes(self.codes)
            through = [distances(codes, [0 if q == x else FAR for q in range(4)])[:4] for x in range(4)]
            matrix = [through[x][q] for q in range(4) for x in range(4)] + distances(codes, None)[:4]
            return (self.conv, self.first, *counts, self.distinct, *self.turns, codes, matrix, None, None, None)
        dist = distances(self.codes, None)
        letters, _ = walk(self.codes, dist, 0, True)
        text = "\n".join(repaired(letters, self.rows, 0))
        return (self.conv, self.first, *counts, self.distinct, *self.turns, None, None, dist[0], letters, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())


def legal(a: int, b: int) -> bool:
    """Whether two neighbouring rows' initials are su, ua or au."""
    return (a & 3, b & 3) in ((S, USER), (USER, ASSISTANT), (ASSISTANT, USER))


FOUND = (
    "conv_id long, first long, blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long, "
    "codes binary, matrix array<long>, cost long, audit string, digest string"
)


def solve_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each segment of sorted blocks: solved, or with matrices where it reaches an edge. A mark before a row says that it is no duplicate."""
    held, block, fresh, out = None, None, None, []
    for batch in batches:
        for pos, mark, conv, turn, role, text, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if mark == 0:
                fresh = pos
                continue
            if held is None or pos >> 33 != block or conv != held.conv:
                new = pos >> 33 != block
                if held is not None:
                    out.append(held.row(held.edge or new))
                held, block = Segment(conv, pos, new), pos >> 33
            held.add(turn, role, text, last, fresh != pos)
        if out:
            yield _batch(FOUND, out)
            out = []
    if held is not None:
        yield _batch(FOUND, [held.row(True)])


GOALS = "head long, first long, goal array<long>, conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def chain_back(group: pa.Table) -> pa.Table:
    """For each segment of a conversation what its edge to the next one costs from each state; the totals stand in the first."""
    parts = sorted(group.to_pylist(), key=lambda x: x["first"])
    out, goal = [], None
    for x in reversed(parts):
        m = x["matrix"]
        out.append([parts[0]["first"], x["first"], goal, x["conv_id"], *[None] * 6])
        goal = m[16:] if goal is None else [min(FAR, min(m[4 * q + y] + goal[y] for y in range(4))) for q in range(4)]
    blank, duplicate, truncated, illegal = (sum(x[c] for x in parts) for c in ("blank", "duplicate", "truncated", "illegal"))
    illegal += sum(not legal(a["codes_end"], b["codes_start"]) for a, b in zip(parts, parts[1:], strict=False))
    dated = [x for x in parts if x["turns"]]
    distinct = sum(x["turns"] for x in dated) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:], strict=False))
    gaps = dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - distinct if dated else 0
    out[-1][4:] = [gaps, blank, duplicate, truncated, illegal, goal[0]]
    return pa.Table.from_batches([_batch(GOALS, out)])


ENTRIES = "first long, entry long"


def chain_on(group: pa.Table) -> pa.Table:
    """The state in which each segment is entered."""
    state, out = 0, []
    for x in sorted(group.to_pylist(), key=lambda x: x["first"]):
        out.append((x["first"], state))
        state = x["exits"][state]
    return pa.Table.from_batches([_batch(ENTRIES, out)])


WALKS = "head long, first long, letters array<string>, exits array<long>"


def walk_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The walk through each segment from every state in which it may be entered."""
    for batch in batches:
        out = []
        for head, first, codes, goal in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            dist = distances(codes, goal)
            letters, exits = zip(*(walk(codes, dist, q, goal is None) if dist[q] < FAR else ("", q) for q in range(4)), strict=True)
            out.append((head, first, list(letters), list(exits)))
        yield _batch(WALKS, out)


LINES = "head long, first long, place long, line string"


def write_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired lines of the segments whose letters come before their rows."""
    head, first, letters, state, rows, left = None, 0, "", 0, [], -1

    def lines() -> list[tuple]:
        return [(head, first, i, line) for i, line in enumerate(repaired(letters, rows, state))]

    for batch in batches:
        out = []
        for pos, mark, role, text, of, with_, entry, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if mark == 0:
                head, first, letters, state, rows, left = of, pos, with_, entry, [], n
            elif left > 0:
                rows.append((role, text))
                left -= 1
                if not left:
                    out += lines()
        yield _batch(LINES, out)


DIGESTS = "head long, digest string"


def digest_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each conversation's lines, which come in order."""
    now, sha, out = None, None, []
    for batch in batches:
        for head, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if head != now:
                if sha is not None:
                    out.append((now, sha.hexdigest()))
                now, sha = head, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(line.encode("utf-8", "surrogatepass"))
        if out:
            yield _batch(DIGESTS, out)
            out = []
    if sha is not None:
        yield _batch(DIGESTS, [(now, sha.hexdigest())])


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repair(rows: DataFrame, block_rows: int = 100_000) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text): its faults, the cheapest repair, and the digest of the repaired turns."""
    spark = rows.sparkSession
    small_batches(spark)
    placed = in_blocks(rows, block_rows)
    block = F.shiftright("pos", 33).alias("block")
    digest = F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256))
    fresh = placed.groupBy("conv_id", digest.alias("digest")).agg(F.min("pos").alias("pos"))
    columns = ["pos", "mark", "conv_id", "turn", "role", "text", "last"]
    marks = fresh.select("pos", F.lit(0).alias("mark"), *[F.lit(None).cast(t).alias(c) for c, t in zip(columns[2:], ("long", "long", "string", "string", "string"), strict=True)])
    stream = placed.select("pos", F.lit(1).alias("mark"), *columns[2:]).unionByName(marks)
    found = stream.withColumn("block", block).repartition("block").sortWithinPartitions("pos", "mark").select(columns).mapInArrow(solve_blocks, FOUND)
    found = materialize(found, "conversation-segments")

    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    whole = found.filter("codes is null").select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("digest").alias("repaired_sha256"))

    edges = found.filter("codes is not null").select("first", "conv_id", "codes", F.octet_length("codes").alias("n"))
    ends = [F.conv(F.hex(F.expr(f"substring(codes, {at}, 1)")), 16, 10).cast("int").alias(name) for at, name in ((1, "codes_start"), (-1, "codes_end"))]
    light = found.filter("codes is not null").drop("cost", "audit", "digest").select("*", *ends).drop("codes")
    goals = materialize(light.groupBy("conv_id").applyInArrow(chain_back, GOALS), "conversation-goals")
    walks = edges.join(goals.select("head", "first", "goal"), "first").select("head", "first", "codes", "goal").mapInArrow(walk_segments, WALKS)
    walks = materialize(walks, "conversation-walks")
    entries = walks.select("head", "first", "exits").groupBy("head").applyInArrow(chain_on, ENTRIES)
    pieces = walks.join(entries, "first").select("head", "first", "entry", F.element_at("letters", F.col("entry").cast("int") + 1).alias("letters"))
    pieces = materialize(pieces.join(edges.select("first", "n", "conv_id"), "first"), "conversation-pieces")
    audits = pieces.groupBy("head").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "letters"))), lambda x: x["letters"]), "").alias("audit"))

    at_edge = pieces.select(F.shiftright("first", 33).alias("in_block"), F.col("conv_id").alias("other"))
    kept = placed.withColumn("block", block).join(at_edge, (F.col("block") == F.col("in_block")) & F.col("conv_id").eqNullSafe(F.col("other")), "left_semi")
    empty = F.lit(None).cast("string")
    orders = pieces.select(F.col("first").alias("pos"), F.lit(0).alias("mark"), empty.alias("role"), empty.alias("text"), "head", "letters", "entry", "n")
    stream = kept.select("pos", F.lit(1).alias("mark"), "role", "text", F.lit(None).cast("long").alias("head"), empty.alias("letters"), F.lit(None).cast("long").alias("entry"), F.lit(None).cast("int").alias("n")).unionByName(orders)
    names = stream.columns
    lines = stream.withColumn("block", block).repartition("block").sortWithinPartitions("pos", "mark").select(names).mapInArrow(write_lines, LINES)
    digests = lines.repartition("head").sortWithinPartitions("head", "first", "place").select("head", "line").mapInArrow(digest_lines, DIGESTS)

    spanning = goals.filter("cost is not null").join(audits, "head", "left").join(digests, "head", "left")
    spanning = spanning.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
    return whole.unionByName(spanning).select(RESULT)


def repair_damaged(conversations: DataFrame, block_rows: int = 100_000) -> DataFrame:
    """``repair`` of the damaged rows, with a row for every original conversation."""
    done = repair(damage(conversations), block_rows)
    ids = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    out = ids.join(done, ids["id"].eqNullSafe(done["conv_id"]), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in RESULT[1:7]]
    return out.select(F.col("id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
