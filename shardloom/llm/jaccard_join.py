"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set is its distinct word shingles, ordered by a global order: rare shingles by
hash first, then the frequent ones by their count over the whole corpus. Two sets whose similarity is at least
``num``/``den`` share l shingles within prefixes of n - ceil(n*num/den) + l. Each document takes the l of least
estimated cost (postings to scan, plus candidates to verify, which fall with l), so documents of
frequent shingles get longer prefixes and must share correspondingly more of them; a pair must share the smaller of its two l.
Candidates are verified on the whole sets.

Hot groups: equal sets are one class and take part once. A first round links each document to one
leader of a list it is in, a second one each document of a long list to its likeliest partner in another component; both give at
most a pair a row and join the groups of near copies. The last looks at all pairs that can still be similar, but only between
different components, so a group's own pairs are never listed. Pairs are bounded by their
sizes, by the places of the common shingle in both prefixes and, in long lists, by parity prints of the sets, none of which
loses a similar pair. Lists of frequent shingles are dealt out by a salt in the first round, and by pairs of chunks later.

Scale: two passes over the texts and a third over the documents that are in a candidate pair; a shuffle of all
shingles packed to some four bytes, for the counts, and one of the prefixes, a quarter of the shingles.
What the driver gets is the ``most_frequent`` heaviest shingles; those beyond them are ordered by hash.

Edge cases: null texts, empty texts and texts of blanks have empty sets and no links; a document of fewer
words than ``width`` has one shingle, the whole sequence; documents that share an id are one node; a null doc_id
links with nothing and has a null component; repeated rows share a component; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._ranges import partitions
from ._store import discard, free_name, freeze, materialize, release, scratch, small_batches, thaw
from ._text import buffer, list_array, mix, ragged, shingle_sets
from .components import connected_components

U = np.uint64
I = np.int64
MOST_MATCHES = 5
VERIFY_COST = 8.0
PRINT_BITS = 1024


def _sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, x.dtype), np.cumsum(x)])
    return total[bounds[1:]] - total[bounds[:-1]]


def packed_shingles(docs: DataFrame, width: int, bits: int, chunk: int = 1_500_000) -> DataFrame:
    """(bucket, data): the documents' shingles, packed with their counts in a chunk of a task.

    A shingle is counted by ``bits`` + 32 leading bits of its hash, the first of which are its bucket; the counts only serve the order.
    """
    small_batches(docs.sparkSession)
    shift = U(32 - bits)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            value, count = np.unique(np.concatenate(held) >> shift, return_counts=True)
            bucket = (value >> U(32)).astype(I)
            edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            rest, count = (value & U(0xFFFFFFFF)).astype("<u4"), np.minimum(count, 65_535).astype("<u2")
            blobs = [freeze(rest[x:y], count[x:y]) for x, y in zip(edge[:-1], edge[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[edge[:-1]].astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "data"])

        for batch in batches:
            values, _ = shingle_sets(*buffer(batch.column(0)), width)
            if len(values):
                held.append(values)
                size += len(values)
            if size >= chunk:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    return docs.select("text").mapInArrow(scan, "bucket int, data binary")


def frequent_shingles(packed: DataFrame, bits: int, least: int) -> DataFrame:
    """(shingle, n): the counted bits of every shingle that occurs in at least ``least`` documents, with its count over all of them."""
    width = max(1, min(1 << bits, 2 * partitions(packed.sparkSession)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def total() -> pa.RecordBatch:
            value, count = (np.concatenate(x) for x in zip(*[thaw(b, "<u4", "<u2") for b in held], strict=True))
            order = np.argsort(value, kind="stable")
            value, count = value[order], count[order].astype(I)
            at = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
            count = np.add.reduceat(count, at)
            many = count >= least
            return pa.RecordBatch.from_arrays([pa.array((I(now) << 32) | value[at][many].astype(I)), pa.array(count[many])], names=["shingle", "n"])

        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != now:
                    if held:
                        yield total()
                    now, held = bucket, []
                held.append(blob)
        if held:
            yield total()

    return packed.repartition(width, "bucket").sortWithinPartitions("bucket").mapInArrow(scan, "shingle long, n long")


class Order:
    """The global order of shingles: counts of the frequent ones, by the leading bits of their hash, 0 for all others."""

    def __init__(self, values: np.ndarray, counts: np.ndarray, shift: int = 0):
        order = np.argsort(values.view(U))
        self.values, self.counts, self.shift = values.view(U)[order], counts[order].astype(I), U(shift)

    def count(self, values: np.ndarray) -> np.ndarray:
        if not len(self.values) or not len(values):
            return np.zeros(len(values), I)
        values = values >> self.shift
        at = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
        return np.where(self.values[at] == values, self.counts[at], 0)


def prefixes(values: np.ndarray, bounds: np.ndarray, order: Order, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, their counts, bounds, l of each document) of the chosen prefixes."""
    n = np.diff(bounds)
    count = order.count(values)
    if count.any():
        owner = np.repeat(np.arange(len(n)), n)
        turn = np.lexsort((count, owner))
        values, count = values[turn], count[turn]
    total = np.concatenate([[0], np.cumsum(count)])
    need = -(-n * num // den)
    best_cost, best = np.full(len(n), np.inf), np.ones(len(n), I)
    for m in range(1, MOST_MATCHES + 1):
        length = np.minimum(n, n - need + m)
        scan = (total[bounds[:-1] + length] - total[bounds[:-1]]).astype(float)
        cost = np.where(m <= np.maximum(need, 1), length + scan + VERIFY_COST * scan / m**2, np.inf)
        best, best_cost = np.where(cost < best_cost, m, best), np.minimum(cost, best_cost)
    length = np.where(n > 0, np.minimum(n, n - need + best), 0)
    row, i = ragged(length)
    at = bounds[:-1][row] + i
    return values[at], count[at], np.concatenate([[0], np.cumsum(length)]), best


def parity_prints(values: np.ndarray, bounds: np.ndarray, bits: int = PRINT_BITS) -> np.ndarray:
    """A row of ``bits`` bits for each set: a bit is the parity of how many shingles fall on it.

    Shingles that two sets share cancel out, so their prints differ in at most as many bits as the sets differ in shingles.
    """
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    at = (mix(values ^ U(0x3C79AC492BA7B653)) % U(bits)).astype(I)
    odd = np.bincount(owner * bits + at, minlength=n * bits).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n, bits), axis=1, bitorder="little").view(U)


def prefix_rows(docs: DataFrame, order: Order, width: int, num: int, den: int, list_rows: int = 5000) -> DataFrame:
    """doc_id, n, two digests of the set, its parity print, l, prefix and salts of every document; a salt is 0 where the shingle's list is whole, and from 1 up where it is dealt out."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, bounds = shingle_sets(*buffer(batch.column(1)), width)
            d1, d2 = _sums(mix(values), bounds), _sums(mix(values ^ U(0x5851F42D4C957F2D)), bounds)
            shingle, count, edge, m = prefixes(values, bounds, order, num, den)
            salts = np.maximum(1, count // list_rows).astype(U)
            owner = np.repeat(d1, np.diff(edge))
            salt = np.where(salts > 1, mix(owner) % salts + U(1), 0).astype(np.int32)
            prints = pa.array([x.tobytes() for x in parity_prints(values, bounds)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds)), pa.array(d1.view(I)), pa.array(d2.view(I)), prints, pa.array(m.astype(np.int32)), list_array(shingle.view(I), edge, pa.int64()), list_array(salt, edge, pa.int32())],
                names=["doc_id", "n", "d1", "d2", "print", "m", "prefix", "salts"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, n long, d1 long, d2 long, print binary, m int, prefix array<long>, salts array<int>")


def shared_postings(rows: DataFrame) -> DataFrame:
    """(token, node, n, m, place, leader, leader_n, leader_m, leader_place) of all prefix shingles that several classes share.

    The leader is the least node of the token's list (of its salt); the lists stream through sorted, so none is held.
    A list of one row is dropped only if it is whole: the other classes of a token that is dealt out are under other salts.
    """
    classes = rows.filter("n > 0 and doc_id is not null").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("node"), F.first("m").alias("m"), F.first("prefix").alias("prefix"), F.first("salts").alias("salts"))
    flat = classes.select("node", "n", "m", F.posexplode(F.arrays_zip("prefix", "salts")).alias("place", "x"))
    flat = flat.select(F.col("x.prefix").alias("token"), F.col("x.salts").alias("salt"), "node", F.col("n").cast("int").alias("n"), "m", "place")
    dealt = flat.repartition("token", "salt").sortWithinPartitions("token", "salt", "node")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None  # the last row, not yet given out
        lead = (0, 0, 0, 0)  # leader of the held row's list
        begun = False  # whether rows of the held row's list have been given out

        def rows_of(x: np.ndarray, leader: np.ndarray) -> pa.RecordBatch:
            small = [pa.array(c.astype(np.int32)) for c in (*x[3:], *leader[1:])]
            return pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[2]), *small[:3], pa.array(leader[0]), *small[3:]], names=["token", "node", "n", "m", "place", "leader", "leader_n", "leader_m", "leader_place"])

        for batch in batches:
            if not len(batch):
                continue
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(I) for c in batch.columns])
            if held is not None:
                x = np.concatenate([held, x], axis=1)
            k = x.shape[1]
            new = np.ones(k, bool)
            new[1:] = (x[0, 1:] != x[0, :-1]) | (x[1, 1:] != x[1, :-1])
            first = np.maximum.accumulate(np.where(new, np.arange(k), 0))
            leader = x[2:, first]
            if held is not None:
                leader = np.where(first == 0, np.array(lead)[:, None], leader)
            more = ~new
            more[:-1] |= ~new[1:]
            if held is not None and begun:
                more[0] = True
            more |= x[1] > 0
            out = more.copy()
            out[-1] = False
            if out.any():
                yield rows_of(x[:, out], leader[:, out])
            begun = bool(not new[-1] or (k == 1 and begun))
            held, lead = x[:, -1:], tuple(leader[:, -1])
        if held is not None and (begun or held[1, 0] > 0):
            yield rows_of(held, np.array(lead)[:, None])

    return dealt.mapInArrow(scan, "token long, node long, n int, m int, place int, leader long, leader_n int, leader_m int, leader_place int")


def may_link(n_a: str, m_a: str, place_a: str, n_b: str, m_b: str, place_b: str, num: int, den: int) -> Column:
    """Whether a shingle at these places of two prefixes counts for the pair.

    Before the k-th common shingle lie k - 1 of the overlap, from it on at most what is left of the shorter rest. So the first l
    common shingles of a similar pair pass, l being the smaller of the two; what fails is no candidate or not needed as one.
    """
    rest = F.least(F.col(n_a) - F.col(place_a), F.col(n_b) - F.col(place_b)) + F.least(m_a, m_b) - 1
    return rest.cast("long") * (num + den) >= (F.col(n_a) + F.col(n_b)).cast("long") * num


def _common(x: np.ndarray, y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlaps of sets with these prints."""
    return (n_x + n_y - np.bitwise_count(x ^ y).sum(axis=-1).astype(I)) // 2


def cross_pairs(rows: DataFrame, num: int, den: int, best: bool = False, short: int = 32, block: int = 64) -> DataFrame:
    """(a, b, m) of the pairs of nodes of different components that a list leaves possible; m is the smaller of their l.

    ``rows`` has (token, part, chunk, node, n, m, place, component, print); what shares token and part is compared, and where a part
    holds two chunks, only one with the other. Prints, where not null, bound the overlap. With ``best``, each node gives
    out only the partner of the highest bound, so at most one pair a row.
    """
    total = num + den
    names = ["token", "part", "chunk", "node", "n", "m", "place", "component", "print"]
    dealt = rows.select(*names).repartition("token", "part").sortWithinPartitions("token", "part")

    def possible(x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of the pairs (i, j) of columns of x: which lie in two components and can be similar enough."""
        n, m, place, comp = x[4], x[5], x[6], x[7]
        rest = np.minimum(n[i] - place[i], n[j] - place[j]) + np.minimum(m[i], m[j]) - 1
        return (comp[i] != comp[j]) & (rest * total >= (n[i] + n[j]) * num) & (np.minimum(n[i], n[j]) * den >= np.maximum(n[i], n[j]) * num)

    def neighbours(x: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs within many short groups at once: each column with the one d further on, for all d."""
        for d in range(1, x.shape[1]):
            i = np.flatnonzero(group[d:] == group[:-d])
            if not len(i):
                return
            i = i[possible(x, i, i + d)]
            yield i, i + d

    def within(x: np.ndarray, prints: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs within one long group, a block of rows at a time."""
        k, out = x.shape[1], []
        two = x[2].min() != x[2].max()
        top, partner = np.full(k, -1, I), np.zeros(k, I)
        for at in range(0, k, block):
            i, j = np.divmod(np.arange(min(block, k - at) * k), k)
            i += at
            keep = (i < j) & (x[2][i] != x[2][j]) if two else i < j
            i, j = i[keep], j[keep]
            keep = possible(x, i, j)
            i, j = i[keep], j[keep]
            if len(i):
                common = np.concatenate([_common(prints[i[c : c + 20_000]], prints[j[c : c + 20_000]], x[4][i[c : c + 20_000]], x[4][j[c : c + 20_000]]) for c in range(0, len(i), 20_000)])
                common = np.where(known[i] & known[j], common, np.minimum(x[4][i], x[4][j]))
                keep = common * total >= (x[4][i] + x[4][j]) * num
                i, j, common = i[keep], j[keep], common[keep]
                if best and len(i):
                    bound = (common << 20) // (x[4][i] + x[4][j])
                    for one, other in ((i, j), (j, i)):
                        turn = np.lexsort((-bound, one))
                        lead = turn[np.concatenate([[True], one[turn][1:] != one[turn][:-1]])]
                        better = bound[lead] > top[one[lead]]
                        top[one[lead][better]], partner[one[lead][better]] = bound[lead][better], other[lead][better]
                    continue
            out.append((i, j))
        if best:
            i = np.flatnonzero(top >= 0)
            return i, partner[i]
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def give(x: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
        for c in range(0, len(i), 50_000):
            p, q = i[c : c + 50_000], j[c : c + 50_000]
            a, b = np.minimum(x[3][p], x[3][q]), np.maximum(x[3][p], x[3][q])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.minimum(x[5][p], x[5][q]).astype(np.int32))], names=["a", "b", "m"])

    def compare(x: np.ndarray, prints: pa.Array) -> Iterator[pa.RecordBatch]:
        if not x.shape[1]:
            return
        new = np.ones(x.shape[1], bool)
        new[1:] = (x[0, 1:] != x[0, :-1]) | (x[1, 1:] != x[1, :-1])
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        few = np.flatnonzero((size <= short)[group])
        for i, j in neighbours(x[:, few], group[few]):
            yield from give(x, few[i], few[j])
        start = np.flatnonzero(new)
        for g in np.flatnonzero(size > short):
            a, b = int(start[g]), int(start[g] + size[g])
            own = prints.slice(a, b - a)
            prints_of = np.frombuffer(b"".join(p or bytes(PRINT_BITS // 8) for p in own.to_pylist()), U).reshape(b - a, PRINT_BITS // 64)
            y = x[:, a:b]
            yield from give(y, *within(y, prints_of, np.asarray(own.is_valid())))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            token, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            first = int(np.flatnonzero((token == token[-1]) & (part == part[-1]))[0])  # the last group may go on
            if held and (first or (held[-1].column(0)[-1], held[-1].column(1)[-1]) != (batch.column(0)[0], batch.column(1)[0])):
                yield from whole([*held, batch.slice(0, first)])
                held = []
            elif first:
                yield from whole([batch.slice(0, first)])
            held.append(batch.slice(first))
        if held:
            yield from whole(held)

    def whole(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches).combine_chunks()
        yield from compare(np.stack([t.column(c).to_numpy().astype(I) for c in names[:8]]), pa.concat_arrays(t.column("print").chunks))

    return dealt.mapInArrow(scan, "a long, b long, m int")


def in_parts(rows: DataFrame, lists: DataFrame, list_rows: int) -> DataFrame:
    """``rows`` with (part, chunk); lists of more than ``list_rows`` rows are cut into chunks that meet two at a time.

    A component with many rows in a list has chunks of its own, which don't meet each other. ``lists`` has (token, rows).
    """
    whole = rows.join(lists.filter(F.col("rows") <= list_rows).select("token"), "token", "left_semi")
    plain = whole.withColumn("part", F.lit(0).cast("long")).withColumn("chunk", F.lit(0).cast("long"))
    heavy = lists.filter(F.col("rows") > list_rows).select("token")
    if not heavy.head(1):
        return plain
    half = max(1, list_rows // 2)
    large = rows.join(heavy, "token", "left_semi")
    sizes = large.groupBy("token", "component").agg(F.count("*").alias("own"))
    pooled = sizes.groupBy("token").agg((F.floor(F.sum(F.when(F.col("own") <= half, F.col("own")).otherwise(0)) / half) + 1).alias("pools"))
    named = large.join(sizes, ["token", "component"]).join(pooled, "token")
    alone = F.col("own") > half
    sub = F.pmod(F.xxhash64("node"), F.floor(F.col("own") / half) + 1)
    chunk = F.when(alone, F.xxhash64("component", sub)).otherwise(F.pmod(F.xxhash64("component"), F.col("pools")))
    named = materialize(named.withColumn("chunk", chunk).withColumn("owner", F.when(alone, F.col("component"))).drop("own", "pools"), "jaccard-chunks")
    chunks = named.select("token", "chunk", "owner").distinct()
    other = chunks.select("token", F.col("chunk").alias("chunk_b"), F.col("owner").alias("owner_b"))
    met = chunks.join(other, "token").filter("chunk <= chunk_b and not coalesce(owner = owner_b, false)")
    met = met.select("token", "chunk", "chunk_b", F.xxhash64("chunk", "chunk_b").alias("part"))
    sides = met.select("token", "chunk", "part").unionByName(met.filter("chunk <> chunk_b").select("token", F.col("chunk_b").alias("chunk"), "part"))
    return plain.unionByName(named.drop("owner").join(sides, ["token", "chunk"]).select(*plain.columns))


def verified(pairs: DataFrame, docs: DataFrame, width: int, num: int, den: int, broadcast_rows: int = 1_000_000, members: int = 200) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    Each a's set meets those of its b's in a task, one at a time; an a of many b's is repeated for every ``members`` of them or so.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pairs = materialize(pairs.distinct(), "jaccard-pairs")
    few = pairs.groupBy("a").agg((F.floor(F.count("*") / members) + 1).alias("salts"))
    salted = pairs.join(few, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"))
    roles = salted.select(F.col("b").alias("doc_id"), "a", "salt", F.lit(1).alias("role"))
    roles = roles.unionByName(salted.select(F.col("a").alias("doc_id"), "a", "salt", F.lit(0).alias("role")).distinct())
    roles = materialize(roles, "jaccard-roles")
    if roles.count() <= broadcast_rows:  # some thirty bytes a row
        roles = F.broadcast(roles)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, bounds = shingle_sets(*buffer(batch.column(4)), width)
            raw = [values[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(raw, pa.binary())], names=["doc_id", "a", "salt", "role", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(roles, "doc_id").select("doc_id", "a", "salt", "role", "text")
    dealt = texts.mapInArrow(sets, "doc_id long, a long, salt long, role int, shingles binary").repartition("a", "salt").sortWithinPartitions("a", "salt", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mine = None, []
        for batch in batches:
            found = []
            for doc, a, salt, role, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (a, salt) != now:
                    now, mine = (a, salt), []
                other = np.frombuffer(raw, U)
                if role == 0:  # ids that repeat have a set for each text
                    mine.append(other)
                    continue
                for one in mine:
                    both = len(np.intersect1d(one, other, assume_unique=True))
                    if both * den >= (len(one) + len(other) - both) * num:
                        found.append((a, doc))
                        break
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found]), pa.array([x[1] for x in found])], names=["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def similar_components(docs: DataFrame, width: int = 5, num: int = 75, den: int = 100, least_frequent: int = 8, most_frequent: int = 300_000, list_rows: int = 5000, short_rows: int = 32) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; two documents link when den * intersection >= num * union."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(16, max(8, int(total / 6_000_000).bit_length()))
    top = frequent_shingles(packed_shingles(docs, width, bits), bits, least_frequent).orderBy(F.desc("n"), "shingle").limit(most_frequent).toArrow()
    order = Order(top["shingle"].to_numpy().astype(I), top["n"].to_numpy().astype(I), 32 - bits)
    release(spark)
    path = scratch(spark, "jaccard-prefixes")
    prefix_rows(docs, order, width, num, den, list_rows).write.option("compression", "none").parquet(path)
    prefixed = spark.read.parquet(path)
    rows = materialize(prefixed.select("doc_id", "n", "d1", "d2"), "jaccard-sizes")
    postings = materialize(shared_postings(prefixed), "jaccard-postings")
    prints = prefixed.filter("n > 0 and doc_id is not null").groupBy(F.col("doc_id").alias("node")).agg(F.min("print").alias("print"), F.max("print").alias("most"))
    prints = materialize(prints.select("node", F.when(F.col("print") == F.col("most"), F.col("print")).alias("print")), "jaccard-prints")  # ids with several texts have none
    discard(spark, path)
    release(spark)
    classes = rows.filter("n > 0 and doc_id is not null").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("node"))
    links = materialize(links_of_ids(rows, classes), "jaccard-ids")

    # Each node with the leader it shares most with, which joins the large groups of near copies.
    led = postings.filter(may_link("n", "m", "place", "leader_n", "leader_m", "leader_place", num, den) & (F.col("leader") != F.col("node")))
    led = led.groupBy("node", "leader").agg(F.count("*").alias("k"), F.min(F.least("m", "leader_m")).alias("m")).filter("k >= m")
    led = led.groupBy("node").agg(F.max(F.struct("k", (-F.col("leader")).alias("leader"))).alias("x"))
    links = links.unionByName(materialize(verified(led.select((-F.col("x.leader")).alias("a"), F.col("node").alias("b")), docs, width, num, den), "jaccard-links"))
    found = connected_components(links)

    # Twice what lies between components: in long lists each node with its likeliest partner, then all that is left.
    for best in (True, False):
        named = postings.select("token", "node", "n", "m", "place").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        lists = named.groupBy("token").agg(F.count("*").alias("rows"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("token", "rows")
        lists = materialize(lists.filter(F.col("rows") > short_rows) if best else lists, "jaccard-lists")
        if best and not lists.head(1):
            continue
        hot = named.join(lists.filter(F.col("rows") > short_rows), "token", "left_semi").join(prints, "node", "left")
        rest = named.join(lists.filter(F.col("rows") <= short_rows), "token", "left_semi").withColumn("print", F.lit(None).cast("binary"))
        pairs = cross_pairs(in_parts(hot if best else hot.unionByName(rest.select(*hot.columns)), lists, list_rows), num, den, best, short_rows)
        if not best:
            pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("k"), F.min("m").alias("m")).filter("k >= m")
        links = links.unionByName(materialize(verified(pairs.select("a", "b"), docs, width, num, den), "jaccard-links"))
        found = connected_components(links)
        release(spark)

    labels = classes.join(found, "node", "left").select("d1", "d2", "n", F.coalesce("component", "node").alias("component_id"))
    out = rows.join(labels, ["d1", "d2", "n"], "left")
    own = F.when((F.col("n") == 0) | F.col("component_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))


def links_of_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): links between the classes of an id that has several texts, as documents of one id are one node."""
    many = rows.filter("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("d1", "d2", "n")).alias("lo"), F.max(F.struct("d1", "d2", "n")).alias("hi")).filter("lo <> hi").select("doc_id")
    nodes = rows.filter("n > 0").join(many, "doc_id", "left_semi").join(classes, ["d1", "d2", "n"]).select("doc_id", "node").distinct()
    return nodes.filter("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))


#: Whether a text has a word.
HAS_WORD = r"[^\x20\x09-\x0D]"


def keep_representatives(docs: DataFrame, width: int = 5, num: int = 75, den: int = 100, **options) -> DataFrame:
    """``docs`` without the rows linked, directly or over others, to a document of a smaller id; columns and values as they were.

    What goes is a table of ids; it is broadcast when small, and joined by id otherwise. Rows without words link with nothing and stay, as
    do rows with a null id and all rows of an id that stays.
    """
    found = similar_components(docs, width, num, den, **options)
    gone = materialize(found.filter("n_shingles > 0 and component_id <> doc_id").select("doc_id").distinct(), "jaccard-gone")
    name = free_name(docs, "gone")
    other = gone.select(F.col("doc_id").alias(name))
    match = (F.col("doc_id").cast("long") == F.col(name)) & F.col("text").rlike(HAS_WORD)
    return docs.join(F.broadcast(other) if gone.count() <= 1_000_000 else other, match, "left_anti")
