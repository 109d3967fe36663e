"""Operator 9, near-duplicates by b-bit MinHash.

1. One pass over the texts: per row the size of its shingle set, a 128-bit key of the set, a bucket for each band of minima,
   and a few mixed bits of all minima packed into longs.
2. Rows with equal sets form a class at once (map-side combine), so groups of copies cost one row each from here on.
3. In each bucket every member is paired with one centre only (a star, no pair of any two members), the member whose
   buckets hold most rows in all: among edited copies that is the text nearest to what they have in common. Packed
   signatures give a collision-corrected estimate by bit counts; each member's best pair is confirmed on the full sets;
   confirmed links make components.
4. Members of buckets that still hold several components meet once each at most ``CENTRES`` centres of other components,
   the heaviest of all their buckets; what the estimate leaves is confirmed. That connects large groups of edited copies.
5. Members of buckets that even then hold several components get an exact end on their full sets. A shingle is of use
   where members of different components hold it. A member can link to another component only if at least the threshold's
   share of its shingles is of use; the others go. Those that remain are dealt into blocks of about ``BLOCK_KEYS`` useful
   shingles within the clumps that open buckets make of them; two blocks at a time are compared by matrix products, and
   only links that connect components come out. So rows and memory stay in proportion; what grows with the square of
   such a clump is the number of products, which are spread over tasks.

Any two members of a bucket are thus compared or already connected, and stars lose no component.

Bands are chosen so that a pair at the threshold shares no bucket with a probability of at most 1e-6; an estimate drops a
pair only ``MARGIN`` standard deviations below the threshold.

Defined cases: texts without words and nulls have an empty set, are linked with nothing and stay; a text with fewer
words than a shingle is one shingle; rows with a null id are linked with nothing and stay (component null); rows
that repeat an id are rows as any other, of one class if their words agree; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import components
from .storage import dropped, table, unused, written
from .textcore import Words, distinct_in, mixed, slices, texts

U = np.uint64
#: Bytes of text whose shingles are made at once: some 150 bytes of arrays a byte.
SLICE = 1 << 19
MARGIN = 5.0
CENTRES = 8
#: Sets that are compared with a centre's set in one row, and useful shingles of a block in the exact end.
FELLOWS = 64
BLOCK_KEYS = 1 << 16
#: Up to so many ids (8 bytes each) the documents to confirm are found by a broadcast, beyond that by a shuffled join.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Plan:
    """words in a shingle, percent of the union that links, minima per band, bits kept of each minimum, least number of minima for the estimate."""

    shingle: int = 5
    percent: int = 80
    rows: int = 6
    bits: int = 2
    miss: float = 1e-6
    least_minima: int = 1024

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def minima(self) -> int:
        return max(self.least_minima, self.bands * self.rows)

    @property
    def least_estimate(self) -> float:
        t, chance = self.percent / 100, 2.0**-self.bits
        agree = chance + (1 - chance) * t
        return t - MARGIN * math.sqrt(agree * (1 - agree) / self.minima) / (1 - chance)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the distinct shingles of all texts, first of each text and one more), sorted within a text."""
    data, at = texts(column)
    words = Words(data, at)
    count = np.diff(words.first)
    docs, keys = [], []
    for n in range(1, size + 1):
        place, h = words.grams(tuple(range(n)))
        d = words.doc[place]
        if n < size:  # texts of exactly n words
            d, h = d[count[d] == n], h[count[d] == n]
        docs.append(d)
        keys.append(h)
    doc, key, _ = distinct_in(np.concatenate(docs), np.concatenate(keys))
    return key, np.searchsorted(doc, np.arange(len(at)))


class Minima:
    def __init__(self, plan: Plan):
        self.plan = plan
        random = np.random.Generator(np.random.PCG64(77))
        self.a = random.integers(0, 1 << 31, plan.minima, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = random.integers(0, 1 << 32, plan.minima, dtype=np.uint32)

    def of(self, key: np.ndarray, first: np.ndarray) -> np.ndarray:
        """uint32 minima, a row for each text; no text may be empty. The keys are hashes: a bijection of 32 bits reorders them."""
        key = (key >> U(32)).astype(np.uint32)
        out, held = np.empty((self.plan.minima, len(first) - 1), np.uint32), np.empty_like(key)
        for i in range(self.plan.minima):
            np.multiply(key, self.a[i], out=held)
            np.add(held, self.b[i], out=held)
            np.minimum.reduceat(held, first[:-1], out=out[i])
        return np.ascontiguousarray(out.T)

    def buckets(self, minima: np.ndarray) -> np.ndarray:
        p = self.plan
        h = np.full((len(minima), p.bands), U(1469598103934665603), np.uint64) + np.arange(p.bands, dtype=np.uint64)
        for k in range(p.rows):
            h = mixed(h * U(0x100000001B3) + minima[:, k : p.bands * p.rows : p.rows].astype(np.uint64))
        return h.view(np.int64)

    def packed(self, minima: np.ndarray) -> np.ndarray:
        """``bits`` bits of each minimum in longs. The minima's own low bits depend on nothing but those of the keys, so each function mixes its own: by chance unequal minima then agree in each apart."""
        per = 64 // self.plan.bits
        longs = -(-self.plan.minima // per)
        own = np.arange(1, self.plan.minima + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)
        place = np.arange(per, dtype=np.uint64) * U(self.plan.bits)
        out = np.empty((len(minima), longs), np.uint64)
        for at in range(0, len(minima), 256):  # what is held at once stays small
            low = mixed(minima[at : at + 256].astype(np.uint64) ^ own) >> U(64 - self.plan.bits)
            low = np.pad(low, ((0, 0), (0, -self.plan.minima % per))).reshape(len(low), longs, per)
            out[at : at + 256] = np.bitwise_or.reduce(low << place, axis=2)
        return out.view(np.int64)


def signatures(docs: DataFrame, plan: Plan, id_col: str, text_col: str) -> DataFrame:
    """(id, n, k1, k2, buckets, low) of each row; keys and arrays are null for empty sets."""
    minima = Minima(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                key, first = shingle_sets(batch.column("text"), plan.shingle)
                n = np.diff(first)
                full = np.flatnonzero(n)
                empty = pa.array(n == 0)
                out = [batch.column("id"), pa.array(n, pa.int64())]
                sums = np.concatenate([[U(0)], np.cumsum(mixed(key ^ U(0x5BF03635)), dtype=np.uint64)]), np.concatenate([[U(0)], np.cumsum(mixed(key ^ U(0xA54FF53A)), dtype=np.uint64)])
                out += [pa.array((s[first[1:]] - s[first[:-1]]).view(np.int64), mask=n == 0) for s in sums]
                got = minima.of(key, np.append(first[:-1][full], first[-1])) if len(full) else np.zeros((0, plan.minima), np.uint32)
                for values in (minima.buckets(got), minima.packed(got)):
                    ends = np.concatenate([[0], np.cumsum(np.where(n > 0, values.shape[1], 0))]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()), mask=empty))
                yield pa.RecordBatch.from_arrays(out, ["id", "n", "k1", "k2", "buckets", "low"])

    got = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return got.mapInArrow(run, "id long, n long, k1 long, k2 long, buckets array<long>, low array<long>")


def estimate(a: Column, b: Column, plan: Plan) -> Column:
    """Similarity from packed bits, corrected for the chance that unequal minima agree in them."""
    longs = -(-plan.minima // (64 // plan.bits))
    ones = int("".join("0" * (plan.bits - 1) + "1" for _ in range(64 // plan.bits)), 2)
    differ = F.lit(0)
    for i in range(longs):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        y = x
        for k in range(1, plan.bits):
            y = y.bitwiseOR(F.shiftrightunsigned(x, k))
        differ = differ + F.bit_count(y.bitwiseAND(F.lit(ones)))
    chance = 2.0**-plan.bits
    return (1 - differ / F.lit(float(plan.minima)) - chance) / (1 - chance)


def shingled(docs: DataFrame, ids: DataFrame, plan: Plan, id_col: str, text_col: str) -> DataFrame:
    """(id, s) of the rows whose id is in ``ids`` (want): their shingle sets as sorted 64-bit hashes."""
    n = ids.count()
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull())
    chosen = named.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, F.col("id") == F.col("want"), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                key, first = shingle_sets(batch.column("text"), plan.shingle)
                raw = [key[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(raw, pa.binary())], ["id", "s"])

    return written(chosen.mapInArrow(sets, "id long, s binary"), "sets")


def confirmed(pairs: DataFrame, docs: DataFrame, plan: Plan, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) whose full shingle sets link them. Only the texts that stand in a pair are read again.

    Pairs are gathered by the end that more of them share, at most ``FELLOWS`` a row, so a centre's set is sent once for so
    many pairs; where an id stands for several texts, a pair of ids is linked if any two of their sets are.
    """
    pairs = pairs.select("a", "b")
    ids = written(pairs.select(F.col("a").alias("want")).union(pairs.select("b")).distinct(), "confirm-ids")
    known = shingled(docs, ids, plan, id_col, text_col)
    shared = written(pairs.select(F.col("a").alias("end")).union(pairs.select("b")).groupBy("end").agg(F.count("*").alias("m")), "pair-ends")
    counted = lambda c: shared.select(F.col("end").alias(f"end_{c}"), F.col("m").alias(f"m_{c}"))
    sided = pairs.join(counted("a"), F.col("a") == F.col("end_a")).join(counted("b"), F.col("b") == F.col("end_b"))
    swap = F.col("m_b") > F.col("m_a")
    held = sided.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("hub"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("v"), F.ceil(F.greatest("m_a", "m_b") / FELLOWS).alias("parts"))
    spokes = held.join(known, F.col("v") == F.col("id")).select("hub", F.pmod(F.xxhash64("v"), F.col("parts")).alias("part"), F.struct("v", "s").alias("spoke"))
    # A part holds about FELLOWS sets: hashes deal them evenly, but for rows that repeat one id.
    gathered = spokes.groupBy("hub", "part").agg(F.collect_list("spoke").alias("spokes"))
    met = gathered.join(known.select("id", "s"), F.col("hub") == F.col("id")).select("hub", "s", "spokes")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for hub, own, spokes in zip(batch.column("hub").to_pylist(), batch.column("s"), batch.column("spokes"), strict=True):
                p = np.frombuffer(own.as_buffer(), np.uint64)
                others = spokes.values
                for v, raw in zip(others.field("v").to_pylist(), others.field("s"), strict=True):
                    q = np.frombuffer(raw.as_buffer(), np.uint64)
                    if linked(p, q, plan.percent):
                        a.append(min(hub, v))
                        b.append(max(hub, v))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return written(met.mapInArrow(compare, "a long, b long").distinct(), "links")


def linked(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    if len(p) > len(q):
        p, q = q, p
    if not len(p) or 100 * len(p) < percent * len(q):
        return False
    at = np.minimum(np.searchsorted(q, p), len(q) - 1)
    both = int(np.count_nonzero(q[at] == p))
    return both > 0 and 100 * both >= percent * (len(p) + len(q) - both)


def supported(members: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """(id, c, n, keys) of the members (id, c, n) that may link to another component c: their shingles that other components hold too."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in enumerate(batch.column("s")):
                key = np.frombuffer(raw.as_buffer(), np.int64)
                for at in range(0, len(key), 1 << 16):
                    some = key[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.repeat(batch.column(c)[i], len(some)) for c in ("id", "c", "n")] + [pa.array(some)], ["id", "c", "n", "key"])

    each = written(sets.join(members.withColumnRenamed("id", "m_id"), F.col("id") == F.col("m_id")).select("id", "c", "n", "s").mapInArrow(rows, "id long, c long, n long, key long"), "open-shingles")
    useful = each.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select(F.col("key").alias("k"))
    own = each.join(useful, F.col("key") == F.col("k"), "left_semi").groupBy("id", "c", "n").agg(F.collect_set("key").alias("keys"))  # no more than the text's own
    out = written(own.where(100 * F.size("keys") >= plan.percent * F.col("n")), "supported")
    dropped(out.sparkSession, each)
    return out


def _block(items: pa.StructScalar) -> tuple[np.ndarray, ...]:
    """(id, c, n, keys of all, place of each key's member)."""
    items = items.values
    column = lambda f: items.field(f).to_numpy(zero_copy_only=False)
    keys = items.field("keys")
    return column("id"), column("c"), column("n"), keys.flatten().to_numpy(), np.repeat(np.arange(len(items)), pc.list_value_length(keys).to_numpy())


def in_common(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...], width: int = 4096) -> np.ndarray:
    """How many keys each member of one block has in common with each of the other."""
    both = np.intersect1d(x[3], y[3])
    out = np.zeros((len(x[0]), len(y[0])), np.float32)

    def places(block: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(both, block[3])
        known = at < len(both)
        known[known] = both[at[known]] == block[3][known]
        order = np.argsort(at[known], kind="stable")
        return at[known][order], block[4][known][order]

    if not len(both):
        return out
    sides = [(*places(b), len(b[0])) for b in (x, y)]
    for low in range(0, len(both), width):
        parts = []
        for at, member, n in sides:
            a, b = np.searchsorted(at, (low, low + width))
            held = np.zeros((n, min(width, len(both) - low)), np.float32)
            held[member[a:b], at[a:b] - low] = 1
            parts.append(held)
        out += parts[0] @ parts[1].T  # whole numbers below 2 ** 24, as no text has so many shingles: exact
    return out


def connecting(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...], percent: int) -> list[tuple[int, int]]:
    """Links between members of different components, as many as connect those that any link connects."""
    both = in_common(x, y)
    near = (100 * both >= percent * (x[2][:, None] + y[2][None] - both)) & (x[1][:, None] != y[1][None])
    i, j = np.nonzero(near)
    low, high = np.minimum(x[1][i], y[1][j]), np.maximum(x[1][i], y[1][j])
    _, first = np.unique(np.stack([low, high]), axis=1, return_index=True)
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.setdefault(c, c) != c:
            c = root[c] = root[root[c]]
        return c

    out = []
    for k in first:
        a, b = find(int(low[k])), find(int(high[k]))
        if a != b:
            root[b] = a
            out.append((int(x[0][i[k]]), int(y[0][j[k]])))
    return out


def across(members: DataFrame, clumps: DataFrame, plan: Plan) -> DataFrame:
    """Links (a, b) that connect members (id, c, n, keys) of different components within one clump (v, root)."""
    placed = members.join(clumps, F.col("id") == F.col("v"), "left").withColumn("clump", F.coalesce("root", "id")).select("clump", "id", "c", "n", "keys")
    sizes = placed.groupBy(F.col("clump").alias("of")).agg(F.ceil(F.sum(F.size("keys")) / BLOCK_KEYS).alias("blocks"))
    dealt = placed.join(sizes, F.col("clump") == F.col("of")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    blocks = written(dealt.groupBy("clump", "blocks", "block").agg(F.collect_list(F.struct("id", "c", "n", "keys")).alias("items")), "blocks")
    left = blocks.select(F.col("clump").alias("l_clump"), F.col("items").alias("left"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("l_block"))
    pairs = left.join(blocks.select("clump", "block", F.col("items").alias("right")), (F.col("l_clump") == F.col("clump")) & (F.col("l_block") == F.col("block"))).select("left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ab for x, y in zip(batch.column("left"), batch.column("right"), strict=True) for ab in connecting(_block(x), _block(y), plan.percent)]
            ends = [pa.array([f(ab) for ab in found], pa.int64()) for f in (min, max)]
            yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    return written(pairs.mapInArrow(run, "a long, b long").distinct(), "links")


def near_duplicates(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of each row; component_id is the smallest id that its links reach."""
    rows = written(signatures(docs, plan, id_col, text_col), "signatures")
    linked = rows.where(F.col("id").isNotNull() & (F.col("n") > 0))
    classes = written(linked.groupBy("k1", "k2").agg(F.min(F.struct("id", "n", "low", "buckets")).alias("r")).select("k1", "k2", "r.*"), "classes")
    # A class is known by its smallest id; where an id stands for several texts, by the first of their classes.
    light = classes.select("id", "n", "low", "buckets")
    members = classes.select("id", F.posexplode("buckets").alias("band", "bucket"))
    shared = written(members.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select(F.col("bucket").alias("key"), "m"), "buckets")
    grouped = written(members.join(shared, F.col("bucket") == F.col("key")).select("band", "bucket", "id", "m"), "grouped")
    weights = written(grouped.groupBy(F.col("id").alias("w_id")).agg(F.sum("m").alias("w")), "weights")
    weighed = written(grouped.join(weights, F.col("id") == F.col("w_id")).select("band", "bucket", "id", "w"), "weighed")
    centres = written(weighed.groupBy(F.col("bucket").alias("key")).agg((-F.max(F.struct("w", (-F.col("id")).alias("x")))["x"]).alias("centre")), "centres")
    pair = weighed.join(centres, F.col("bucket") == F.col("key")).where("id <> centre")
    star = pair.groupBy(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).agg(F.lit(1).alias("one"))

    part = lambda c: light.select(F.col("id").alias(f"id_{c}"), F.col("n").alias(f"n_{c}"), F.col("low").alias(f"low_{c}"))
    close = (100 * F.least("n_a", "n_b") >= plan.percent * F.greatest("n_a", "n_b")) & (estimate(F.col("low_a"), F.col("low_b"), plan) >= plan.least_estimate)
    likely = star.join(part("a"), F.col("a") == F.col("id_a")).join(part("b"), F.col("b") == F.col("id_b")).where(close)
    scored = written(likely.select("a", "b", estimate(F.col("low_a"), F.col("low_b"), plan).alias("e")), "likely")
    ends = scored.select(F.col("b").alias("v"), F.col("a").alias("u"), "e").union(scored.select("a", "b", "e"))
    best = ends.groupBy("v").agg(F.max(F.struct("e", (-F.col("u")).alias("x")))["x"].alias("x")).select(F.least("v", -F.col("x")).alias("a"), F.greatest("v", -F.col("x")).alias("b")).distinct()
    first = confirmed(written(best, "pairs"), docs, plan, id_col, text_col)
    forest = components(first)

    def still_open(labels: DataFrame, within: DataFrame) -> DataFrame:
        """(bucket, id, w, c) of the members of buckets with several components."""
        now = written(within.select("bucket", "id", "w").join(labels, F.col("id") == F.col("v"), "left").select("bucket", "id", "w", F.coalesce("root", "id").alias("c")), "members")
        keys = now.groupBy("bucket").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select(F.col("bucket").alias("key"))
        return written(now.join(keys, F.col("bucket") == F.col("key"), "left_semi"), "open-members")

    rest = still_open(forest, weighed)
    heaviest = Window.partitionBy("bucket").orderBy(F.desc("w"), "id")  # limited before the shuffle, CENTRES rows a bucket and task
    heavy = rest.withColumn("k", F.row_number().over(heaviest)).where(F.col("k") <= CENTRES)
    tops = written(heavy.groupBy(F.col("bucket").alias("key")).agg(F.collect_list(F.struct((-F.col("w")).alias("w"), F.col("id").alias("u"), F.col("c").alias("uc"))).alias("tops")), "heavy")
    # One row a member and bucket, then one a member: at most bands x CENTRES centres, of which the CENTRES heaviest stay.
    near = rest.join(tops, F.col("bucket") == F.col("key")).groupBy("id", "c").agg(F.flatten(F.collect_list("tops")).alias("tops"))
    others = F.slice(F.array_sort(F.array_distinct(F.filter("tops", lambda x: x["uc"] != F.col("c")))), 1, CENTRES)
    meets = near.select("id", F.explode(others).alias("x")).select(F.least("id", "x.u").alias("a"), F.greatest("id", "x.u").alias("b")).distinct()
    likely = written(meets.join(part("a"), F.col("a") == F.col("id_a")).join(part("b"), F.col("b") == F.col("id_b")).where(close).select("a", "b"), "pairs")
    second = confirmed(likely, docs, plan, id_col, text_col)
    links = first.union(second)
    left = still_open(components(links), rest)
    if not left.isEmpty():
        open_ids = written(left.groupBy("id").agg(F.max("c").alias("c")), "open-ids")
        sets = shingled(docs, open_ids.select(F.col("id").alias("want")), plan, id_col, text_col)
        able = supported(open_ids.join(light.select("id", "n"), "id"), sets, plan)
        within = left.join(able.select(F.col("id").alias("s_id")), F.col("id") == F.col("s_id"), "left_semi")
        lowest = within.groupBy(F.col("bucket").alias("key")).agg(F.min("id").alias("u"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1")
        clumps = components(within.join(lowest, F.col("bucket") == F.col("key")).select(F.col("id").alias("a"), F.col("u").alias("b")))
        links = links.union(across(able, clumps, plan))
        dropped(docs.sparkSession, open_ids, sets)
    roots = components(links)

    settled = written(classes.select("k1", "k2", "id").join(roots, F.col("id") == F.col("v"), "left").select(F.col("k1").alias("x1"), F.col("k2").alias("x2"), F.coalesce("root", "id").alias("component_id")), "class-components")
    dropped(docs.sparkSession, classes, shared, grouped, weights, weighed, centres, scored, first, second, rest, left, tops)
    joined = linked.select("id", "n", "k1", "k2").join(settled, (F.col("k1") == F.col("x1")) & (F.col("k2") == F.col("x2"))).select("id", "n", "component_id")
    alone = rows.where(F.col("id").isNull() | (F.col("n") == 0)).select("id", "n", F.col("id").alias("component_id"))
    return joined.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that a row of a smaller id stands for. Rows of one id are rows apart, of which only equal and near-equal texts go. Rows with a null id stay."""

    gone, row = unused(docs, "__gone"), unused(docs, "__row")

    def without(rows: DataFrame, key: str, goes: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(goes) if goes.count() <= BROADCAST_IDS else goes, F.col(key) == F.col(gone), "left_anti")

    if docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").isEmpty():
        found = near_duplicates(docs, plan, id_col, text_col)
        return without(docs, id_col, written(found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(gone)), "duplicates"))
    keyed = written(docs.withColumn(row, F.when(F.col(id_col).isNotNull(), F.monotonically_increasing_id())), "keyed-rows")
    found = written(near_duplicates(keyed, plan, row, text_col).where(F.col(row).isNotNull()).select(F.col(row).alias("row"), "n_shingles", "component_id"), "row-components")
    ids = keyed.select(F.col(row).alias("key"), F.col(id_col).alias("id"), F.sha2(F.col(text_col).cast("binary"), 256).alias("sha"))
    bare = F.col("n_shingles") == 0  # texts without words are linked with nothing: of those only the same text of the same id goes
    group = [F.when(~bare, F.col("component_id")).alias("c"), F.when(bare, F.col("id")).alias("i"), F.when(bare, F.col("sha")).alias("s")]
    kept = found.join(ids, F.col("row") == F.col("key")).groupBy(*group).agg(F.min(F.struct("id", "row"))["row"].alias("kept"))
    goes = found.join(kept, F.col("row") == F.col("kept"), "left_anti").select(F.col("row").alias(gone))
    return without(keyed, row, written(goes, "duplicates")).drop(row)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_duplicates(table(spark, sf_dir, "documents"), Plan(shingle=3, percent=85))
    return got.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
     sh AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') || chr(10) || len(ws) ELSE array_to_string(ws[i:i+2], ' ') END AS s
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
     n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
     common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
     link AS (SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
     edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
     reach AS (SELECT doc_id AS v, doc_id AS r FROM w UNION SELECT e.b, reach.r FROM reach JOIN edge e ON e.a = reach.v WHERE reach.r < e.b),
     c AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.v = w.doc_id
"""

QUERIES = {"op9_near_duplicates": op9_near_duplicates}
ORACLES = {"op9_near_duplicates": ORACLE}
