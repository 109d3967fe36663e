"""Operator 6, best-fit packing by a grouping genetic algorithm.

A document's ids are cut only beyond the capacity; whole-capacity pieces fill a sequence each, so what is packed are
rests shorter than it. They are dealt at random into demes of about ``DEME`` pieces. ``ISLANDS`` islands evolve each deme
apart: an individual is a grouping, the first ones by best fit with more and more noise. Crossover injects some of the
best-filled bins of one parent into the other, removes the bins that hold an injected piece a second time and a few of the
worst, exchanges displaced pieces with smaller ones of bins that have room, and best-fits the rest in decreasing
order. After ``GENERATIONS`` children each island's elite migrates to the next island, ``EPOCHS`` - 1 times; then the best
grouping stands. A deme whose elite reaches the lower bound does not evolve further. Badly filled bins are opened
again and their pieces packed anew across demes, ``ROUNDS`` times.

A task holds one island, at first a fixed number of 16-byte rows, then one row; neither texts nor ids are shuffled.

Defined cases: a null or empty text is the end id alone; null ids and repeated rows are pieces as any other (a row's key
is its own, not the id); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import default_vocabulary, read_vocabulary
from .storage import table, unused, written
from .textcore import slices
from .tokens import TokenIds

CAPACITY = 1024
END = 2
DEME = 4096
ISLANDS = 2
POPULATION = 8
#: Children of an island from one migration to the next, and rounds of them.
GENERATIONS = 64
EPOCHS = 3
ROUNDS = 2
#: The largest share of the donor's bins that a crossover injects, and the pieces that it tries to exchange.
SECTION = 0.05
EXCHANGES = 1024
#: A bin below this share of the capacity is packed anew across demes.
REOPEN = 0.97


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of each document's pieces; the first may be shorter than the capacity."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["__id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = TokenIds(shared.value)
        for whole in batches:
            for batch in slices(whole, "__text"):
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                for i, got in enumerate(encode.each(batch.column("__text").to_pylist(), end)):
                    first = len(got) % capacity or capacity
                    cuts = [0, *range(first, len(got) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        row.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(got[a:b].tobytes()))
                        if ids:
                            kept.append(got[a:b].astype(np.int32))
                out = [batch.column("__id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                if ids:
                    out.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names)

    got = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    out = got.mapInArrow(run, f"__id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids)
    return out.withColumnRenamed("__id", id_col)


class Genes:
    """Groupings of one deme's pieces: an array that names each piece's bin."""

    def __init__(self, size: np.ndarray, capacity: int, seed: int):
        self.size, self.capacity = size, capacity
        self.random = np.random.Generator(np.random.PCG64(seed))

    def best_fit(self, group: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Puts ``items``, in this order, each into the bin with the least room that is enough, else into a new one."""
        used = group >= 0
        n = int(group.max(initial=-1)) + 1
        room = (self.capacity - np.bincount(group[used], self.size[used], n)).astype(int)
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        open_ = 0
        some = np.flatnonzero((room > 0) & (room < self.capacity))
        for b, r in zip(some.tolist(), room[some].tolist(), strict=True):
            by_room[r].append(b)
            open_ |= 1 << r
        placed = []
        for s in self.size[items].tolist():
            fits = open_ >> s
            if fits:
                r = s + (fits & -fits).bit_length() - 1
                b = by_room[r].pop()
                if not by_room[r]:
                    open_ ^= 1 << r
            else:
                r, b, n = self.capacity, n, n + 1
            placed.append(b)
            if r > s:
                by_room[r - s].append(b)
                open_ |= 1 << (r - s)
        group[items] = placed
        return group

    def new(self, noise: float) -> np.ndarray:
        key = self.size * (1 + noise * self.random.standard_normal(len(self.size)))
        return self.best_fit(np.full(len(self.size), -1), np.argsort(-key, kind="stable"))

    def fill(self, group: np.ndarray) -> np.ndarray:
        return np.bincount(group, self.size)

    def fitness(self, group: np.ndarray) -> tuple[int, float]:
        """Fewer bins first, then fuller and emptier ones rather than even ones."""
        fill = self.fill(group)
        return -int(np.count_nonzero(fill)), float(np.sum((fill / self.capacity) ** 2))

    def least(self) -> int:
        """A lower bound of the bins: for a limit k, pieces over capacity - k share with none of at least k, and those over half not with one another."""
        size, half = np.sort(self.size), self.capacity // 2
        total = np.concatenate([[0], np.cumsum(size)])
        below = lambda x: np.searchsorted(size, x, "left")
        over = np.searchsorted(size, half, "right")
        k = np.unique(np.concatenate([[0], size[:over]]))
        large = np.searchsorted(size, self.capacity - k, "right")
        middle = large - over
        spare = middle * self.capacity - (total[large] - total[over])
        return int(np.max(len(size) - large + middle + np.maximum(0, -(-(total[over] - total[below(k)] - spare) // self.capacity))))

    def exchange(self, group: np.ndarray, loose: np.ndarray) -> np.ndarray:
        """Swaps a displaced piece for a smaller one of a bin with room, where that fills the bin better. The displaced pieces after that."""
        held = np.flatnonzero(group >= 0)
        room = self.capacity - np.bincount(group[held], self.size[held])
        tight = held[room[group[held]] > 0]
        if not len(tight) or not len(loose):
            return loose
        room = room.astype(int).tolist()  # the loop below is quicker with Python's own numbers
        tight = self.random.permutation(tight)[:EXCHANGES]
        loose = loose[np.argsort(self.size[loose], kind="stable")].tolist()
        sizes = self.size[loose].tolist()
        at = group[tight].tolist()
        own = self.size[tight].tolist()
        for item, b, s in zip(tight.tolist(), at, own, strict=True):
            k = bisect_right(sizes, s + room[b]) - 1
            if k >= 0 and sizes[k] > s:
                group[item], group[loose[k]] = -1, b
                room[b] -= sizes[k] - s
                del loose[k], sizes[k]
                k = bisect_left(sizes, s)
                sizes.insert(k, s)
                loose.insert(k, item)
        return np.array(loose, np.int64)

    def crossover(self, into: np.ndarray, donor: np.ndarray) -> np.ndarray:
        """``into`` with a section of the donor's best-filled bins; bins that hold a piece twice are opened, and of the worst bins some."""
        fill = self.fill(donor)
        full = np.flatnonzero(fill)
        section = int(self.random.integers(1, max(2, int(SECTION * len(full)) + 1)))
        wanted = full[np.argsort(-fill[full] * (1 + 0.02 * self.random.random(len(full))), kind="stable")[: 4 * section]]
        good = np.zeros(len(fill), bool)
        good[self.random.permutation(wanted)[:section]] = True
        injected = good[donor]
        own = self.fill(into)
        opened = np.zeros(len(own), bool)
        opened[into[injected]] = True
        worst = np.argsort(own + self.capacity * (own == 0) + 8 * self.random.random(len(own)))
        opened[worst[: int(self.random.integers(1, 2 + section))]] = True  # mutation
        loose = opened[into] & ~injected
        child = into.copy()
        child[injected] = donor[injected] + len(own)
        child[loose] = -1
        names = np.zeros(len(own) + len(fill), np.int64)
        names[child[~loose]] = 1
        child[~loose] = (np.cumsum(names) - 1)[child[~loose]]
        items = self.exchange(child, np.flatnonzero(loose))
        key = self.size[items] * (1 + 0.02 * self.random.standard_normal(len(items)))
        return self.best_fit(child, items[np.argsort(-key, kind="stable")])

    def evolve(self, population: list[np.ndarray], generations: int) -> list[np.ndarray]:
        """The population after so many children, the elite first. Ends early where the elite reaches the lower bound."""
        least = self.least()
        ranked = sorted(((self.fitness(g), i, g) for i, g in enumerate(population)), reverse=True)
        for n in range(generations):
            if -ranked[0][0][0] <= least or len(ranked) < 2:
                break
            a, b = self.random.choice(len(ranked), 2, replace=False)
            child = self.crossover(ranked[min(a, b)][2], ranked[max(a, b)][2])
            got = self.fitness(child)
            if got > ranked[-1][0] and all(got != r[0] for r in ranked):  # equals would drive out variety
                ranked = sorted([*ranked[:-1], (got, -1 - n, child)], reverse=True)
        return [r[2] for r in ranked]


def _seed(*key: int) -> int:
    return zlib.crc32(",".join(map(str, key)).encode())


def _evolved(items: DataFrame, capacity: int) -> DataFrame:
    """(uid, length, bin, fill, offset) for (uid, length): bin is the smallest uid in it, fill what lies in it; the longest piece lies first."""
    demes = max(1, -(-items.count() // DEME))
    dealt = items.withColumn("deme", F.pmod(F.xxhash64("uid"), F.lit(demes)).cast("int"))
    #: An island is a row: its pieces in order of uid, and its population, one grouping after another.
    schema = "deme int, island int, uid array<long>, length array<long>, population array<int>"

    def row(deme: int, island: int, uid: np.ndarray, size: np.ndarray, population: list[np.ndarray]) -> pa.Table:
        lists = [pa.array([x], k) for x, k in ((uid, pa.list_(pa.int64())), (size, pa.list_(pa.int64())), (np.concatenate(population).astype(np.int32), pa.list_(pa.int32())))]
        return pa.Table.from_arrays([pa.array([deme], pa.int32()), pa.array([island], pa.int32()), *lists], ["deme", "island", "uid", "length", "population"])

    def settlers(data: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """(origin, uid, size, population) of each row, by origin."""
        out = []
        for r in data.to_pylist():
            uid = np.array(r["uid"], np.int64)
            out.append((r["origin"], uid, np.array(r["length"], np.int64), list(np.array(r["population"], np.int64).reshape(-1, len(uid)))))
        return sorted(out, key=lambda x: x[0])

    def begin(key: tuple, data: pa.Table) -> pa.Table:
        deme, island = (k.as_py() for k in key)
        data = data.sort_by("uid")
        uid, size = data.column("uid").to_numpy(), data.column("length").to_numpy()
        genes = Genes(size, capacity, _seed(deme, island))
        noise = [0.0 if island == 0 and i == 0 else 0.02 * (i + 1) for i in range(POPULATION)]
        return row(deme, island, uid, size, genes.evolve([genes.new(x) for x in noise], GENERATIONS))

    def migrate(key: tuple, data: pa.Table) -> pa.Table:
        """An island's population, in which its neighbour's elite takes the place of the worst, evolves on."""
        deme, island, epoch = (k.as_py() for k in key)
        all_ = settlers(data)
        own = next(x for x in all_ if x[0] == island)
        guests = [x[3][0] for x in all_ if x[0] != island]
        genes = Genes(own[2], capacity, _seed(deme, island, epoch))
        return row(deme, island, own[1], own[2], genes.evolve([*own[3][: max(1, POPULATION - len(guests))], *guests], GENERATIONS))

    def choose(key: tuple, data: pa.Table) -> pa.Table:
        all_ = settlers(data)
        _, uid, size, _ = all_[0]
        genes = Genes(size, capacity, 0)
        group = max((x[3][0] for x in all_), key=genes.fitness)
        lowest = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(lowest, group, uid)
        fill = genes.fill(group).astype(np.int64)
        order = np.lexsort((-uid, -size, group))
        offset = np.empty_like(size)
        offset[order] = np.cumsum(size[order]) - size[order] - (np.cumsum(fill) - fill)[group[order]]
        return pa.table({"uid": uid, "length": size, "bin": lowest[group], "fill": fill[group], "offset": offset})

    islands = dealt.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)]))).select("deme", "island", "uid", "length")
    state = written(islands.groupBy("deme", "island").applyInArrow(begin, schema), "islands")
    for epoch in range(1, EPOCHS):
        # An island's row goes to itself and to the next one; the next one takes no more of it than the elite.
        moved = state.withColumn("origin", F.col("island")).withColumn("island", F.explode(F.array(F.col("island"), (F.col("island") + 1) % ISLANDS))).withColumn("epoch", F.lit(epoch))
        light = moved.withColumn("population", F.when(F.col("island") == F.col("origin"), F.col("population")).otherwise(F.slice("population", 1, F.size("uid"))))
        state = written(light.groupBy("deme", "island", "epoch").applyInArrow(migrate, schema), "islands")
    return state.withColumn("origin", F.col("island")).groupBy("deme").applyInArrow(choose, "uid long, length long, bin long, fill long, offset long")


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (with a column length, at most the capacity) with sequence_id and offset.

    A sequence's pieces lie without a gap from offset 0 on. Other columns pass through, but for those two names.
    """
    key = unused(parts, "__uid")
    parts = written(parts.drop("sequence_id", "offset").withColumn(key, F.monotonically_increasing_id()), "pieces")
    rest = parts.where(F.col("length") < capacity).select(F.col(key).alias("uid"), "length")
    done: list[DataFrame] = []
    for more in reversed(range(ROUNDS)):
        packed = written(_evolved(rest, capacity), "packed")
        poor = F.col("fill") < REOPEN * capacity
        done.append(packed.where(~poor) if more else packed)
        rest = packed.where(poor).select("uid", "length")
    bins = functools.reduce(DataFrame.unionByName, done)
    places = bins.select(F.col("uid").alias(key), (2 * F.col("bin")).alias("sequence_id"), "offset")
    short = parts.where(F.col("length") < capacity).join(places, key)
    full = parts.where(F.col("length") == capacity).withColumns({"sequence_id": 2 * F.col(key) + 1, "offset": F.lit(0).cast("long")})
    return short.unionByName(full).drop(key)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pack(pieces(table(spark, sf_dir, "documents"), default_vocabulary()))
    return got.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op6_packing": op6_packing}
ORACLES: dict[str, str] = {}
