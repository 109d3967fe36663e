"""Pairs of rows in reach of each other with the scores of their names, worked out by numpy over Arrow.

Rows go to Python once a cell, not once a pair: partitions are sorted by cell, each cell's pairs are formed there, and a worker
scores each different pair of names once for as long as it remembers it. So rows cross to Python, and of the pairs only those
that are kept come back. Cells of many rows are dealt to several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelink.functions import geo
from placelink.functions.similarity import Picked, jaro_winkler

#: Right rows of a cell for each part of its left rows.
DENSE = 4096
#: Rows that a task holds, pairs that it works on at once (few enough for a core's cache), pairs that it gives at once, names and pairs that it remembers.
HELD, SLAB, GIVEN, NAMES, KNOWN = 16384, 1 << 17, 1 << 16, 1 << 18, 1 << 22
#: Names whose scores stand in a square table (128 MB at most); of more, ``KNOWN`` pairs are remembered by key.
WIDE = 4095
#: Between a name and its sorted tokens; no normalized name holds it.
MARK = "\x1f"


class Scores:
    """Scores of different pairs of names, remembered. A name is ``norm`` or ``norm MARK tokens``; of the latter the larger score counts. Below ``floor`` a score may be 0."""

    def __init__(self, floor: float = 0.0):
        self.floor = floor
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.names: list[bytes] = []
        self.others: list[bytes] = []  # the sorted tokens, or the name where there are none
        self.bits: list[tuple[int, int, int, int, bool]] = []
        self.features = np.zeros((0, 5), np.int64)  # the same as an array
        self.keys, self.values = np.zeros(0, np.int64), np.zeros(0)
        self.table = np.full((1, 1), np.nan)  # row and column 0 are nulls; 0 is not known yet, -1 a score of 0

    def encode(self, column: pa.Array) -> np.ndarray:
        """Numbers of names; -1 for a null."""
        coded = column.dictionary_encode()
        number = np.full(len(coded.dictionary) + 1, -1, np.int64)
        for i, name in enumerate(coded.dictionary.to_pylist()):
            at = self.ids.get(name)
            if at is None:
                at = self.ids[name] = len(self.names)
                norm, mark, tokens = name.partition(MARK)
                raw, other = norm.encode(), tokens.encode() if mark else norm.encode()
                self.names.append(raw)
                self.others.append(other)
                # A bit for each byte, taken mod 64: unlike bits mean unlike bytes.
                self.bits.append((int(np.uint64(sum({1 << (x & 63) for x in raw})).astype(np.int64)), len(raw), raw[0] if raw else -1, other[0] if other else -2, other != raw))
            number[i] = at
        return number[coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)]

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The scores of pairs of numbers; NaN where one is -1."""
        if not len(left):
            return np.zeros(0)
        if len(self.names) <= WIDE:
            return self._looked_up(left, right)
        self.table = np.full((1, 1), np.nan)
        code, keys = pd.factorize((left << 32) | (right & 0xFFFFFFFF))
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        got = np.empty(len(keys))
        got[known] = self.values[at[known]]
        if not known.all():
            new = keys[~known]
            a, b = new >> 32, (new & 0xFFFFFFFF).astype(np.uint32).astype(np.int32).astype(np.int64)
            got[~known] = self._scored(a, b)
            if len(self.keys) + len(new) > KNOWN:
                self.keys, self.values = np.zeros(0, np.int64), np.zeros(0)
            keys, values = np.concatenate([self.keys, new]), np.concatenate([self.values, got[~known]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.values = keys[order], values[order]
        return got[code]

    def _looked_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        n = len(self.table)
        if n <= len(self.names):
            wider = np.zeros((1 << len(self.names).bit_length(),) * 2)
            wider[0, :] = wider[:, 0] = np.nan
            wider[:n, :n] = self.table
            self.table, n = wider, len(wider)
        flat, at = self.table.reshape(-1), (left + 1) * n + (right + 1)
        got = flat[at]
        new = np.flatnonzero(got == 0)
        if len(new):
            keys = pd.unique(at[new])
            score = self._scored(keys // n - 1, keys % n - 1)
            flat[keys] = np.where(score == 0, -1.0, score)
            got[new] = flat[at[new]]
        return np.maximum(got, 0.0, out=got)

    def _scored(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.where((a < 0) | (b < 0), np.nan, 0.0)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        if self.floor and len(todo):
            todo = todo[self._most(a[todo], b[todo]) >= self.floor]
        a, b = a[todo], b[todo]
        out[todo] = jaro_winkler(Picked(self.names, a), Picked(self.names, b))
        twin = self._features()[:, 4]
        both = np.flatnonzero(twin[a] | twin[b])
        out[todo[both]] = np.maximum(out[todo[both]], jaro_winkler(Picked(self.others, a[both]), Picked(self.others, b[both])))
        return out

    def _features(self) -> np.ndarray:
        """A row for each name."""
        n = len(self.features)
        if n < len(self.names):
            self.features = np.concatenate([self.features, np.array(self.bits[n:], np.int64)])
        return self.features

    def _most(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """No less than the score: a byte whose bit only one name has is matched nowhere, and names with unlike first bytes have no bonus."""
        mask, length, first, second, _ = self._features().T
        i, j = a, b
        la, lb = length[i], length[j]
        m = np.minimum(la - np.bitwise_count((mask[i] & ~mask[j]).view(np.uint64)), lb - np.bitwise_count((mask[j] & ~mask[i]).view(np.uint64)))
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(m > 0, (m / la + m / lb + 1) / 3, 0.0)
        bonus = np.where((first[i] == first[j]) | (second[i] == second[j]), 0.4, 0.0)
        return 1e-9 + bonus + (1 - bonus) * jaro


@lru_cache(maxsize=8)
def scores(kind: str, floor: float) -> Scores:
    """The worker's own."""
    return Scores(floor)


def dealt(obs: DataFrame, cell: float, sides: tuple[Column, Column]) -> DataFrame:
    """Left rows in their own and the eight cells around, right rows in theirs, sorted by cell within partitions. obs: code, lon, lat, source_id and more; sides: which rows are left, which right."""
    c = F.col
    placed = obs.where("lon IS NOT NULL AND lat IS NOT NULL").withColumns({"gx": geo.cell(c("lon"), cell), "gy": geo.cell(c("lat"), cell)})
    to = lambda i, j, side: F.struct((c("gx") + i).alias("nx"), (c("gy") + j).alias("ny"), F.lit(side).alias("side"))
    none = F.array().cast("array<struct<nx: bigint, ny: bigint, side: int>>")
    around = F.when(sides[0], F.array(*[to(i, j, 0) for i in (-1, 0, 1) for j in (-1, 0, 1)])).otherwise(none)
    rows = placed.withColumn("to", F.explode(F.concat(around, F.when(sides[1], F.array(to(0, 0, 1))).otherwise(none)))).select("*", "to.*").drop("to", "gx", "gy")
    heavy = placed.where(sides[1]).groupBy(c("gx").alias("hx"), c("gy").alias("hy")).agg(F.ceil(F.count("*") / DENSE).cast("int").alias("parts")).where("parts > 1")
    # A dense cell's left rows are dealt to its parts; its right rows go to each. The broadcast side has a row for ``DENSE`` rows at most.
    rows = rows.join(F.broadcast(heavy), (c("nx") == c("hx")) & (c("ny") == c("hy")), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    one = F.pmod(F.xxhash64("source", "source_id", "lon", "lat"), c("parts")).cast("int")
    rows = rows.withColumn("part", F.explode(F.when(c("side") == 0, F.array(one)).otherwise(F.sequence(F.lit(0), c("parts") - 1)))).drop("hx", "hy", "parts")
    keys = ["nx", "ny", "part"]
    return rows.repartition(int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys, "side", "code")


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole cells together, some ``HELD`` rows at a time."""
    held: list[pa.RecordBatch] = []
    joined = lambda: pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= HELD:
            whole = joined()
            last = np.ones(rows, bool)
            for k in ("nx", "ny", "part"):
                v = whole.column(k).to_numpy(zero_copy_only=False)
                last &= v == v[-1]
            cut = int(np.argmax(last))  # sorted: the rows of the last cell stand at the end
            held, rows = [whole.slice(cut)], rows - cut
            if cut:
                yield whole.slice(0, cut)
    if held:
        yield joined()


def _chord(metres: float) -> float:
    return math.sin(min(metres / (2 * geo.EARTH_RADIUS_M), math.pi / 2)) ** 2


def near(rows: pa.RecordBatch, cell: float, lat_span: float, metres: float, fresh: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(left, right, squared half chord) of the pairs within ``metres``, ``SLAB`` met pairs at a time."""
    col = {k: rows.column(k).to_numpy(zero_copy_only=False) for k in ("nx", "ny", "part", "side", "code", "lon", "lat", *(("fresh",) if fresh else ()))}
    new = np.zeros(rows.num_rows, bool)
    for k in ("nx", "ny", "part"):
        new[1:] |= col[k][1:] != col[k][:-1]
    group = np.cumsum(new)
    left, right = np.flatnonzero(col["side"] == 0), np.flatnonzero(col["side"] == 1)
    place = group[right] * 8 + col["code"][right]  # rows are sorted by it
    start = np.searchsorted(place, group[left] * 8 + col["code"][left], side="right")
    n = np.searchsorted(place, group[left] * 8 + 7, side="right") - start
    left, start, n = left[n > 0], start[n > 0], n[n > 0]
    lon, lat = col["lon"], col["lat"]
    x, y = np.radians(lon), np.radians(lat)
    cos, limit = np.cos(y), _chord(metres)
    total = np.cumsum(n)
    a = 0
    while a < len(left):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + SLAB, side="right")))
        i = np.repeat(left[a:b], n[a:b])
        j = right[np.arange(len(i)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b]) + np.repeat(start[a:b], n[a:b])]
        a = b
        keep = (np.abs(lat[j] - lat[i]) <= lat_span) & (np.abs(lon[j] - lon[i]) <= cell)
        if fresh:
            keep &= col["fresh"][i] | col["fresh"][j]
        i, j = i[keep], j[keep]
        s = np.sin((y[j] - y[i]) / 2) ** 2 + cos[i] * cos[j] * np.sin((x[j] - x[i]) / 2) ** 2
        keep = s <= limit
        for k in np.flatnonzero(np.abs(s - limit) <= 1e-9 * limit):  # too close for the rounding of other functions
            keep[k] = haversine(lon[i[k]], lat[i[k]], lon[j[k]], lat[j[k]]) <= metres
        yield i[keep], j[keep], s[keep]


def haversine(lon1: float, lat1: float, lon2: float, lat2: float) -> float:
    s = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_M * math.asin(math.sqrt(s))


def met(obs: DataFrame, cell: float, lat_span: float, metres: float, sides: tuple[Column, Column], kind: str, floor: float, keeps: Callable[..., np.ndarray] | None, columns: list[str], fresh: bool = False) -> DataFrame:
    """l_ and r_ ``columns`` (one that is given as r_ of the right row only) of pairs within ``metres``, with name_score and, where ``columns`` has category, category_score.

    obs: source, source_id, code, lon, lat, name, generic, category and ``columns``. keeps(chord, score, generic) tells of each pair: 0 no, 1 let in,
    2 let in and certain. Then there are two more columns: sure, and generic where an end is.
    """
    of = dict(obs.dtypes)
    given = [(p, k.removeprefix("r_")) for p in "lr" for k in columns if k != "category" and (p == "r" or not k.startswith("r_"))]
    categories = "category" in columns
    schema = ", ".join([f"{p}_{k} {of[k]}" for p, k in given] + ["name_score double"] + ["category_score double"] * categories + ["sure boolean", "generic boolean"] * (keeps is not None))
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, kinds = scores(kind, floor), scores("category", 0.0)
        for rows in cells(batches):
            for s in (known, kinds):
                if len(s.ids) > NAMES:
                    s.clear()
            name = known.encode(rows.column("name"))
            category = kinds.encode(rows.column("category")) if categories else None
            generic = rows.column("generic").fill_null(False).to_numpy(zero_copy_only=False)
            made: list[tuple[np.ndarray, ...]] = []

            def given_back() -> pa.RecordBatch:
                i, j, score, *told = (np.concatenate(x) for x in zip(*made, strict=True))
                made.clear()
                out = [rows.column(k).take(pa.array(i if p == "l" else j)) for p, k in given] + [pa.array(score, from_pandas=True)]
                if categories:
                    out.append(pa.array(np.nan_to_num(kinds.of(category[i], category[j]), nan=0.0)))
                return pa.RecordBatch.from_arrays(out + [pa.array(x) for x in told], names)

            for i, j, chord in near(rows, cell, lat_span, metres, fresh):
                score = known.of(name[i], name[j])
                told = ()
                if keeps is not None:
                    either = generic[i] | generic[j]
                    verdict = keeps(chord, score, either)
                    kept = np.flatnonzero(verdict)
                    i, j, score = i[kept], j[kept], score[kept]
                    told = (verdict[kept] == 2, either[kept])
                made.append((i, j, score, *told))
                if sum(len(m[0]) for m in made) >= GIVEN:
                    yield given_back()
            if any(len(m[0]) for m in made):
                yield given_back()

    return dealt(obs, cell, sides).mapInArrow(run, schema)
