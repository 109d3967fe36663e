"""Scopes, tiles and source selections: driver-side values that turn into Column predicates."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[float, float, float, float]

# Fixed values of sources and scopes.
SOURCES = ("fsq", "overture", "osm")
DEFAULT_SOURCES = ("overture", "osm")
CODE = {"fsq": 1, "overture": 2, "osm": 4}
PRIORITY = {"fsq": 0, "overture": 1, "osm": 2}
ALIASES = {"foursquare": "fsq", "4sq": "fsq", "fsq": "fsq", "overture": "overture", "overturemaps": "overture", "osm": "osm", "openstreetmap": "osm", "geofabrik": "osm"}
PH_BOX: Box = (116.80, 4.40, 126.70, 21.30)


class SourceSelectionError(ValueError):
    """An unknown source, or none."""


def sources_of(values: str | list[str] | tuple[str, ...] | None) -> tuple[str, ...]:
    """The named sources once each, in the fixed order; the default for None."""
    if values is None:
        return DEFAULT_SOURCES
    words = re.split(r"[,\s]+", values) if isinstance(values, str) else [w for v in values for w in re.split(r"[,\s]+", v)]
    words = [w.strip().lower() for w in words if w.strip()]
    if "all" in words:
        return SOURCES
    if unknown := sorted({w for w in words if w not in ALIASES}):
        raise SourceSelectionError(f"unknown source {', '.join(unknown)}; known: {', '.join(SOURCES)}")
    if not words:
        raise SourceSelectionError("no source named")
    return tuple(s for s in SOURCES if s in {ALIASES[w] for w in words})


def source_pairs(sources: tuple[str, ...]) -> list[tuple[str, str]]:
    return list(combinations([s for s in SOURCES if s in sources], 2))


@dataclass(frozen=True)
class Scope:
    name: str
    boxes: tuple[Box, ...]
    national: bool = False

    def __post_init__(self) -> None:
        if not self.boxes:
            raise ValueError("a scope has one box at least")
        for w, s, e, n in self.boxes:
            if not (w < e and s < n and all(map(math.isfinite, (w, s, e, n)))):
                raise ValueError(f"not a box: {(w, s, e, n)}")

    @property
    def slug(self) -> str:
        return re.sub("[ ,]", "_", self.name)

    def contains(self, lon: Column, lat: Column) -> Column:
        """Half-open in both directions."""
        return reduce(lambda a, b: a | b, [(lon >= w) & (lon < e) & (lat >= s) & (lat < n) for w, s, e, n in self.boxes])


@dataclass(frozen=True, order=True)
class Tile:
    """A grid cell [x * size, (x + 1) * size), likewise in y."""

    iy: int
    ix: int
    size: float

    @property
    def box(self) -> Box:
        return self.ix * self.size, self.iy * self.size, (self.ix + 1) * self.size, (self.iy + 1) * self.size

    @property
    def key(self) -> str:
        return f"s{self.size:g}_x{self.ix:+05d}_y{self.iy:+05d}"

    def contains(self, lon: Column, lat: Column) -> Column:
        w, s, e, n = self.box
        return (lon >= w) & (lon < e) & (lat >= s) & (lat < n)

    def children(self, size: float) -> list[Tile]:
        per = round(self.size / size)
        if per < 1 or abs(per * size - self.size) > 1e-9:
            raise ValueError(f"{size} does not divide {self.size}")
        return [Tile(self.iy * per + j, self.ix * per + i, size) for j in range(per) for i in range(per)]


def tiles(boxes: tuple[Box, ...], size: float) -> list[Tile]:
    """All tiles that a half-open box touches, once each, by row and column."""
    found = set()
    for w, s, e, n in boxes:
        last_x, last_y = (math.floor(math.nextafter(v, -math.inf) / size) for v in (e, n))
        found |= {Tile(y, x, size) for y in range(math.floor(s / size), last_y + 1) for x in range(math.floor(w / size), last_x + 1)}
    return sorted(found)


def with_halo(box: Box, metres: float) -> Box:
    d = metres / 100_000
    w, s, e, n = box
    return w - d, s - d, e + d, n + d


def tile_columns(lon: Column, lat: Column, size: float) -> tuple[Column, Column]:
    return F.floor(lon / F.lit(size)).cast("int"), F.floor(lat / F.lit(size)).cast("int")
