"""Candidate pairs by grid blocking, acceptance, and accepted edges.

All source pairs come from one join: each row meets the rows of later sources in its own and the eight cells around. A
cell is at least as wide as the match radius anywhere in the area, so no pair is lost; the box condition
spares most trigonometry. Where names are scored, ``pairs`` forms the pairs: a row crosses to Python once a cell.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelink.functions import geo, licence, text
from placelink.functions.similarity import jw
from placelink.operators import pairs
from placelink.plans.scope import CODE, SOURCES, Tile, source_pairs

# Fixed values of the matching rules.
GENERIC_NAMES = ("atm", "office", "store", "shop", "canteen", "market", "restaurant", "school", "church", "clinic", "hospital", "pharmacy", "bank", "terminal")
GENERIC_MAX_M, GENERIC_MIN_SCORE, GENERIC_MAX_LENGTH = 15.0, 0.99, 4
LADDER = ((20.0, 0.70), (50.0, 0.82), (90.0, 0.90), (math.inf, 0.94))
CUTOFF = 0.65
LAT_M, LON_M, COS = 110_574.0, 111_320.0, math.cos(math.radians(21.5))
WEIGHTS = (0.80, 0.18, 0.02)


@dataclass(frozen=True)
class MatchConfig:
    max_distance_m: float = 120.0
    safety: float = 1.02

    def __post_init__(self) -> None:
        if not (math.isfinite(self.max_distance_m) and self.max_distance_m > 0):
            raise ValueError("the match radius is a positive number of metres")
        if not (math.isfinite(self.safety) and self.safety >= 1):
            raise ValueError("the safety factor is 1 or more")

    @property
    def cell(self) -> float:
        """Degrees of a cell, and of the box in longitude."""
        return self.max_distance_m * self.safety / (LON_M * COS)

    @property
    def lat_span(self) -> float:
        return self.max_distance_m * self.safety / LAT_M

    def describe(self) -> dict[str, float]:
        return {"max_distance_m": self.max_distance_m, "safety": self.safety, "cell": self.cell, "lat_span": self.lat_span}


def bands(max_distance_m: float) -> list[tuple[float, float]]:
    """(distance, least score) steps; the last ends at the radius and keeps its own score."""
    out = []
    for limit, score in LADDER:
        out.append((min(limit, max_distance_m), score))
        if limit >= max_distance_m:
            break
    return out


def is_generic(name: Column) -> Column:
    return name.isin(*GENERIC_NAMES) | (F.length(name) <= GENERIC_MAX_LENGTH)


def admitted(distance: Column, score: Column, generic: Column, max_distance_m: float) -> Column:
    """The ladder, and the strict rule where a name is generic. Names are not empty."""
    steps = bands(max_distance_m)
    by_distance = F.when(distance <= steps[0][0], score >= steps[0][1])
    for limit, least in steps[1:]:
        by_distance = by_distance.when(distance <= limit, score >= least)
    strict = (distance <= min(GENERIC_MAX_M, max_distance_m)) & (score >= GENERIC_MIN_SCORE)
    return F.when(generic, strict).otherwise(by_distance.otherwise(False))


def accepted(distance: Column, score: Column, left: Column, right: Column, max_distance_m: float) -> Column:
    return (left != "") & (right != "") & admitted(distance, score, is_generic(left) | is_generic(right), max_distance_m)


def accepts(distance: float, score: float, left: str, right: str, max_distance_m: float = 120.0) -> bool:
    """The same rule in plain Python."""
    if not left or not right or distance > max_distance_m:
        return False
    if any(n in GENERIC_NAMES or len(n) <= GENERIC_MAX_LENGTH for n in (left, right)):
        return distance <= GENERIC_MAX_M and score >= GENERIC_MIN_SCORE
    return next(score >= least for limit, least in bands(max_distance_m) if distance <= limit)


def candidates(obs: DataFrame, cfg: MatchConfig = MatchConfig(), sources: tuple[str, ...] = SOURCES, core: Tile | None = None, fresh: str | None = None) -> DataFrame:
    """Pairs of different sources within the radius, with distance_m. core: left rows are of this tile only, right rows of any; fresh: a column of which one end at least has true."""
    columns = ["source", "source_id", "category", "provenance", "lon", "lat", "name_norm", "name_tokens", *([fresh] if fresh else [])]
    placed = obs.where(F.col("source").isin(*sources)).withColumns({"gx": geo.cell(F.col("lon"), cfg.cell), "gy": geo.cell(F.col("lat"), cfg.cell), "code": F.expr("CASE source " + " ".join(f"WHEN '{s}' THEN {c}" for s, c in CODE.items()) + " END")})
    side = lambda p, extra: placed.select(*[F.col(c).alias(f"{p}_{c}") for c in [*columns, "code"]], *extra)
    left = side("l", [F.col("gx"), F.col("gy")])
    left = geo.neighbours(left if core is None else left.where(core.contains(F.col("l_lon"), F.col("l_lat"))), "gx", "gy").drop("gx", "gy")
    right = side("r", [F.col("gx"), F.col("gy")])
    c = F.col
    box = (F.abs(c("r_lat") - c("l_lat")) <= cfg.lat_span) & (F.abs(c("r_lon") - c("l_lon")) <= cfg.cell)
    if fresh:
        box = box & (c(f"l_{fresh}") | c(f"r_{fresh}"))
    met = left.join(right, (c("nx") == c("gx")) & (c("ny") == c("gy")) & (c("l_code") < c("r_code")) & box)
    near = met.withColumn("distance_m", geo.haversine(c("l_lon"), c("l_lat"), c("r_lon"), c("r_lat")))
    return near.where(c("distance_m") <= cfg.max_distance_m).drop("nx", "ny", "gx", "gy")


def category_score(left: Column, right: Column) -> Column:
    return F.when(text.blank(left) | text.blank(right), F.lit(0.0)).otherwise(jw(F.lower(F.coalesce(left, F.lit(""))), F.lower(F.coalesce(right, F.lit("")))))


def score(name: Column, distance: Column, category: Column, max_distance_m: float) -> Column:
    n, d, k = WEIGHTS
    near = F.lit(1.0) - F.least(distance, F.lit(max_distance_m)) / F.lit(max_distance_m)
    return (F.lit(n) * name + F.lit(d) * near + F.lit(k) * category).cast("float")


def _sides(sources: tuple[str, ...], core: Tile | None) -> tuple[Column, Column]:
    codes = [CODE[s] for s in sources]
    left = F.col("code") < max(codes)
    return left if core is None else left & core.contains(F.col("lon"), F.col("lat")), F.col("code") > min(codes)


def _coded(obs: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    return obs.where(F.col("source").isin(*sources)).withColumn("code", F.expr("CASE source " + " ".join(f"WHEN '{s}' THEN {n}" for s, n in CODE.items()) + " END"))


def scored(obs: DataFrame, cfg: MatchConfig = MatchConfig(), sources: tuple[str, ...] = SOURCES, tokens: bool = True) -> DataFrame:
    """l_source_id, r_source_id and name_score of all pairs within the radius; with ``tokens`` the larger of the names' and the sorted tokens' scores."""
    name = F.concat("name_norm", F.coalesce(F.concat(F.lit(pairs.MARK), "name_tokens"), F.lit(""))) if tokens else F.col("name_norm")
    rows = _coded(obs, sources).select("source", "source_id", "code", "lon", "lat", name.alias("name"), F.lit(False).alias("generic"))
    return pairs.met(rows, cfg.cell, cfg.lat_span, cfg.max_distance_m, _sides(sources, None), "best" if tokens else "norm", 0.0, None, ["source_id"])


def edges(obs: DataFrame, cfg: MatchConfig = MatchConfig(), sources: tuple[str, ...] = SOURCES, core: Tile | None = None, fresh: str | None = None, key: str | None = None) -> DataFrame:
    """Accepted pairs. Python forms and scores them and lets through what may be accepted; distances are Spark's, and so is the verdict on pairs too close to a limit. key: a column that gives left_id and right_id."""
    c, metres = F.col, cfg.max_distance_m
    steps = bands(metres)
    chords, least = np.array([pairs._chord(d) for d, _ in steps]), np.array([s for _, s in steps])
    strict = pairs._chord(min(GENERIC_MAX_M, metres))

    def passed(chord: np.ndarray, score: np.ndarray, generic: np.ndarray, widened: float, beyond: float) -> np.ndarray:
        ladder = np.append(least, beyond)[np.searchsorted(chords * widened, chord)]
        return np.where(generic, (chord <= strict * widened) & (score >= GENERIC_MIN_SCORE), score >= ladder)

    def keeps(chord: np.ndarray, score: np.ndarray, generic: np.ndarray) -> np.ndarray:
        """Limits a little wider let in; what a little narrower ones let in too is certain."""
        return passed(chord, score, generic, 1 + 1e-7, least[-1]).astype(np.int8) + passed(chord, score, generic, 1 - 1e-7, math.inf)

    category = F.when(~text.blank(c("category")), F.lower("category"))
    columns = ["code", "source_id", "lon", "lat", "r_declares", "category", *(["key"] if key else [])]
    rows = _coded(obs, sources).where(c("name_norm") != "").select(
        "source", "source_id", "code", "lon", "lat", F.concat("name_norm", F.coalesce(F.concat(F.lit(pairs.MARK), "name_tokens"), F.lit(""))).alias("name"), is_generic(c("name_norm")).alias("generic"),
        category.alias("category"), F.when(c("source") == "overture", licence.declares_fsq(c("provenance"))).alias("declares"), *([c(fresh).alias("fresh")] if fresh else []), *([c(key).alias("key")] if key else []))
    met = pairs.met(rows, cfg.cell, cfg.lat_span, metres, _sides(sources, core), "best", min(least), keeps, columns, bool(fresh))
    placed = met.withColumn("distance_m", geo.haversine(c("l_lon"), c("l_lat"), c("r_lon"), c("r_lat")))
    kept = placed.where(c("sure") | ((c("distance_m") <= metres) & admitted(c("distance_m"), c("name_score"), c("generic"), metres)))
    independent = F.when((c("l_code") == CODE["fsq"]) & (c("r_code") == CODE["overture"]), ~c("r_declares")).otherwise(True)
    source = lambda code: F.expr(f"CASE {code} " + " ".join(f"WHEN {n} THEN '{s}'" for s, n in CODE.items()) + " END")
    return kept.select(
        *([c("l_key").alias("left_id"), c("r_key").alias("right_id")] if key else []), source("l_code").alias("left_source"), c("l_source_id").alias("left_source_id"), source("r_code").alias("right_source"), c("r_source_id").alias("right_source_id"), "distance_m",
        c("name_score").cast("float").alias("name_score"), c("category_score").cast("float").alias("category_score"),
        score(c("name_score"), c("distance_m"), c("category_score"), metres).alias("score"), independent.alias("independent"),
    )


def pair_names(sources: tuple[str, ...]) -> list[str]:
    return [f"{a}__{b}" for a, b in source_pairs(sources)]
