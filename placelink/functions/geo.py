"""Distances, grid cells, WKB points and land tests."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_008.8


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    s = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(s))


def cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size)).cast("long")


def neighbours(df: DataFrame, gx: str, gy: str) -> DataFrame:
    """Nine rows a row: ``nx``, ``ny`` name the own cell and those around it."""
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    return df.withColumn("step", F.explode(steps)).withColumns({"nx": F.col(gx) + F.col("step.i"), "ny": F.col(gy) + F.col("step.j")}).drop("step")


#: A little-endian WKB point: byte order, kind, longitude, latitude.
WKB = np.dtype([("order", "u1"), ("kind", "<u4"), ("lon", "<f8"), ("lat", "<f8")])


def wkb_point(lon: Column, lat: Column) -> Column:
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        out = np.zeros(len(x), WKB)
        out["order"], out["kind"], out["lon"], out["lat"] = 1, 1, x.to_numpy(float, na_value=np.nan), y.to_numpy(float, na_value=np.nan)
        return pd.Series(out.view("V21").tolist(), dtype=object).where((x.notna() & y.notna()).to_numpy(), None)

    return F.pandas_udf(run, "binary")(lon, lat)


def point_of_wkb(value: Column) -> Column:
    """struct(lon, lat) as a point's bytes hold them; nulls for bytes that are no point."""

    def run(x: pd.Series) -> pd.DataFrame:
        whole = np.array([w is not None and len(w) == WKB.itemsize for w in x], bool)
        got = np.zeros(len(x), WKB)
        got[whole] = np.frombuffer(b"".join(x[whole]), WKB)
        point = whole & (got["order"] == 1) & (got["kind"] == 1)
        return pd.DataFrame({c: pd.Series(got[c]).where(point, None).astype(float) for c in ("lon", "lat")})

    return F.pandas_udf(run, "lon double, lat double")(value)


LAND_CELL = 0.05


def _crosses(a: str, b: str, u: str, v: str, at: Column) -> tuple[Column, Column]:
    """(whether an edge from (a, b) to (u, v) crosses the line second coordinate = at, half-open, and where)."""
    d = F.col(v) - F.col(b)
    return (F.col(b) > at) != (F.col(v) > at), F.col(a) + (at - F.col(b)) / F.when(d != 0, d) * (F.col(u) - F.col(a))


def inside(points: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, inside) of points (*keys, lon, lat) that meet an edge east of them an odd number of times; the rest is left out.

    By bands of latitude: each point meets all edges of its band, so this is for few points, such as the middles of cells.
    """
    span = F.sequence(F.floor(F.least("y1", "y2") / LAND_CELL), F.floor(F.greatest("y1", "y2") / LAND_CELL))
    cut = edges.select("x1", "y1", "x2", "y2", F.explode(span).alias("eband"))
    met = points.withColumn("band", F.floor(F.col("lat") / LAND_CELL)).join(cut, F.col("band") == F.col("eband"))
    crosses, x = _crosses("x1", "y1", "x2", "y2", F.col("lat"))
    return met.where(crosses & (F.col("lon") < x)).groupBy(*keys).agg((F.count("*") % 2 == 1).alias("inside")).where("inside")


def on_land(points: DataFrame, edges: DataFrame, tolerance: float, key: str = "point_id") -> DataFrame:
    """Points inside the polygons, or within ``tolerance`` degrees (planar) of an edge.

    edges: x1, y1, x2, y2 of all rings. Edges and points are dealt to square cells. Of each cell that holds points it is found
    once whether its middle is inside; a point then meets only the edges of its own cell: each that lies on the way to the
    middle, along its latitude and then along the middle's longitude, changes sides once. Cells without edges join nothing.
    """
    c, size = F.col, LAND_CELL
    box = [F.sequence(F.floor((F.least(f"{v}1", f"{v}2") - tolerance) / size), F.floor((F.greatest(f"{v}1", f"{v}2") + tolerance) / size)) for v in "xy"]
    cut = edges.select("x1", "y1", "x2", "y2", F.explode(box[0]).alias("e_x"), box[1].alias("ys")).select("x1", "y1", "x2", "y2", "e_x", F.explode("ys").alias("e_y"))
    places = points.select(c(key).alias("p_key"), c("lon").alias("p_lon"), c("lat").alias("p_lat")).withColumns({"p_x": F.floor(c("p_lon") / size), "p_y": F.floor(c("p_lat") / size)})
    middle = lambda v: (c(v) + 0.5) * size
    cells = places.select("p_x", "p_y").distinct().withColumns({"lon": middle("p_x"), "lat": middle("p_y")})
    full = inside(cells, edges, ["p_x", "p_y"]).select(c("p_x").alias("i_x"), c("p_y").alias("i_y"), "inside")
    met = places.join(cut, (c("p_x") == c("e_x")) & (c("p_y") == c("e_y")))
    x, y, mx, my = c("p_lon"), c("p_lat"), middle("p_x"), middle("p_y")
    along, at = _crosses("x1", "y1", "x2", "y2", y)
    up, over = _crosses("y1", "x1", "y2", "x2", mx)
    turns = F.when(along & ((at > x) != (at > mx)), 1).otherwise(0) + F.when(up & ((over > y) != (over > my)), 1).otherwise(0)
    dx, dy = c("x2") - c("x1"), c("y2") - c("y1")
    length = dx * dx + dy * dy
    t = F.when(length == 0, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((x - c("x1")) * dx + (y - c("y1")) * dy) / F.when(length != 0, length))))
    gap = F.pow(x - (c("x1") + t * dx), F.lit(2)) + F.pow(y - (c("y1") + t * dy), F.lit(2))
    hit = met.groupBy(c("p_key").alias("h_key")).agg((F.sum(turns) % 2 == 1).alias("turned"), (F.min(gap) <= tolerance * tolerance).alias("near"))
    known = places.join(full, (c("p_x") == c("i_x")) & (c("p_y") == c("i_y")), "left").join(hit, c("p_key") == c("h_key"), "left")
    kept = known.where((F.coalesce("inside", F.lit(False)) != F.coalesce("turned", F.lit(False))) | F.coalesce("near", F.lit(False))).select("p_key")
    return points.join(kept, c(key) == c("p_key"), "left_semi")


def area(ring: list[list[float]]) -> float:
    """Of a closed ring, in square degrees."""
    p = np.array([q[:2] for q in ring], float)
    return float(abs(np.sum(p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1])) / 2)


def surface_point(rings: list[list[tuple[float, float]]]) -> tuple[float, float]:
    """A point within a polygon: the middle of the widest inner stretch of a scan line. A line's middle vertex otherwise."""
    ring = np.array(rings[0], float)
    if len(ring) < 4:
        return tuple(map(float, ring[len(ring) // 2]))
    ys = np.unique(ring[:, 1])
    if len(ys) < 2:
        return tuple(map(float, ring.mean(axis=0)))
    k = int(np.argmin(np.abs((ys[1:] + ys[:-1]) / 2 - ring[:, 1].mean())))
    y = (ys[k] + ys[k + 1]) / 2
    xs = []
    for part in rings:
        p = np.array(part, float)
        a, b = p[:-1], p[1:]
        over = (a[:, 1] > y) != (b[:, 1] > y)
        xs += list(a[over, 0] + (y - a[over, 1]) / (b[over, 1] - a[over, 1]) * (b[over, 0] - a[over, 0]))
    xs = np.sort(xs)
    widest = int(np.argmax(xs[1::2] - xs[::2]))
    return float((xs[2 * widest] + xs[2 * widest + 1]) / 2), float(y)
