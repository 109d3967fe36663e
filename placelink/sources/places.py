"""Provider records as the ten-column observation relation, and its partitioned table.

Files are read by Spark from any storage; the tile predicate is written on ``tile_x, tile_y`` as well, so partitions
outside an area are not read.
"""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelink.functions import geo, licence, text
from placelink.plans.scope import PH_BOX, Scope, Tile, tile_columns

# Fixed values of the sources.
OSM_KEYS = ("amenity", "shop", "office", "craft", "tourism", "leisure", "healthcare", "industrial", "man_made", "club", "emergency", "public_transport")
LAND_TOLERANCE = 0.002
COLUMNS = ("source", "source_id", "name", "category", "lon", "lat", "provenance", "upstream_license", "name_norm", "name_tokens")
SCHEMA = T.StructType([T.StructField(c, T.DoubleType() if c in ("lon", "lat") else T.StringType()) for c in COLUMNS])


def _observations(df: DataFrame, source: str, source_id: Column, name: Column, category: Column, lon: Column, lat: Column, provenance: Column, given: Column) -> DataFrame:
    out = df.select(F.lit(source).alias("source"), source_id.cast("string").alias("source_id"), name.alias("name"), category.alias("category"), lon.cast("double").alias("lon"), lat.cast("double").alias("lat"), provenance.alias("provenance"), given.alias("upstream_license"))
    out = out.withColumn("name_norm", text.normalized(F.col("name"))).withColumn("name_tokens", text.sorted_tokens(F.col("name_norm")))
    return out.where(~text.blank(F.col("name")) & (F.col("name_norm") != ""))


def _has(df: DataFrame, path: str) -> bool:
    kind: T.DataType = df.schema
    for step in path.split("."):
        if not isinstance(kind, T.StructType) or step not in kind.fieldNames():
            return False
        kind = kind[step].dataType
    return True


def provenance_text(sources: Column) -> Column:
    """The contract's text form of a list of source structs; values with blanks or signs are quoted."""
    def value(v: Column) -> Column:
        plain = v.rlike(r"^[A-Za-z0-9_./:+-]+$")
        return F.when(v.isNull(), F.lit("NULL")).when(plain, v).otherwise(F.concat(F.lit("'"), F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'")))

    one = F.transform(sources, lambda s: F.concat(F.lit("{'property': "), value(s["property"]), F.lit(", 'dataset': "), value(s["dataset"]), F.lit(", 'record_id': "), value(s["record_id"]), F.lit("}")))
    return F.concat(F.lit("["), F.array_join(one, ", "), F.lit("]"))


def overture(raw: DataFrame, scope: Scope, land: DataFrame | None = None, tolerance: float = LAND_TOLERANCE) -> DataFrame:
    """raw: id, names.primary, lon, lat, and what there is of taxonomy, categories, sources, operating_status. land: boundary edges."""
    category = [F.col(p) for p in ("taxonomy.primary", "basic_category", "categories.primary") if _has(raw, p)]
    kept = raw.where(F.col("names.primary").isNotNull() & scope.contains(F.col("lon"), F.col("lat")))
    if "operating_status" in raw.columns:
        kept = kept.where(F.col("operating_status").isNull() | (F.col("operating_status") != "permanently_closed"))
    prov = provenance_text(F.col("sources")) if "sources" in raw.columns else F.lit(None).cast("string")
    out = _observations(kept, "overture", F.col("id"), F.col("names.primary"), F.coalesce(*category) if category else F.lit(None).cast("string"), F.col("lon"), F.col("lat"), prov, licence.overture_licence(prov))
    return out if land is None else geo.on_land(out, land, tolerance, "source_id")


def foursquare(raw: DataFrame, scope: Scope, country: str = "PH") -> DataFrame:
    c = F.col
    kept = raw.where((c("country") == country) & c("date_closed").isNull() & c("longitude").isNotNull() & c("latitude").isNotNull() & scope.contains(c("longitude"), c("latitude")))
    labels = F.array_join(c("fsq_category_labels"), " | ") if isinstance(raw.schema["fsq_category_labels"].dataType, T.ArrayType) else c("fsq_category_labels")
    none = F.lit(None).cast("string")
    return _observations(kept, "fsq", c("fsq_place_id"), c("name"), labels, c("longitude"), c("latitude"), none, F.lit(licence.SOURCE_LICENCE["fsq"]))


def osm_category(present: list[str], at: str = "") -> Column:
    """key=value texts in the fixed order of the keys; null if the file has none of them, '' if a row has none."""
    keys = [k for k in OSM_KEYS if k in present]
    if not keys:
        return F.lit(None).cast("string")
    return F.concat_ws(" | ", *[F.concat(F.lit(f"{k}="), F.col(f"{at}{k}")) for k in keys])


def _place(geometry: pd.Series) -> pd.DataFrame:
    """A point for each GeoJSON geometry text."""
    out = []
    for g in geometry:
        g = json.loads(g) if g else {}
        kind, at = g.get("type"), g.get("coordinates") or []
        if kind == "Point":
            out.append((float(at[0]), float(at[1])))
        elif kind == "LineString" and at:
            out.append(geo.surface_point([[tuple(p[:2]) for p in at][: max(3, 0)] if len(at) < 4 else [tuple(at[len(at) // 2][:2])]]))
        elif kind in ("Polygon", "MultiPolygon") and at:
            rings = at if kind == "Polygon" else max(at, key=lambda poly: geo.area(poly[0]))
            out.append(geo.surface_point([[tuple(p[:2]) for p in r] for r in rings]))
        else:
            out.append((math.nan, math.nan))
    return pd.DataFrame(out, columns=["lon", "lat"])


def osm(spark: SparkSession, path: str) -> DataFrame:
    """A GeoJSON sequence, one feature a line, as the export of tagged objects gives it."""
    seq = spark.read.option("lineSep", "\n").text(path).select(F.trim(F.translate("value", "\u001e", "")).alias("value")).where("value <> ''")
    part = lambda name: F.get_json_object("value", name)
    is_point = part("$.geometry.type") == "Point"  # those need no Python
    at = F.when(is_point, F.from_json(part("$.geometry.coordinates"), "array<double>"))
    shape = F.pandas_udf(_place, "lon double, lat double")(F.when(~is_point, part("$.geometry")))
    raw = seq.select(F.from_json(part("$.properties"), "map<string,string>").alias("t"), at.alias("at"), shape.alias("p"))
    rows = raw.select("t", F.coalesce(F.get("at", F.lit(0)), F.col("p.lon")).alias("lon"), F.coalesce(F.get("at", F.lit(1)), F.col("p.lat")).alias("lat"))
    kind, number = F.coalesce(F.col("t")["@type"], F.col("t")["osm_type"]), F.coalesce(F.col("t")["@id"], F.col("t")["osm_id"])
    tagged = rows.where(F.coalesce(*[F.col("t")[k] for k in OSM_KEYS]).isNotNull() & Scope("ph", (PH_BOX,)).contains(F.col("lon"), F.col("lat")))
    none = F.lit(None).cast("string")
    return _observations(tagged, "osm", F.concat(kind, F.lit("/"), number), F.col("t")["name"], osm_category(list(OSM_KEYS), "t."), F.col("lon"), F.col("lat"), none, F.lit(licence.SOURCE_LICENCE["osm"]))


def write_tiles(obs: DataFrame, path: str, size: float) -> None:
    """Partitioned by source and tile, ordered by place within a file; only the partitions in ``obs`` are replaced."""
    x, y = tile_columns(F.col("lon"), F.col("lat"), size)
    keyed = obs.withColumns({"tile_x": x, "tile_y": y})
    laid = keyed.repartition("source", "tile_x", "tile_y").sortWithinPartitions("source", "tile_x", "tile_y", "lon", "lat")
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("source", "tile_x", "tile_y").parquet(path)


def read_tiles(spark: SparkSession, path: str, tiles: list[Tile] | None = None, sources: tuple[str, ...] | None = None) -> DataFrame:
    """Only the partitions of ``tiles`` and ``sources``."""
    schema = T.StructType([*SCHEMA.fields, T.StructField("tile_x", T.IntegerType()), T.StructField("tile_y", T.IntegerType())])
    df = spark.read.schema(schema).parquet(path)
    if sources:
        df = df.where(F.col("source").isin(*sources))
    if tiles is not None:
        xs, ys = sorted({t.ix for t in tiles}), sorted({t.iy for t in tiles})
        wanted = spark.createDataFrame([(t.ix, t.iy) for t in tiles], "wx int, wy int")
        df = df.where(F.col("tile_x").between(xs[0], xs[-1]) & F.col("tile_y").between(ys[0], ys[-1])) if tiles else df.limit(0)
        df = df.join(F.broadcast(wanted), (F.col("tile_x") == F.col("wx")) & (F.col("tile_y") == F.col("wy")), "left_semi")  # an area's tile list
    return df.select(*COLUMNS)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def boundary_edges(rings: DataFrame) -> DataFrame:
    """Edges x1, y1, x2, y2 of rings (ring_id, points array<struct<x, y>>)."""
    pairs = F.arrays_zip(F.slice("points", 1, F.size("points") - 1).alias("a"), F.slice("points", 2, F.size("points") - 1).alias("b"))
    return rings.select("ring_id", F.explode(pairs).alias("e")).select("ring_id", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


def tiles_on_land(spark: SparkSession, tiles: list[Tile], edges: DataFrame) -> DataFrame:
    """(tile_x, tile_y) of tiles that an edge's box touches or whose middle is inside; an area's tiles are a short list."""
    rows = [(t.ix, t.iy, *t.box) for t in tiles]
    grid = spark.createDataFrame(rows, "tile_x int, tile_y int, w double, s double, e double, n double")
    c = F.col
    touched = edges.join(F.broadcast(grid), (F.least("x1", "x2") < c("e")) & (F.greatest("x1", "x2") > c("w")) & (F.least("y1", "y2") < c("n")) & (F.greatest("y1", "y2") > c("s"))).select("tile_x", "tile_y")
    middles = grid.select("tile_x", "tile_y", ((c("w") + c("e")) / 2).alias("lon"), ((c("s") + c("n")) / 2).alias("lat"), F.concat_ws(",", "tile_x", "tile_y").alias("point_id"))
    return touched.union(geo.inside(middles, edges, ["tile_x", "tile_y"]).select("tile_x", "tile_y")).distinct()
