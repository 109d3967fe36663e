"""Observations, match edges, canonical points and the summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelink.functions import geo, licence, text
from placelink.plans.scope import CODE, PRIORITY, SOURCES, Scope
from placelink.plans.storage import numbered

TIERS = {1: "single", 2: "double", 3: "triple"}


def unified(parts: list[DataFrame]) -> DataFrame:
    """One relation of all sources; columns that a source lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _by_source(values: dict[str, int]) -> Column:
    out = F.when(F.lit(False), F.lit(0))
    for s, v in values.items():
        out = out.when(F.col("source") == s, v)
    return out


def valid(obs: DataFrame, scope: Scope | None = None) -> DataFrame:
    c = F.col
    kept = ~text.blank(c("name")) & c("source_id").isNotNull() & c("lon").isNotNull() & c("lat").isNotNull()
    return obs.where(kept if scope is None else kept & scope.contains(c("lon"), c("lat")))


def observations(obs: DataFrame, scope: Scope | None = None, number: bool = True) -> DataFrame:
    """Valid rows with licence, source_code, source_priority and, by (priority, source_id), a dense row_id."""
    c = F.col
    out = valid(obs, scope).withColumns({
        "upstream_license": licence.source_licence(c("source"), c("provenance"), c("upstream_license")),
        "source_code": _by_source(CODE), "source_priority": _by_source(PRIORITY),
    })
    out = out.select("source", "source_id", "name", "category", "lon", "lat", "provenance", "upstream_license", "source_code", "source_priority")
    return numbered(out, [c("source_priority"), c("source_id"), c("lon"), c("lat"), c("name")], "row_id") if number else out


def match_edges(edge_ids: DataFrame, cluster: DataFrame) -> DataFrame:
    """All accepted edges; same_cluster_final tells which the clustering kept."""
    side = lambda p: cluster.select(F.col("row_id").alias(f"{p}_row"), F.col("cluster_root").alias(f"{p}_root"))
    met = edge_ids.join(side("l"), F.col("left_id") == F.col("l_row")).join(side("r"), F.col("right_id") == F.col("r_row"))
    return met.select(*edge_ids.columns, (F.col("l_root") == F.col("r_root")).alias("same_cluster_final"))


def first_known(value: str) -> Column:
    """The value of the source with the least priority number that has one: nulls are passed over, '' is a value."""
    return F.expr(f"min_by({value}, source_priority) FILTER (WHERE {value} IS NOT NULL)")


def tier(n: Column) -> Column:
    out = F.when(n == 1, TIERS[1])
    for k in (2, 3):
        out = out.when(n == k, TIERS[k])
    return out.otherwise(n.cast("string"))


def diameters(members: DataFrame) -> DataFrame:
    """Largest distance of two members; a cluster has three at most."""
    c = F.col
    a = members.select(c("cluster_root"), c("row_id").alias("i"), c("lon").alias("x1"), c("lat").alias("y1"))
    b = members.select(c("cluster_root").alias("root2"), c("row_id").alias("j"), c("lon").alias("x2"), c("lat").alias("y2"))
    met = a.join(b, (c("cluster_root") == c("root2")) & (c("i") < c("j")))
    return met.groupBy("cluster_root").agg(F.max(geo.haversine(c("x1"), c("y1"), c("x2"), c("y2"))).alias("cluster_max_pair_distance_m"))


def canonical(obs: DataFrame, cluster: DataFrame, final_edges: DataFrame, geometry: bool = True) -> DataFrame:
    c = F.col
    members = obs.join(cluster, "row_id")
    of = lambda s, v, name: F.max(F.when(c("source") == s, c(v))).alias(name)
    pivot = [of(s, "source_id", f"{s}_id") for s in SOURCES] + [of("fsq", v, f"fsq_{n}") for v, n in (("name", "name"), ("category", "category"), ("upstream_license", "license"))]
    pivot += [of("overture", v, f"overture_{n}") for v, n in (("name", "name"), ("category", "category"), ("provenance", "provenance"), ("upstream_license", "license"))]
    pivot += [of("osm", v, f"osm_{n}") for v, n in (("name", "name"), ("category", "category"), ("upstream_license", "license"))]
    grouped = members.groupBy("cluster_root").agg(F.median("lon").alias("lon"), F.median("lat").alias("lat"), F.countDistinct("source_code").alias("source_count"), first_known("name").alias("canonical_name"), first_known("category").alias("canonical_category"), *pivot)
    inner = final_edges.where("same_cluster_final").join(cluster, c("left_id") == c("row_id")).groupBy("cluster_root").agg(F.min("score").alias("match_score_min"), F.count("*").alias("links"))
    n = c("source_count")
    declares = licence.declares_fsq(c("overture_provenance"))
    out = grouped.join(inner, "cluster_root", "left").join(diameters(members), "cluster_root", "left")
    return out.select(
        F.coalesce(*[F.concat(F.lit(f"{s}:"), c(f"{s}_id")) for s in SOURCES]).alias("canonical_id"), "canonical_name", "canonical_category", "lon", "lat",
        *([geo.wkb_point(c("lon"), c("lat")).alias("geometry")] if geometry else []), n,
        (n - F.when(c("fsq_id").isNotNull() & c("overture_id").isNotNull() & declares, 1).otherwise(0)).alias("known_independent_source_count"),
        tier(n).alias("evidence_tier"), "match_score_min", "cluster_max_pair_distance_m",
        ((n > 2) & (F.coalesce("links", F.lit(0)) < n * (n - 1) / 2)).alias("completed_transitively"),
        (c("overture_id").isNotNull() & declares).alias("overture_has_foursquare_provenance"),
        "fsq_id", "fsq_name", "fsq_category", "fsq_license", "overture_id", "overture_name", "overture_category", "overture_provenance", "overture_license", "osm_id", "osm_name", "osm_category", "osm_license",
    )


def summary(points: DataFrame, obs: DataFrame, final_edges: DataFrame) -> DataFrame:
    """One row of counts, by one aggregate over each relation."""
    a = obs.agg(F.count("*").alias("observations"))
    e = final_edges.agg(F.count("*").alias("candidate_links_accepted_by_thresholds"), F.count_if("same_cluster_final").alias("accepted_links_within_final_cluster"))
    p = points.agg(F.count("*").alias("canonical_pois"), F.count_if("completed_transitively").alias("canonical_pois_completed_transitively"), F.count_if(F.col("source_count") > 1).alias("canonical_pois_of_several_sources"))
    return a.join(F.broadcast(e)).join(F.broadcast(p))  # one row each


def tier_counts(points: DataFrame) -> DataFrame:
    return points.groupBy("evidence_tier").agg(F.count("*").alias("n"))
