"""Strongest-first clustering under the rule of one observation per source.

The sequential rule - walk edges by rank, merge two clusters unless they share a source - has an exact parallel form: an
edge that ranks first among the active edges of both its clusters is merged at once, since no earlier edge can
change either. Rounds of such merges repeat until no edge is active; clusters hold at most three rows, so rounds are few.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelink.plans.scope import CODE
from placelink.plans.storage import numbered, settled

RANK = ("score", "name_score", "distance_m", "left_source", "left_source_id", "right_source", "right_source_id")
DESCENDING = ("score", "name_score")


class EdgeResolutionError(RuntimeError):
    """Edges whose ends are no observations, or not one each."""


def resolved(edges: DataFrame, obs: DataFrame) -> DataFrame:
    """Edges with left_id and right_id; raises if any end does not stand for exactly one observation."""
    side = lambda p: obs.select(F.col("source").alias(f"{p}_s"), F.col("source_id").alias(f"{p}_i"), F.col("row_id").alias(f"{p}_id"))
    c = F.col
    out = settled(edges.join(side("left"), (c("left_source") == c("left_s")) & (c("left_source_id") == c("left_i"))).join(side("right"), (c("right_source") == c("right_s")) & (c("right_source_id") == c("right_i"))).select("left_id", "right_id", *edges.columns))
    n, m = edges.count(), out.count()
    if n != m:
        raise EdgeResolutionError(f"edge resolution mismatch: {n} edges, {m} resolved")
    return out


def identified(edges: DataFrame, obs: DataFrame) -> DataFrame:
    """Edges that were made with the ids of ``obs``, settled; raises, as ``resolved`` does, if an end's name stands for several observations."""
    out = settled(edges)
    twice = obs.groupBy("source", "source_id").count().where("count > 1").drop("count")
    if not twice.isEmpty():
        ends = out.select(F.col("left_source").alias("source"), F.col("left_source_id").alias("source_id")).union(out.select("right_source", "right_source_id"))
        if not ends.join(twice, ["source", "source_id"], "left_semi").isEmpty():
            raise EdgeResolutionError("edge resolution mismatch: ends that stand for several observations")
    return out


def rank_keys(by_id: bool = False) -> list:
    """by_id: ids stand for the names, where they are numbered by them within a source."""
    short = {"left_source_id": "left_id", "right_source_id": "right_id"} if by_id else {}
    return [F.desc(k) if k in DESCENDING else F.asc(short.get(k, k)) for k in RANK]


def ranked(edge_ids: DataFrame, by_id: bool = False) -> DataFrame:
    """left_id, right_id, rank (from 0), left_code, right_code."""
    code = lambda s: F.coalesce(*[F.when(F.col(s) == name, F.lit(n)) for name, n in CODE.items()])
    coded = edge_ids.select("left_id", "right_id", *[k for k in RANK if not (by_id and k.endswith("_id"))], code("left_source").alias("left_code"), code("right_source").alias("right_code"))
    columns = ["left_id", "right_id", "left_code", "right_code"]
    return numbered(coded, rank_keys(by_id), "rank", keep=columns).select("left_id", "right_id", "rank", "left_code", "right_code")


def clusters(nodes: DataFrame, ranked_edges: DataFrame) -> DataFrame:
    """(row_id, cluster_root) for nodes (row_id, source_code); ranked_edges: left_id, right_id, rank (unique), and left_code, right_code where they are known.

    Edges carry the names and sources of the clusters that they join, so a round reads no node and only edges that are still
    open. A rank that is the least of two clusters is that of an edge that ranks first at both ends: an aggregate finds these
    without a join, and the next round's plan renames in the edges what they merge. A name
    changes at most as often as a cluster can grow, so the merges of all rounds are followed by that many joins.
    """
    c = F.col
    end = lambda p: nodes.select(c("row_id").alias(f"{p}_i"), c("row_id").alias(f"{p}_c"), c("source_code").cast("int").alias(f"{p}_m"))
    joinable = (c("l_c") != c("r_c")) & (c("l_m").bitwiseAND(c("r_m")) == 0)
    if "left_code" in ranked_edges.columns:
        open_ = ranked_edges.select("rank", c("left_id").alias("l_c"), c("left_code").alias("l_m"), c("right_id").alias("r_c"), c("right_code").alias("r_m")).where(joinable)
    else:
        open_ = settled(ranked_edges.select("left_id", "right_id", "rank").join(end("l"), c("left_id") == c("l_i")).join(end("r"), c("right_id") == c("r_i")).select("rank", "l_c", "l_m", "r_c", "r_m").where(joinable))
    rounds: list[DataFrame] = []
    while True:
        ends = open_.select("rank", F.explode(F.array(F.struct(c("l_c").alias("k"), c("l_m").alias("m")), F.struct(c("r_c").alias("k"), c("r_m").alias("m")))).alias("e"))
        first = ends.groupBy("e.k").agg(F.min("rank").alias("best"), F.max("e.m").alias("m"))
        chosen = settled(first.groupBy("best").agg(F.count("*").alias("n"), F.min("k").alias("root"), F.max("k").alias("old"), F.sum("m").alias("mask")).where("n = 2").select("root", "old", c("mask").cast("int").alias("mask")))
        if chosen.isEmpty():
            break
        rounds.append(chosen.select("old", "root"))
        merged = chosen.select("root", F.explode(F.array("root", "old")).alias("old"), "mask")
        renamed = open_
        for p in "lr":
            to = merged.select(c("old").alias(f"{p}_old"), c("root").alias(f"{p}_root"), c("mask").alias(f"{p}_mask"))
            renamed = renamed.join(to, c(f"{p}_c") == c(f"{p}_old"), "left").withColumns({f"{p}_c": F.coalesce(f"{p}_root", f"{p}_c"), f"{p}_m": F.coalesce(f"{p}_mask", f"{p}_m")}).drop(f"{p}_old", f"{p}_root", f"{p}_mask")
        open_ = settled(renamed.where(joinable))
    out = nodes.select("row_id", c("row_id").alias("cluster_root"))
    if rounds:
        moves = settled(reduce(DataFrame.unionByName, rounds))
        for _ in range(len(CODE) - 1):
            out = out.join(moves, c("cluster_root") == c("old"), "left").select("row_id", F.coalesce("root", "cluster_root").alias("cluster_root"))
    return out


def greedy(codes: list[int], pairs: Iterable[tuple[int, int]]) -> list[int]:
    """The sequential rule: each row's smallest fellow, for tests and small inputs."""
    root, mask = list(range(len(codes))), list(codes)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        if x != y and not mask[x] & mask[y]:
            root[y] = x
            mask[x] |= mask[y]
    return [find(x) for x in range(len(codes))]
