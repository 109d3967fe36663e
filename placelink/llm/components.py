"""Connected components of an edge table, by hooking and pointer doubling. Nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written


def rooted(parents: DataFrame) -> DataFrame:
    """(v, root) for a forest (v, root) in which each v, once only, points to a smaller vertex. Doubles paths until none gets shorter."""
    table = written(parents, "forest")
    while True:
        up = table.select(F.col("v").alias("w"), F.col("root").alias("next"))
        longer = table.join(up, F.col("root") == F.col("w"), "left")
        stepped = written(longer.select("v", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forest")
        table = stepped.select("v", "root")
        if stepped.where("moved").isEmpty():
            return table


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex of the edges (a, b) but the roots; root is the smallest vertex of its component.

    Each round hooks every vertex to its smallest neighbour below it and contracts; edges within a component go.
    A hub's edges shrink in the map-side combine, and the joins are ones that AQE may split by rows.
    """
    left = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    labels: DataFrame | None = None
    while not left.isEmpty():
        hooks = rooted(left.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("root")))
        to = lambda c: hooks.select(F.col("v").alias(f"v_{c}"), F.col("root").alias(f"r_{c}"))
        moved = left.join(to("a"), F.col("a") == F.col("v_a"), "left").join(to("b"), F.col("b") == F.col("v_b"), "left")
        left = written(moved.select(F.coalesce("r_a", "a").alias("x"), F.coalesce("r_b", "b").alias("y")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct(), "edges")
        if labels is None:
            labels = hooks
        else:
            old = labels.join(to("a"), F.col("root") == F.col("v_a"), "left").select("v", F.coalesce("r_a", "root").alias("root"))
            labels = written(old.unionByName(hooks.join(labels.select("v"), "v", "left_anti")), "labels")
    return labels if labels is not None else edges.sparkSession.createDataFrame([], "v long, root long")
