"""Incremental matching: a stream of observation files; each micro-batch matches its rows against all rows around them.

The observation table is the state, partitioned by batch and tile. A batch's rows replace those of the same (source, source_id);
where such a row lay in another tile, the batch leaves a mark there, so each tile alone tells what counts in it. Only tiles
that the batch touches, and their neighbours, are read for matching, and only pairs with a row of the batch are scored.
Every write is keyed by the batch number, so a repeated batch overwrites its own output.

Rows are numbered through all batches, and edges hold their ends' numbers. So which edges still count is read off bits, one a row,
without a join of edges with rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from placelink.operators import match
from placelink.plans.scope import tile_columns
from placelink.plans.storage import dropped, numbered, settled
from placelink.sources.places import SCHEMA


TILE = 0.25
#: Of these hardly a value comes twice near another of its kind; a dictionary would only be built and given up.
PLAIN = ("left_id", "right_id", "left_source_id", "right_source_id", "distance_m", "score")
WRITE = {"compression": "zstd", **{f"parquet.enable.dictionary#{x}": "false" for x in PLAIN}}


def tiled(rows: DataFrame, tile: float = TILE) -> DataFrame:
    x, y = tile_columns(F.col("lon"), F.col("lat"), tile)
    return rows.withColumns({"tile_x": x, "tile_y": y})


def around(batch: DataFrame, history: DataFrame, tile: float = TILE) -> DataFrame:
    """The rows of ``history`` (with batch, tile_x, tile_y) in the tiles of the batch and next to them. Partitions far from all of them are not read."""
    steps = F.explode(F.array(*map(F.lit, (-1, 0, 1))))
    touched = tiled(batch, tile).select("tile_x", "tile_y").distinct().withColumn("i", steps).withColumn("j", steps)
    near = touched.select((F.col("tile_x") + F.col("i")).alias("nx"), (F.col("tile_y") + F.col("j")).alias("ny")).distinct()
    ends = near.agg(F.min("nx"), F.max("nx"), F.min("ny"), F.max("ny")).first()
    if ends[0] is None:
        return history.limit(0)
    c = F.col
    pruned = history.where(c("tile_x").between(ends[0], ends[1]) & c("tile_y").between(ends[2], ends[3]))
    return pruned.join(near, (c("tile_x") == c("nx")) & (c("tile_y") == c("ny")), "left_semi")


def match_batch(batch: DataFrame, known: DataFrame, cfg: match.MatchConfig = match.MatchConfig(), key: str | None = None) -> DataFrame:
    """Edges with at least one end in ``batch``; known rows of an id that the batch has too are out of date. key: a column of both that gives left_id and right_id."""
    old = known.join(batch.select("source", "source_id"), ["source", "source_id"], "left_anti")
    both = old.withColumn("fresh", F.lit(False)).unionByName(batch.withColumn("fresh", F.lit(True)))
    return match.edges(both, cfg, fresh="fresh", key=key)


def start(spark: SparkSession, incoming: str, table: str, edges: str, checkpoint: str, cfg: match.MatchConfig = match.MatchConfig(), once: bool = True) -> StreamingQuery:
    """Streams Parquet files of ten-column observations. Output: ``table/batch=n`` and ``edges/batch=n``; the latest batch of an id counts."""
    kept = T.StructType([*SCHEMA.fields, T.StructField("row", T.LongType()), *(T.StructField(x, T.IntegerType()) for x in ("batch", "tile_x", "tile_y"))])

    def one(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        try:
            session.read.parquet(table)
            history = session.read.schema(kept).parquet(table).where(F.col("batch") < number)
        except Exception as e:  # the first batch finds no table yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            history = batch.limit(0).select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in kept.fields[len(SCHEMA.fields) :]))
        first = history.agg(F.coalesce(F.max("row") + 1, F.lit(0))).first()[0]
        rows = numbered(batch.dropDuplicates(["source", "source_id"]), [], "row", first)
        batch = tiled(rows)
        match_batch(rows, latest(around(rows, history)), cfg, "row").write.options(**WRITE).mode("overwrite").parquet(f"{edges}/batch={number}")
        c = F.col
        places = history.select(c("source").alias("s"), c("source_id").alias("i"), c("tile_x").alias("x"), c("tile_y").alias("y")).distinct()
        left = batch.join(places, (c("source") == c("s")) & (c("source_id") == c("i")) & ((c("tile_x") != c("x")) | (c("tile_y") != c("y"))))
        marks = left.select("source", "source_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMA.fields[2:]], F.lit(None).cast("long").alias("row"), c("x").alias("tile_x"), c("y").alias("tile_y"))
        batch.select(*SCHEMA.fieldNames(), "row", "tile_x", "tile_y").unionByName(marks).write.mode("overwrite").partitionBy("tile_x", "tile_y").parquet(f"{table}/batch={number}")
        dropped(rows)

    stream = spark.readStream.schema(SCHEMA).parquet(incoming)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one)
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest(rows: DataFrame) -> DataFrame:
    """Each id's row of its last batch; none where that is a mark that the id has left, a row without a name."""
    held = [F.col(x) for x in (*SCHEMA.fieldNames(), *(("row",) if "row" in rows.columns else ()))]
    last = F.max_by(F.struct(*held), F.struct("batch", F.col("name").isNotNull()))
    return rows.groupBy("source", "source_id").agg(last.alias("r")).select("r.*").where(F.col("name").isNotNull())


def current_edges(spark: SparkSession, edges: str, table: str) -> DataFrame:
    """Edges whose ends have not been replaced by a later batch. Of 64 replaced rows the bits make one row, which Spark broadcasts while there are few."""
    c = F.col
    held = spark.read.parquet(table).where("row IS NOT NULL").groupBy("source", "source_id").agg(F.max("row").alias("newest"), F.collect_list("row").alias("rows"))
    old = held.where(F.size("rows") > 1).select("newest", F.explode("rows").alias("row")).where("row < newest")
    bits = settled(old.groupBy(F.expr("shiftright(row, 6)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(row & 63 AS INT)))").alias("bits")))
    out = spark.read.parquet(edges)
    for end in ("left_id", "right_id"):
        met = out.join(bits.select(c("word").alias("w"), c("bits").alias("b")), F.expr(f"shiftright({end}, 6)") == c("w"), "left")
        out = met.where(f"b IS NULL OR (shiftright(b, CAST({end} & 63 AS INT)) & 1) = 0").drop("w", "b")
    return out.drop("left_id", "right_id", "batch")
