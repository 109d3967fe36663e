"""Cut lineage, dense row numbers, and JSON manifests."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where that is unset, in local mode, a folder of our own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.gettempdir() + "/placelink-checkpoints"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once, as Parquet in the shared folder: losing an executor loses nothing of it, and later plans know its size."""
    at = f"{shared_dir(df.sparkSession)}/placelink-settled/{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def dropped(*frames: DataFrame) -> None:
    """Deletes settled tables that nothing reads any more."""
    for df in frames:
        context = df.sparkSession.sparkContext
        for f in df.inputFiles()[:1]:
            path = context._jvm.org.apache.hadoop.fs.Path(f).getParent()
            if "/placelink-settled/" in path.toString():
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, keys: list[Column], name: str, start: int = 0, keep: list[str] | None = None) -> DataFrame:
    """Dense numbers in the order of ``keys``, by a range sort, or in any order without keys; the driver sees one count a partition. keep: the columns that are written, all by default."""
    laid = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df
    ordered = settled(laid.select(*(keep or df.columns), F.monotonically_increasing_id().alias("__m")))
    part = F.shiftright("__m", 33).cast("int")
    counts = sorted((r[0], r[1]) for r in ordered.groupBy(part.alias("p")).count().collect())
    at, base = start, {}
    for p, n in counts:
        base[p], at = at, at + n
    offsets = df.sparkSession.createDataFrame(list(base.items()) or [(-1, 0)], "__p int, __base long")
    joined = ordered.join(F.broadcast(offsets), part == F.col("__p"))
    return joined.withColumn(name, F.col("__base") + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))).drop("__m", "__p", "__base")


def write_json(path: Path, value: dict) -> None:
    """Appears whole or not at all."""
    path.parent.mkdir(parents=True, exist_ok=True)
    held = path.with_name(path.name + ".tmp")
    with held.open("w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, sort_keys=True, default=str)
        f.flush()
        os.fsync(f.fileno())
    held.replace(path)


def read_json(path: Path) -> dict | None:
    try:
        got = json.loads(path.read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return None
    return got if isinstance(got, dict) else None


def sealed(names: list[str]) -> dict[str, object]:
    """A count and a digest of a list of partitions."""
    return {"count": len(names), "sha256": hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()}
