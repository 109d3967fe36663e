"""Shared storage, scratch tables and row keys of the llm operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where that is unset (tests, local mode) a folder of our own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.gettempdir() + "/placelink-shared"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/placelink/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there and a lost executor costs no recomputation."""
    at = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def dropped(spark: SparkSession, *frames: DataFrame) -> None:
    """Deletes scratch tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for df in frames:
        for f in df.inputFiles()[:1]:
            path = jvm.org.apache.hadoop.fs.Path(f).getParent()
            if "/placelink/" in path.toString():
                path.getFileSystem(conf).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` is called so (Spark does not tell cases apart)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str) -> Column:
    """crc32 of the id as text, mod 5; 0 is held out. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5, F.lit(1))
