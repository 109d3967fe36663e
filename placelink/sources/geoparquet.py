"""GeoParquet sink: a Python data source that writes WKB points with the ``geo`` footer, and its check."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

GEO = {"version": "1.1.0", "primary_column": "geometry", "columns": {"geometry": {"encoding": "WKB", "geometry_types": ["Point"], "crs": None}}}
GEO["columns"]["geometry"].pop("crs")  # absent means OGC:CRS84, longitude before latitude


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"^[a-z][a-z0-9+.-]*:", path):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pafs.LocalFileSystem(), path


@dataclass
class Part(WriterCommitMessage):
    name: str


class GeoParquetWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, rows_in_group: int):
        self.path, self.rows_in_group = path, rows_in_group
        self.held = f"_temporary-{uuid.uuid4().hex}"  # each job's own, so appends side by side do not disturb one another
        self.arrow = to_arrow_schema(schema).with_metadata({b"geo": json.dumps(GEO).encode()})

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        fs, path = _file_system(self.path)
        fs.create_dir(f"{path}/{self.held}", recursive=True)
        name = f"part-{uuid.uuid4().hex}.parquet"
        with fs.open_output_stream(f"{path}/{self.held}/{name}") as out, pq.ParquetWriter(out, self.arrow, compression="zstd") as w:
            for batch in batches:
                w.write_table(pa.Table.from_batches([batch]).cast(self.arrow), row_group_size=self.rows_in_group)
        return Part(name)

    def commit(self, messages: list[Part | None]) -> None:
        fs, path = _file_system(self.path)
        for m in messages:
            if m is not None:
                fs.move(f"{path}/{self.held}/{m.name}", f"{path}/{m.name}")
        self.abort(messages)

    def abort(self, messages: list[Part | None]) -> None:
        fs, path = _file_system(self.path)
        if fs.get_file_info(f"{path}/{self.held}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{path}/{self.held}")


class GeoParquetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geoparquet_points"

    def schema(self) -> str:
        return "geometry binary"

    def writer(self, schema: StructType, overwrite: bool) -> GeoParquetWriter:
        return GeoParquetWriter(self.options["path"], schema, int(self.options.get("rows_in_group", 100_000)))


def write(spark: SparkSession, points: DataFrame, path: str) -> None:
    spark.dataSource.register(GeoParquetSource)
    points.write.format("geoparquet_points").mode("append").save(path)
    assert_geo(path)


def assert_geo(path: str) -> None:
    """Every file names its geometry column in the footer; empty files too."""
    fs, at = _file_system(path)
    for f in fs.get_file_info(pafs.FileSelector(at)):
        if f.path.endswith(".parquet"):
            with fs.open_input_file(f.path) as file:
                if b"geo" not in (pq.read_schema(file).metadata or {}):
                    raise ValueError(f"{f.path} has no geo footer")
