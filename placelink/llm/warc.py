"""Operator 10, WARC archives as a PySpark Python data source.

``spark.read.format("warc").load(path)`` plans one partition per archive, takes over comparisons of record type, status,
target URI and record id, reads each record's headers first and decodes a payload only for records that pass and only if
the ``payload`` option asks for it. Records lie in gzip members of their own; the writer notes a member's length in its
header, so an unwanted record is skipped without inflating it. Archives of others (no such note, or no gzip) are read too.

``df.write.format("warc").mode("append").save(path)`` writes an archive per task under a temporary name; the commit on
the driver renames those of successful tasks, so lost executors and repeated tasks leave no half or double archive.

Storage is reached by pyarrow's file systems (local, S3, GCS, HDFS where its library is there), on executors too.

Defined cases: a null payload is an empty one; a null URI is written as ``urn:none`` and read back as null; records with
repeated ids are kept all; an empty table gives no record; further columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from .storage import scratch, table, written

HEADERS = "record_type string, record_id string, refers_to string, target_uri string, date string, payload_digest string, payload_bytes long, status int"
NOWHERE = "urn:none"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 16


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"^[a-z][a-z0-9+.-]*:", path):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pafs.LocalFileSystem(), path


def member(raw: bytes) -> bytes:
    """A gzip member that names its own length: subfield ``sl`` holds the compressed and the full length."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    size = 12 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, size, len(raw) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def record(kind: str, record_id: str, uri: str | None, date: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One WARC/1.1 record around an HTTP response; a revisit has its headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', uri) if uri else NOWHERE}", f"WARC-Date: {date}",
             f"WARC-Payload-Digest: sha1:{digest32(payload)}", "Content-Type: application/http; msgtype=response"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def _named(raw: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        key, found, value = line.partition(":")
        if found:
            out[key.strip().lower()] = value.strip()
    return out


class Source:
    """Bytes of one archive from its current place on, whether of a member or of the plain file."""

    def __init__(self, file, at_start: bytes):
        self.file, self.gzip = file, at_start[:2] == b"\x1f\x8b"

    def records(self) -> Iterator[Reader]:
        while True:
            begin = self.file.tell()
            head = self.file.read(24)
            if not head:
                return
            if self.gzip:
                reader: Reader = Reader(self.file, begin, head)
            else:
                if not head.strip(b"\r\n"):
                    return
                self.file.seek(begin)
                reader = Reader(self.file, begin, b"")
            yield reader
            reader.skip()


class Reader:
    """One record: ``head`` inflates no more than the headers, ``rest`` the block, ``skip`` goes to the next record."""

    def __init__(self, file, begin: int, head: bytes):
        self.file, self.begin, self.buffer = file, begin, b""
        self.inflate = None
        self.size = 0
        self.ended = False
        self.need: int | None = None
        self.taken = 0
        if head:
            if head[:3] != b"\x1f\x8b\x08":
                raise ValueError("no gzip member where one is due: the archive is damaged")
            self.inflate = zlib.decompressobj(31)
            if head[3] & 4 and head[12:14] == b"sl":
                (self.size,) = struct.unpack_from("<I", head, 16)
            self.buffer = self.inflate.decompress(head)

    def _more(self) -> bool:
        """Takes in the next chunk; False at the record's end."""
        if self.ended:
            return False
        raw = self.file.read(CHUNK)
        if not raw:
            self.ended = True
            return False
        if self.inflate is None:
            self.buffer += raw
            return True
        self.buffer += self.inflate.decompress(raw)
        if self.inflate.eof:
            self.ended = True
            self.file.seek(self.file.tell() - len(self.inflate.unused_data))
        return True

    def _until(self, mark: bytes) -> bytes:
        while (at := self.buffer.find(mark)) < 0:
            if not self._more():
                raise ValueError("a record ends within its headers: the archive is damaged")
        out, self.buffer = self.buffer[:at], self.buffer[at + len(mark) :]
        self.taken += at + len(mark)
        return out

    def head(self) -> dict[str, str]:
        raw = self._until(b"\r\n\r\n").lstrip(b"\r\n")
        if not raw.startswith(b"WARC/"):
            raise ValueError("no WARC record where one is due: the archive is damaged")
        out = _named(raw)
        self.need = int(out.get("content-length", 0))
        return out

    def block_head(self) -> tuple[int | None, dict[str, str]]:
        """(status, headers) of the HTTP response in the block."""
        before = self.taken
        raw = self._until(b"\r\n\r\n")
        assert self.need is not None
        self.need -= self.taken - before
        first = raw.split(b"\r\n", 1)[0].split()
        return (int(first[1]) if len(first) > 1 and first[1].isdigit() else None), _named(raw)

    def rest(self) -> bytes:
        pieces, got, need = [], 0, self.need or 0
        while True:  # pieces are joined once, so a payload takes time in proportion to its length
            pieces.append(self.buffer)
            got += len(self.buffer)
            if got >= need:
                break
            self.buffer = b""
            if not self._more():
                raise ValueError("a record is shorter than its Content-Length: the archive is damaged")
        last = pieces.pop()
        kept = len(last) - (got - need)
        self.buffer, self.need = last[kept:], 0
        return b"".join([*pieces, last[:kept]])

    def skip(self) -> None:
        if self.inflate is not None:
            if self.size:
                self.file.seek(self.begin + self.size)
                return
            while not self.ended:
                self.buffer = b""
                self._more()
            return
        # Plain archive: the block and two line ends after it. What is buffered was read ahead.
        self.file.seek(self.file.tell() - len(self.buffer) + (self.need or 0) + 4)


@dataclass
class Archive(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    #: Columns whose comparisons are decided on the headers.
    PUSHED = ("record_type", "record_id", "refers_to", "target_uri", "status", "payload_digest")

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in self.PUSHED and isinstance(f, EqualTo):
                self.tests.append((column, "=", f.value))
            elif column in self.PUSHED and isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif column in self.PUSHED and isinstance(f, IsNotNull):
                self.tests.append((column, "set", None))
            elif column in self.PUSHED and isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", f.value))
            else:
                yield f

    def partitions(self) -> list[Archive]:
        fs, path = file_system(self.path)
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.File:
            return [Archive(path)]
        names = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(path)) if re.search(r"\.warc(\.gz)?$", f.path) and not f.base_name.startswith(("_", ".")))
        return [Archive(n) for n in names]

    def passes(self, values: dict[str, object], columns: tuple[str, ...]) -> bool:
        for column, how, value in self.tests:
            if column not in columns:
                continue
            x = values[column]
            if x is None or how == "=" and x != value or how == "in" and x not in value or how == "starts" and not str(x).startswith(value):
                return False
        return True

    def read(self, partition: Archive | None) -> Iterator[tuple]:
        if partition is None:  # a folder without archives
            return
        fs, _ = file_system(self.path)
        with fs.open_input_file(partition.path) as file:
            start = file.read(2)
            file.seek(0)
            for reader in Source(file, start).records():
                head = reader.head()
                plain = lambda key: head[key].strip("<>") if key in head else None  # noqa: E731, B023
                uri = plain("warc-target-uri")
                row: dict[str, object] = {
                    "record_type": head.get("warc-type"), "record_id": plain("warc-record-id"), "refers_to": plain("warc-refers-to"), "target_uri": None if uri == NOWHERE else uri,
                    "date": head.get("warc-date"), "payload_digest": head["warc-payload-digest"].rpartition(":")[2] if "warc-payload-digest" in head else None,
                }
                if not self.passes(row, ("record_type", "record_id", "refers_to", "target_uri", "payload_digest")):
                    continue
                status, http = (None, {})
                if "application/http" in head.get("content-type", ""):
                    status, http = reader.block_head()
                row["status"] = status
                if not self.passes(row, ("status",)):
                    continue
                size = reader.need if row["record_type"] != "revisit" else int(http.get("content-length", 0))
                payload = None
                if (self.payload or self.verify) and row["record_type"] != "revisit":
                    payload = reader.rest()
                    if self.verify and row["payload_digest"] not in (None, digest32(payload)):
                        raise ValueError(f"the payload of {row['record_id']} does not match its digest")
                out = (row["record_type"], row["record_id"], row["refers_to"], row["target_uri"], row["date"], row["payload_digest"], size, status)
                yield (*out, payload) if self.payload else out


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceWriter):
    """Rows: record_type, record_id, refers_to, target_uri, date, payload (binary). Other columns are left out.

    A task's archives end at ``archive_bytes`` (an option, 1 GiB), so that readers get partitions of bounded size. Each job has its own
    temporary folder, so appends that run side by side do not disturb one another.
    """

    def __init__(self, options: dict[str, str], overwrite: bool):
        if overwrite:
            raise ValueError("an archive folder is only appended to: use mode('append')")
        self.path = options["path"]
        self.most = int(options.get("archive_bytes", str(1 << 30)))
        self.held = f"_temporary-{uuid.uuid4().hex}"

    def write(self, rows: Iterator[Row]) -> Written:
        fs, path = file_system(self.path)
        names: list[str] = []
        out, size = None, 0
        for row in rows:
            payload = bytes(row["payload"]) if row["payload"] is not None else b""
            raw = member(record(row["record_type"], row["record_id"], row["target_uri"], row["date"], payload, row["refers_to"]))
            if out is not None and size + len(raw) > self.most:
                out.close()
                out = None
            if out is None:
                fs.create_dir(f"{path}/{self.held}", recursive=True)
                names.append(f"{uuid.uuid4().hex}.warc.gz")
                out, size = fs.open_output_stream(f"{path}/{self.held}/{names[-1]}", compression=None), 0
            out.write(raw)
            size += len(raw)
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        fs, path = file_system(self.path)
        fs.create_dir(path, recursive=True)
        for m in messages:
            for name in m.names if m is not None else ():
                fs.move(f"{path}/{self.held}/{name}", f"{path}/{name}")
        self._clean(fs, path)

    def abort(self, messages: list[Written | None]) -> None:
        self._clean(*file_system(self.path))

    def _clean(self, fs: pafs.FileSystem, path: str) -> None:
        if fs.get_file_info(f"{path}/{self.held}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{path}/{self.held}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return HEADERS + (", payload binary" if self.options.get("payload", "true").lower() == "true" else "")

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def revisits(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", text_col: str = "html", least: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Records for ``WarcWriter``: of rows with equal payloads of ``least`` bytes or more, the one with the smallest id is the response.

    Rows that repeat that id are responses too, as are rows with a null id. Only payloads that occur twice reach the join;
    a payload that many rows share shrinks to one row in the map-side combine, and the join is one that AQE may split.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(uri_col).alias("uri"), body.alias("payload")).withColumn("digest", F.sha1("payload"))
    named = pages.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.sha1(body).alias("d"), F.octet_length(body).alias("n")).where(F.col("n") >= least)
    firsts = written(named.groupBy("d").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("d", "first"), "payloads")
    joined = rows.join(firsts, F.col("digest") == F.col("d"), "left")
    again = F.col("first").isNotNull() & F.col("id").isNotNull() & (F.col("id") > F.col("first"))
    urn = lambda c: F.concat(F.lit("urn:placelink:page:"), F.coalesce(c.cast("string"), F.lit("none")))
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), urn(F.col("id")).alias("record_id"), F.when(again, urn(F.col("first"))).alias("refers_to"),
        F.col("uri").alias("target_uri"), F.lit(date).alias("date"), "payload",
    )


def page_of(column: str) -> Column:
    return F.regexp_extract(column, r"^urn:placelink:page:(-?\d+)$", 1).try_cast("long")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    path = scratch(spark, "warc")
    revisits(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(path)
    # ``verify`` inflates each response and compares its SHA-1 with the header; the payload itself is not returned.
    got = spark.read.format("warc").option("payload", "false").option("verify", "true").load(path)
    return got.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"))


QUERIES = {"op10_warc": op10_warc}
ORACLES = {"op10_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
     f AS (SELECT t, min(page_id) AS first FROM p GROUP BY t),
     h AS (SELECT page_id, strlen(p.t)::BIGINT AS payload_bytes, sha1(p.t) AS x, first FROM p JOIN f ON p.t = f.t),
     b AS (SELECT *, list_aggregate(list_transform(range(0, 160), lambda i: ((strpos('0123456789abcdef', x[i // 4 + 1]) - 1) >> (3 - i % 4)) & 1), 'string_agg', '') AS bits FROM h)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda j: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(0, 5), lambda k: bits[j * 5 + k + 1]::INTEGER << (4 - k)))::INTEGER]), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM b
"""}
