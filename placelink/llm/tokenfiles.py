"""Operator 4, token-id output: files of interleaved range-coded blocks (see ``rans``), and their reader.

``write`` range-partitions the documents by id and a hash of the text (the only shuffle; it carries texts, which compress better than
ids), so that an id which many rows repeat, or null, is dealt to several tasks; it
encodes each partition as it streams by and stores one segment of up to ``SEGMENT`` ids per Parquet row. Parquet is the
container because Spark's committer makes its files appear whole on any shared storage, also when executors are lost.
``read`` decodes segments in parallel; a document's start adds its partition's, segment's and own offset, of which
the driver only ever handles one number per written partition.

``read(only=...)`` gives the documents of some ids and decodes no more of a block than lies between the checkpoints around them.

Defined cases: a null or empty text has just the end id; rows with a null id come first; rows with equal ids stand by
the hashes of their texts; an empty table makes no segment and reads back empty; other columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import default_vocabulary, read_vocabulary
from .rans import decode_range, open_segment, pack_segment, unpack_segment
from .storage import scratch, table
from .textcore import slices
from .tokens import TokenIds

SEGMENT = 1 << 21
END = 2
SCHEMA = "part int, segment int, part_start long, n_tokens long, n_docs long, payload binary"


def write(docs: DataFrame, path: str, vocabulary: str, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of all texts, each with ``end`` after it, in ascending order of the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = TokenIds(shared.value)
        part, segment, before = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        lengths: list[int] = []
        held: list[np.ndarray] = []
        count = 0

        def flush() -> pa.RecordBatch:
            nonlocal segment, before, names, lengths, held, count
            ids = np.concatenate(held)
            kept = pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])
            row = [[part], [segment], [before], [len(ids)], [len(names)], [pack_segment(kept, ids)]]
            segment, before = segment + 1, before + len(ids)
            names, lengths, held, count = [], [], [], 0
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["part", "segment", "part_start", "n_tokens", "n_docs", "payload"])

        for whole in batches:
            for batch in slices(whole, "text"):
                for name, ids in zip(batch.column("doc_id").to_pylist(), encode.each(batch.column("text").to_pylist(), end), strict=True):
                    names.append(name)
                    lengths.append(len(ids))
                    held.append(ids)
                    count += len(ids)
                    if count >= SEGMENT:
                        yield flush()
        if names:
            yield flush()

    ordered.mapInArrow(run, SCHEMA).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str, ids: bool = False, only: Iterable[int] | None = None) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32 [, ids array<int>], decoded from the files; ``only``: of the documents with these ids, a list that the driver holds."""
    wanted = None if only is None else np.unique(np.array(list(only), np.int64))
    files = spark.read.schema(SCHEMA).parquet(path)
    totals = sorted((r[0], r[1]) for r in files.groupBy("part").agg(F.sum("n_tokens")).collect())  # one row per written partition
    at, base = 0, {}
    for part, n in totals:
        base[part], at = at, at + n
    shared = spark.sparkContext.broadcast(base)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                payload = batch.column("payload")[i].as_py()
                before = batch.column("part_start")[i].as_py() + shared.value[batch.column("part")[i].as_py()]
                if wanted is None:
                    docs, tokens = unpack_segment(payload)
                    length = docs.column("n_tokens").to_numpy()
                    start = np.concatenate([[0], np.cumsum(length)[:-1]]) + before
                else:
                    docs, table, blocks = open_segment(payload)
                    length = docs.column("n_tokens").to_numpy()
                    first = np.concatenate([[0], np.cumsum(length)])[:-1]
                    chosen = np.flatnonzero(pc.is_in(docs.column("doc_id"), pa.array(wanted)).to_numpy(zero_copy_only=False))
                    if not len(chosen):
                        continue
                    got = [decode_range(blocks, table, first[k], first[k] + length[k]) for k in chosen]
                    docs, length, start, tokens = docs.take(pa.array(chosen)), length[chosen], first[chosen] + before, np.concatenate(got)
                cut = np.concatenate([[0], np.cumsum(length)])
                raw = memoryview(tokens.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                out = [docs.column("doc_id"), pa.array(start, pa.int64()), docs.column("n_tokens"), pa.array(crc, pa.int64())]
                if ids:
                    out.append(pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(tokens.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(out, names)

    return files.select("part", "part_start", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-files")
    write(table(spark, sf_dir, "documents"), path, default_vocabulary())
    return read(spark, path)


QUERIES = {"op4_token_files": op4_token_files}
ORACLES: dict[str, str] = {}
