"""Static range asymmetric numeral system over token ids, in numpy.

A *segment* holds the ids of consecutive documents: one frequency table shared by its blocks, a block index, the
documents' ids and lengths, and the blocks. A *block* of at most ``BLOCK`` ids is coded by itself in ``LANES``
interleaved 64-bit states that share one stream of 32-bit words. Each block has a CRC-32 of its ids and checkpoints
(row, place in the stream, states) every ``EVERY`` rows, so that several workers may decode parts of one block.
"""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np
import pyarrow as pa

BITS, LANES, BLOCK, EVERY = 18, 512, 1 << 18, 256
MAGIC = b"RAN1"
U = np.uint64
LOW = U(1 << 31)
WORD = U(32)
MASK = U((1 << 32) - 1)


class Table:
    """Frequencies that sum to 2 ** BITS, at least 1 for each id that occurs."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray):
        self.ids, self.freq = ids, freq
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self._slots: np.ndarray | None = None
        self._steps: np.ndarray | None = None
        self._places: np.ndarray | None = None

    @classmethod
    def of(cls, tokens: np.ndarray) -> Table:
        counts = np.bincount(tokens) if len(tokens) else np.zeros(0, np.int64)
        ids = np.flatnonzero(counts)
        if len(ids) > 1 << BITS:
            raise ValueError("more different ids in a segment than the table has slots")
        if not len(ids):
            return cls(ids, np.zeros(0, np.int64))
        c = counts[ids]
        freq = np.maximum(1, (c * (1 << BITS)) // c.sum())
        over = int(freq.sum()) - (1 << BITS)
        if over < 0:
            freq[np.argmax(freq)] -= over
        order = np.argsort(-freq, kind="stable")
        while over > 0:  # takes from the largest in proportion, never below 1
            take = np.minimum(freq[order] - 1, np.maximum(1, freq[order] * over // int(freq.sum())))
            take[np.cumsum(take) - take >= over] = 0
            last = np.flatnonzero(take)[-1]
            take[last] = min(take[last], over - (int(take.sum()) - take[last]))
            freq[order] -= take
            over -= int(take.sum())
        return cls(ids, freq)

    @property
    def places(self) -> np.ndarray:
        """The place in ``ids`` of each id up to the largest."""
        if self._places is None:
            self._places = np.zeros(int(self.ids[-1]) + 1 if len(self.ids) else 0, np.int32)
            self._places[self.ids] = np.arange(len(self.ids), dtype=np.int32)
        return self._places

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.freq)
        return self._slots

    @property
    def steps(self) -> np.ndarray:
        """Of each slot the frequency of its id, above ``BITS`` bits of its place among the id's slots."""
        if self._steps is None:
            place = np.arange(len(self.slots), dtype=np.uint64) - self.start[self.slots]
            self._steps = (self.freq.astype(np.uint64)[self.slots] << U(BITS)) | place
        return self._steps

    def pack(self) -> bytes:
        gaps = np.diff(self.ids, prepend=0).astype("<u4").tobytes()
        return zlib.compress(struct.pack("<I", len(self.ids)) + gaps + self.freq.astype("<u4").tobytes(), 6)

    @classmethod
    def unpack(cls, raw: bytes) -> Table:
        raw = zlib.decompress(raw)
        (n,) = struct.unpack_from("<I", raw)
        return cls(np.cumsum(np.frombuffer(raw, "<u4", n, 4)).astype(np.int64), np.frombuffer(raw, "<u4", n, 4 + 4 * n).astype(np.int64))


def encode_block(tokens: np.ndarray, table: Table) -> bytes:
    n = len(tokens)
    symbol = table.places[tokens]
    freq, start = table.freq.astype(np.uint64)[symbol], table.start[symbol]
    lanes = min(n, LANES)
    rows = -(-n // LANES)
    x = np.full(lanes, LOW, np.uint64)
    limit = freq << U(63 - BITS)
    words: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    emitted = 0
    for r in range(rows - 1, -1, -1):
        a, b = r * LANES, min(n, (r + 1) * LANES)
        k = b - a
        s, f = x[:k], freq[a:b]
        full = s >= limit[a:b]
        out = s[full]
        words.append((out & MASK).astype(np.uint32))
        emitted += len(out)
        s[full] = out >> WORD
        q, rest = np.divmod(s, f)
        s[:] = (q << U(BITS)) + rest + start[a:b]
        if r % EVERY == 0:
            marks.append((r, emitted, x.copy()))
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    head = struct.pack("<IIII", n, zlib.crc32(tokens.astype("<u4").tobytes()), len(marks), len(stream))
    body = b"".join(struct.pack("<II", r, emitted - at) + x.astype("<u8").tobytes() for r, at, x in reversed(marks))
    return head + body + stream.astype("<u4").tobytes()


def checkpoints(raw: bytes) -> list[int]:
    """The rows at which decoding of a block may begin."""
    n, _, marks, _ = struct.unpack_from("<IIII", raw)
    return [struct.unpack_from("<I", raw, 16 + i * (8 + 8 * min(n, LANES)))[0] for i in range(marks)]


def decode_block(raw: bytes, table: Table, mark: int = 0, until: int | None = None) -> np.ndarray:
    """uint32 ids from checkpoint ``mark`` up to checkpoint ``until`` (default: the block's end). A whole block's checksum is compared."""
    n, crc, marks, m = struct.unpack_from("<IIII", raw)
    if not n:
        return np.zeros(0, np.uint32)
    lanes = min(n, LANES)
    size = 8 + 8 * lanes
    row, at = struct.unpack_from("<II", raw, 16 + mark * size)
    x = np.frombuffer(raw, "<u8", lanes, 16 + mark * size + 8).astype(np.uint64)
    stream = np.frombuffer(raw, "<u4", m, 16 + marks * size).astype(np.uint64)
    rows = -(-n // LANES)
    end = rows if until is None or until >= marks else struct.unpack_from("<I", raw, 16 + until * size)[0]
    out = np.empty(min(n, end * LANES) - row * LANES, np.int64)
    steps, low, bits = table.steps, U((1 << BITS) - 1), U(BITS)
    base = row * LANES
    for r in range(row, end):
        a, b = r * LANES, min(n, (r + 1) * LANES)
        s, slot = x[: b - a], out[a - base : b - base]
        np.bitwise_and(s, low, out=slot.view(np.uint64))
        step = steps.take(slot)
        s >>= bits
        s *= step >> bits
        step &= low
        s += step
        need = np.flatnonzero(s < LOW)
        s[need] = (s[need] << WORD) | stream[at : at + len(need)]
        at += len(need)
    ids = table.ids[table.slots[out]].astype(np.uint32)
    # Each state must come back to where encoding began; that covers bits that no id depends on.
    if mark == 0 and end == rows and (zlib.crc32(ids.astype("<u4").tobytes()) != crc or not np.all(x == LOW)):
        raise ValueError("a block's checksum does not match: the file is damaged")
    return ids


def decode_range(blocks: list[bytes], table: Table, first: int, last: int) -> np.ndarray:
    """The ids from ``first`` up to ``last`` of a segment: of each block that they touch, from the checkpoint before to the one after them."""
    step, out = EVERY * LANES, [np.zeros(0, np.uint32)]
    for k in range(first // BLOCK, -(-last // BLOCK)):
        a, b = max(first - k * BLOCK, 0), min(last - k * BLOCK, BLOCK)
        if a < b:
            mark = a // step
            out.append(decode_block(blocks[k], table, mark, -(-b // step))[a - mark * step : b - mark * step])
    return np.concatenate(out)


def pack_segment(docs: pa.RecordBatch, tokens: np.ndarray) -> bytes:
    """docs: what is kept of each document; its column n_tokens has the lengths."""
    table = Table.of(tokens)
    blocks = [encode_block(tokens[i : i + BLOCK], table) for i in range(0, len(tokens), BLOCK)]
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(docs)
    parts = [table.pack(), sink.getvalue(), *blocks]
    index = struct.pack(f"<{len(parts)}I", *map(len, parts))
    head = MAGIC + struct.pack("<II", len(parts), zlib.crc32(index + parts[0] + parts[1]))
    return head + index + b"".join(parts)


def unpack_segment(raw: bytes) -> tuple[pa.RecordBatch, np.ndarray]:
    """(documents, ids of all of them)."""
    docs, table, blocks = open_segment(raw)
    ids = [decode_block(b, table) for b in blocks]
    return docs, np.concatenate(ids) if ids else np.zeros(0, np.uint32)


def open_segment(raw: bytes) -> tuple[pa.RecordBatch, Table, list[bytes]]:
    """(documents, frequency table, blocks), nothing decoded yet."""
    if raw[:4] != MAGIC:
        raise ValueError("no segment of token ids")
    n, crc = struct.unpack_from("<II", raw, 4)
    sizes = struct.unpack_from(f"<{n}I", raw, 12)
    at, parts = 12 + 4 * n, []
    for size in sizes:
        parts.append(raw[at : at + size])
        at += size
    if zlib.crc32(raw[12 : 12 + 4 * n] + parts[0] + parts[1]) != crc:
        raise ValueError("a segment's checksum does not match: the file is damaged")
    with pa.ipc.open_stream(parts[1]) as r:
        docs = pa.Table.from_batches(list(r), r.schema).combine_chunks()
    batch = docs.to_batches()[0] if docs.num_rows else pa.RecordBatch.from_pylist([], r.schema)
    return batch, Table.unpack(parts[0]), parts[2:]
