"""Operator 2, BPE encoding and decoding in batched numpy merge rounds.

The symbols of all new words of a batch lie in one flat array. A round looks every neighbouring pair up by binary
search over the sorted pair keys, takes each word's lowest rank, and merges that pair wherever it stands in its word;
words without a known pair leave the array. In a word of over ``LONG_WORD`` bytes ranks are taken one after another instead, and a
round touches only the places of its rank and their neighbours, so that its time stays near proportion to its length. (To merge
all local minima of a word at once would not be exact: a merge beside may make a pair that goes first.) Decoding gathers the bytes of all ids of a batch at once.

Defined cases: a null or empty text has no ids and decodes to the empty text; repeated rows and null ids are rows as any
other; the id column keeps its name and type, further columns are not read. The vocabulary is read on the driver and
broadcast (its size is fixed), so executors need no file.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import table
from .textcore import slices

#: White space as the vocabulary's own pre-tokenizer takes it (Unicode White_Space; \x1c to \x1f are none).
_WS = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"


#: Words of more bytes are encoded apart, by ranks.
LONG_WORD = 256


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies spell a byte as its own letter where that is printable, else as the next letter from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places of the runs (start, length), one run after another."""
    if not len(length) or not length.sum():
        return np.zeros(0, np.int64)
    out = np.repeat(start - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
    return out + np.arange(len(out))


class Bpe:
    """A byte-level BPE vocabulary as flat tables."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        vocab: dict[str, int] = model["vocab"]
        added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in spec.get("added_tokens", [])):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.added = added
        size = 1 + max([*vocab.values(), *added.values()])
        raw = [b""] * size
        for token, i in vocab.items():
            raw[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            raw[i] = token.encode()
        self.token_length = np.array([len(x) for x in raw], np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)[:-1]])
        self.token_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.byte_id = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.byte_id[b] = vocab[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.size, self.keys, self.ranks = size, keys[order], order
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.by_added = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.words = regex.compile(PATTERN)

    def split(self, text: str) -> list[str]:
        """The words that are encoded each by itself; an added token is one."""
        if self.by_added is None or not any(x in text for x in self.added):
            return self.words.findall(text)
        out: list[str] = []
        for part in self.by_added.split(text):
            if part in self.added:
                out.append(part)
            elif part:
                out += self.words.findall(part)
        return out

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        if not any(len(w) > LONG_WORD for w in words):
            return self._together(words)
        ids, count = self._together([w if len(w) <= LONG_WORD else b"" for w in words])
        parts = np.split(ids, np.cumsum(count)[:-1])
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                parts[i] = self._alone(w)
        return np.concatenate(parts).astype(np.int32), np.array([len(x) for x in parts], np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, or the number of merges where it has none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.made))

    def _alone(self, word: bytes) -> np.ndarray:
        """The ids of one long word: its symbols are a linked list, ranks wait in a heap with the places where they were seen."""
        symbol = self.byte_id[np.frombuffer(word, np.uint8)]
        n, nowhere = len(symbol), len(self.made)
        after, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def seen(place: np.ndarray) -> None:
            rank = self._ranks(symbol[place], symbol[after[place]])
            order = np.argsort(rank, kind="stable")
            order = order[: np.searchsorted(rank[order], nowhere)]
            if not len(order):
                return
            cuts = np.flatnonzero(np.diff(rank[order])) + 1
            for some in np.split(order, cuts):
                r = int(rank[some[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].append(place[some])

        if n > 1:
            seen(np.arange(n - 1))
        while heap:
            r = heapq.heappop(heap)
            place = np.unique(np.concatenate(waiting.pop(r)))
            place = place[alive[place] & (after[place] < n)]
            place = place[self._ranks(symbol[place], symbol[after[place]]) == r]
            if not len(place):
                continue
            # In a run like "aaaa" the pairs overlap: from the left, every other one merges.
            begins = np.concatenate([[True], place[1:] != after[place[:-1]]])
            run = np.maximum.accumulate(np.where(begins, np.arange(len(place)), 0))
            place = place[(np.arange(len(place)) - run) % 2 == 0]
            gone = after[place]
            symbol[place], alive[gone] = self.made[r], False
            after[place] = after[gone]
            inner = after[place] < n
            before[after[place][inner]] = place[inner]
            near = np.unique(np.concatenate([place[inner], before[place][before[place] >= 0]]))
            seen(near)
        return symbol[alive].astype(np.int32)

    def _together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        nowhere = len(self.made)
        length = np.array([len(w) for w in words], np.int64)
        symbol = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), length)
        done_words, done_symbols = [], []
        while len(symbol):
            key = symbol[:-1] * self.size + symbol[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.full(len(symbol), nowhere)
            known = (self.keys[at] == key) & (word[1:] == word[:-1])
            rank[:-1][known] = self.ranks[at[known]]
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            count = np.diff(np.append(first, len(word)))
            lowest = np.repeat(np.minimum.reduceat(rank, first), count)
            ended = lowest == nowhere
            done_words.append(word[ended])
            done_symbols.append(symbol[ended])
            merge = np.flatnonzero((rank == lowest) & ~ended)
            if not len(merge):
                break
            # In a run like "aaaa" the pairs overlap: from the left, every other one merges.
            begins = np.concatenate([[True], np.diff(merge) != 1])
            run = np.maximum.accumulate(np.where(begins, np.arange(len(merge)), 0))
            merge = merge[(np.arange(len(merge)) - run) % 2 == 0]
            symbol[merge] = self.made[rank[merge]]
            stays = ~ended
            stays[merge + 1] = False
            symbol, word = symbol[stays], word[stays]
        if not done_words:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word, symbol = np.concatenate(done_words), np.concatenate(done_symbols)
        order = np.argsort(word, kind="stable")
        return symbol[order].astype(np.int32), np.bincount(word, minlength=len(words))

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts whose ids are ids[first[i]:first[i + 1]]."""
        length = self.token_length[ids]
        ends = np.concatenate([[0], np.cumsum(length)])
        return self.token_bytes[spans(self.token_start[ids], length)], ends[first]


class Encoder:
    """Encodes batches of texts; remembers the ids of up to ``remember`` words, then starts anew."""

    def __init__(self, bpe: Bpe, remember: int = 250_000):
        self.bpe, self.remember = bpe, remember
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.used = 0
        for token, i in self.bpe.added.items():
            self._add([token], np.array([i], np.int32), np.array([1]))

    def _add(self, words: list[str], ids: np.ndarray, length: np.ndarray) -> None:
        n, m = len(self.place), len(words)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + m > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[n : n + m] = self.used + np.concatenate([[0], np.cumsum(length)[:-1]])
        self.length[n : n + m] = length
        self.place.update(zip(words, range(n, n + m), strict=True))
        self.used += len(ids)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text and one more)."""
        if len(self.place) > self.remember:
            self._clear()
        split = [self.bpe.split(t) if t else [] for t in texts]
        flat = [w for words in split for w in words]
        place = self.place
        if new := list(dict.fromkeys(w for w in flat if w not in place)):
            self._add(new, *self.bpe.encode_words([w.encode() for w in new]))
        at = np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))
        length = self.length[at]
        ids = self.ids[spans(self.start[at], length)]
        ends = np.concatenate([[0], np.cumsum(length)])
        words = np.concatenate([[0], np.cumsum([len(x) for x in split])]).astype(np.int64)
        return ids, ends[words]


@lru_cache(maxsize=2)
def _encoder(text: str) -> Encoder:
    return Encoder(Bpe(text))


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, ids array<int>[, decoded string]) of each whole text. vocabulary: the path of a tokenizers file on the driver.

    A map over Arrow batches: no shuffle, memory bounded by one slice of texts and the remembered words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for whole in batches:
            for batch in slices(whole, "__text", 1 << 20):
                ids, first = encoder.encode(batch.column("__text").to_pylist())
                out = [batch.column("__id"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))]
                if decoded:
                    out.append(_strings(*encoder.bpe.decode(ids, first)))
                yield pa.RecordBatch.from_arrays(out, ["__id", "ids", "decoded"][: len(out)])

    got = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return got.mapInArrow(run, f"__id {kind}, ids array<int>" + ", decoded string" * decoded).withColumnRenamed("__id", id_col)


def decode(rows: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded string) of rows that hold ids; null ids decode to the empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(shared.value).bpe
        for batch in batches:
            column = batch.column("__ids")
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            length = np.array([len(x) if x is not None else 0 for x in column.to_pylist()])
            first = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("__id"), _strings(*bpe.decode(flat, first))], ["__id", "decoded"])

    got = rows.select(F.col(id_col).alias("__id"), F.col(ids_col).alias("__ids"))
    return got.mapInArrow(run, f"__id {kind}, decoded string").withColumnRenamed("__id", id_col)


def _strings(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """Texts from bytes; bytes that are no UTF-8 (ids cut within a letter) become U+FFFD."""
    raw = data.tobytes()
    try:
        raw.decode()
        clean = not len(raw) or not np.any((data[np.minimum(at[:-1], len(data) - 1)] & 0xC0) == 0x80)
    except UnicodeDecodeError:
        clean = False
    if clean:
        return pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)])
    return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)], pa.string())


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode(table(spark, sf_dir, "documents"), default_vocabulary(), decoded=True)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op2_bpe": op2_bpe}
ORACLES: dict[str, str] = {}
