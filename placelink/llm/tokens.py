"""Token ids of whole texts for packing and for the token files, by the tokenizers library, special strings included.

Where a byte-level BPE vocabulary cuts a text before merging depends on nothing in front of a cut. So a text may be parted
at any such cut, and the ids of the parts, one after another, are the text's ids. ``PART`` parts at cuts that no rule can
move: before white space, behind a single line end or tab, and between a run of letters and digits and one of signs; what follows an apostrophe is never parted.
The library encodes each different part once and its ids are kept for the next texts of the process (``KEPT`` parts of at most
``LONG`` characters, then it starts anew); longer parts are encoded each time. New parts go to the library as lines of one
string, as a line end behind a letter or sign is a piece and an id of its own; parts with other white space go singly.
Texts with a special string or an information separator, other kinds of vocabulary and rules that reach over cuts get whole calls.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

import numpy as np

#: Parts whose ids are kept in a process, and their longest length in characters: some 200 MB, 500 at most.
KEPT = 1 << 20
LONG = 64

#: New parts that one call of the library takes as lines, and a line end among the characters that stand for bytes.
LINES = 256
LINE_END = "\u010a"

#: White space in Python's patterns, signs in the library's.
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: The first two are the usual words and signs, without an apostrophe behind (nor a line below among the signs), found sooner than
#: by the general ones, with the same result. A single line end or tab before a word is a piece of its own, so it is parted too.
PART = re.compile(r" ?+[^\W_]++(?!')| ?+[^\w\s']++(?!['_])|[\t\n\r](?= ?\S)|\s*[^\W_]+(?:'\S*)?|\s*(?:[^\w\s']|_)+(?:'\S*)?|\s*'\S*|\s+")


@lru_cache(maxsize=2)
def _library(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=2)
def _rules(vocabulary: str) -> tuple[bool, list[str]]:
    """Whether texts may be parted, and what a text that may must not hold."""
    spec = json.loads(vocabulary)
    return _parts_apart(spec), [x["content"] for x in spec.get("added_tokens", [])] + list(SEPARATORS)


def _parts_apart(spec: dict) -> bool:
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if model["type"] != "BPE" or model.get("dropout") or spec.get("normalizer"):
        return False
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return False
    return not any(x["single_word"] or x["lstrip"] or x["rstrip"] or x.get("normalized") for x in spec.get("added_tokens", []))


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Kept(dict):
    """The ids of parts as little-endian 32-bit numbers. Those of a new part may be an empty bytearray until ``fill``."""

    def __init__(self, library, never: list[str]):
        super().__init__()
        self.library = library
        end = library.encode("\n", add_special_tokens=False).ids
        self.end = end[0] if len(end) == 1 and library.id_to_token(end[0]) == LINE_END and not any("\n" in x for x in never) else None
        self.new: list[str] = []
        self.places: list[bytearray] = []

    def __missing__(self, part: str) -> bytes | bytearray:
        if len(part) > LONG:
            return self.alone(part)
        first = part[1:2] if part[0] == " " else part[0]
        if self.end is None or not first or first.isspace():
            ids = self.alone(part)
        else:
            ids = bytearray()
            self.new.append(part)
            self.places.append(ids)
        if len(self) >= KEPT:
            self.clear()
        self[part] = ids
        return ids

    def alone(self, part: str) -> bytes:
        return pack(self.library.encode(part, add_special_tokens=False).ids)

    def fill(self) -> None:
        """Gives the new parts their ids."""
        new, places, self.new, self.places = self.new, self.places, [], []
        try:
            for i in range(0, len(new), LINES):
                lines = new[i : i + LINES]
                (found,) = self.library.encode_batch_fast(["\n".join(lines)], add_special_tokens=False)
                ids = np.array(found.ids, "<u4")
                ends = (4 * np.flatnonzero(ids == self.end)).tolist()
                raw, at = ids.tobytes(), 0
                for part, place, end in zip(lines, places[i : i + LINES], [*ends, len(raw)], strict=True):
                    line = raw[at:end]
                    place += line
                    if part in self:
                        self[part] = line
                    at = end + 4
        except BaseException:
            self.clear()  # some may be empty still
            raise


@lru_cache(maxsize=2)
def _kept(vocabulary: str) -> Kept:
    return Kept(_library(vocabulary), _rules(vocabulary)[1])


class TokenIds:
    def __init__(self, vocabulary: str):
        self.library, self.kept = _library(vocabulary), _kept(vocabulary)
        self.apart, self.never = _rules(vocabulary)

    def whole(self, text: str) -> np.ndarray:
        """A text's ids from one call of the library."""
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def __call__(self, text: str | None, end: int | None = None) -> np.ndarray:
        """uint32 ids of a text (null: none), then ``end`` if given."""
        return self.each([text], end)[0]

    def each(self, texts: list[str | None], end: int | None = None) -> list[np.ndarray]:
        """The same of many texts, whose new parts go to the library together."""
        tail = [] if end is None else [np.array(end, "<u4").tobytes()]
        found = [self._found(text) if text else [] for text in texts]
        if self.kept.new:
            self.kept.fill()
        return [np.frombuffer(b"".join(parts + tail), "<u4") for parts in found]

    def _found(self, text: str) -> list[bytes | bytearray]:
        if self.apart and not any(x in text for x in self.never):
            return list(map(self.kept.__getitem__, PART.findall(text)))
        return [pack(self.library.encode(text, add_special_tokens=False).ids)]
