"""Name normalization as Catalyst expressions, with a plain Python version that tests compare."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(letters, replacements) for ``translate``: letters that decompose into one ASCII sign plus marks, then the marks, which go."""
    letters, plain, marks = [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        if unicodedata.category(c) in ("Mn", "Mc", "Me"):
            marks.append(c)
            continue
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if base != c and len(base) == 1 and base.isascii():
            letters.append(c)
            plain.append(base)
    return "".join(letters + marks), "".join(plain)


def normalized(name: Column) -> Column:
    """Lower-case ASCII letters and digits with single blanks; accents go, "&" reads "and"."""
    letters, plain = accent_table()
    bare = F.lower(F.translate(F.replace(name, F.lit("&"), F.lit(" and ")), letters, plain))
    return F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " "))


def normalized_text(name: str | None) -> str | None:
    if name is None:
        return None
    letters, plain = accent_table()
    table = {ord(c): (plain[i] if i < len(plain) else None) for i, c in enumerate(letters)}
    return re.sub("[^a-z0-9]+", " ", name.replace("&", " and ").translate(table).lower()).strip(" ")


def sorted_tokens(norm: Column) -> Column:
    return F.array_join(F.array_sort(F.split(norm, " ")), " ")


def blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")
