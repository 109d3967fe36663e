"""Jaro-Winkler similarity over UTF-8 bytes, vectorized over all pairs of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of one comparison (pairs x longest x longest) that are worked on at once, and pairs at most; a pair beyond that goes alone.
CELLS = 1 << 22
CHUNK = 8192
#: Bytes of a name whose places fit the bits of a word.
BITS = 64


class Picked:
    """``words[i]`` for each i of ``at``, without a list of them."""

    def __init__(self, words: list[bytes], at: np.ndarray):
        self.words, self.at = words, at

    def __len__(self) -> int:
        return len(self.at)

    def __iter__(self) -> Iterator[bytes]:
        return map(self.words.__getitem__, self.at.tolist())


def _coded(left: list[bytes] | Picked, right: list[bytes] | Picked) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Different words and the numbers of both sides in them."""
    code: dict[bytes, int] = {}
    number = lambda words: np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64)
    sides = []
    for x in (left, right):
        if isinstance(x, Picked):
            used, place = np.unique(x.at, return_inverse=True)
            sides.append(number(x.words[i] for i in used.tolist())[place])
        else:
            sides.append(number(x))
    return list(code), *sides


def _padded(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(v) for v in values])
    width = max(1, int(length.max(initial=0)))
    flat = b"".join(v.ljust(width, b"\0") for v in values)
    return np.frombuffer(flat, np.uint8).reshape(len(values), width), length


def _in_order(chars: np.ndarray, matched: np.ndarray, width: int) -> np.ndarray:
    """Each row's matched bytes, moved together to the left."""
    out = np.zeros((len(chars), width), np.uint8)
    row, col = np.nonzero(matched)
    out[row, (np.cumsum(matched, axis=1) - 1)[row, col]] = chars[row, col]
    return out


def jaro_winkler(left: list[bytes] | Picked, right: list[bytes] | Picked) -> np.ndarray:
    """Prefix bonus of 0.1 for each of up to 4 equal first bytes, where the Jaro value is over 0.7; two empty names score 0.

    Equal names are 1 at once. Names of up to ``BITS`` bytes go by bits. The others go by length, so that a long name is padded to no short one's cost and holds up no other pair.
    """
    if len(left) != len(right):
        raise ValueError("as many left names as right ones")
    words, a, b = _coded(left, right)
    length = np.fromiter(map(len, words), np.int64, len(words))
    la, lb = length[a], length[b]
    out = ((a == b) & (la > 0)).astype(float)
    todo = np.flatnonzero((a != b) & (la > 0) & (lb > 0))
    longest = np.maximum(la, lb)[todo]
    short = todo[longest <= BITS]
    if len(short):
        short = short[np.lexsort((a[short], lb[short]))]
        chars = _padded([w if len(w) <= BITS else b"" for w in words])[0]
        for i in range(0, len(short), CHUNK):
            part = short[i : i + CHUNK]
            out[part] = _by_bits(chars, a[part], b[part], la[part], lb[part])
    todo, longest = todo[longest > BITS], longest[longest > BITS]
    todo = todo[np.argsort(longest, kind="stable")]
    longest = np.sort(longest)
    i = 0
    while i < len(todo):
        j = min(len(todo), i + CHUNK)
        while j > i + 1 and (j - i) * longest[j - 1] ** 2 > CELLS * 4:
            j = i + max(1, (j - i) // 2)
        part = todo[i:j]
        out[part] = _chunk([words[k] for k in a[part]], [words[k] for k in b[part]])
        i = j
    return out


def _by_bits(chars: np.ndarray, a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Scores of pairs of rows of ``chars``, sorted by ``lb``. A bit stands for a place of the left name: that with the first byte of a match is the lowest one."""
    one, none = np.uint64(1), np.uint64(0)
    used, place = np.unique(a, return_inverse=True)
    where = np.zeros((len(used), 256), np.uint64)  # the places of each byte
    size = np.zeros(len(used), np.int64)
    size[place] = la
    for p in range(int(size.max())):
        rows = np.flatnonzero(size > p)
        where[rows, chars[used[rows], p]] |= np.uint64(1 << p)
    where, base = where.ravel(), place * 256
    right = chars[b].T.astype(np.int64)
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    window = (one << (reach + 1).astype(np.uint64)) - one
    taken = np.zeros(len(a), np.uint64)
    met, hits = [], []
    for j in range(int(lb[-1])):
        here = where[base + right[j]]
        if j >= lb[0]:
            here[: np.searchsorted(lb, j, side="right")] = none
        free = here & window & ~taken
        low = free & (~free + one)
        taken |= low
        met.append(here)
        hits.append(low != none)
        window = (window << one) | (reach > j)
    left, swapped = taken.copy(), np.zeros(len(a), np.int64)
    for here, hit in zip(met, hits, strict=True):
        low = left & (~left + one)
        swapped += hit & ((here & low) == none)
        left ^= low * hit
    m = np.bitwise_count(taken).astype(float)
    half = (swapped // 2).astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - half) / m) / 3, 0.0)
    shared = min(4, chars.shape[1])
    first, second = chars[a, :shared], chars[b, :shared]
    return _with_prefix(jaro, (first == second) & (np.arange(shared)[None] < np.minimum(la, lb)[:, None]))


def _with_prefix(jaro: np.ndarray, same: np.ndarray) -> np.ndarray:
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)


def _chunk(left: list[bytes], right: list[bytes]) -> np.ndarray:
    a, la = _padded(left)
    b, lb = _padded(right)
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    place = np.arange(a.shape[1])
    got_a, got_b = np.zeros(a.shape, bool), np.zeros(b.shape, bool)
    rows = np.arange(len(a))
    for j in range(b.shape[1]):
        fits = (a == b[:, j, None]) & ~got_a & (np.abs(place[None] - j) <= reach[:, None]) & (place[None] < la[:, None]) & (j < lb)[:, None]
        first = fits.argmax(axis=1)
        hit = fits[rows, first]
        got_a[rows[hit], first[hit]] = True
        got_b[hit, j] = True
    m = got_a.sum(axis=1).astype(float)
    width = max(a.shape[1], b.shape[1])
    half = ((_in_order(a, got_a, width) != _in_order(b, got_b, width)).sum(axis=1) // 2).astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - half) / m) / 3, 0.0)
    shared = min(4, a.shape[1], b.shape[1])
    same = (a[:, :shared] == b[:, :shared]) & (place[:shared][None] < np.minimum(la, lb)[:, None])
    return _with_prefix(jaro, same)


def _scores(left: pd.Series, right: pd.Series) -> np.ndarray:
    """Each different pair of the batch is scored once; a null on either side gives NaN."""
    known = (left.notna() & right.notna()).to_numpy()
    out = np.full(len(left), np.nan)
    pairs = pd.DataFrame({"l": left[known], "r": right[known]})
    code = pairs.groupby(["l", "r"], sort=False).ngroup().to_numpy()
    distinct = pairs.drop_duplicates()
    score = jaro_winkler([x.encode() for x in distinct["l"]], [x.encode() for x in distinct["r"]])
    out[known] = score[code] if len(code) else score
    return out


def jw(left: Column, right: Column, cutoff: float = 0.0) -> Column:
    """Jaro-Winkler; below ``cutoff`` 0. Not deterministic to the optimizer, so that a filter on it does not run it twice."""

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        s = _scores(a, b)
        return pd.Series(np.where(s < cutoff, 0.0, s)).astype(object).where(~np.isnan(s), None)

    return F.pandas_udf(run, "double").asNondeterministic()(left, right)


def best_jw(norm_l: Column, norm_r: Column, tokens_l: Column, tokens_r: Column, cutoff: float) -> Column:
    """The larger of the scores of names and of their sorted tokens, in one pass over Arrow."""

    def run(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        s = _scores(a, b)
        other = ((a != c) | (b != d)).to_numpy()  # elsewhere the sorted tokens are the names themselves
        s[other] = np.fmax(s[other], _scores(c[other], d[other]))
        return pd.Series(np.where(s < cutoff, 0.0, s))

    return F.pandas_udf(run, "double").asNondeterministic()(norm_l, norm_r, tokens_l, tokens_r)


LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"


def letters(name: Column) -> Column:
    """A bit for each letter and digit that a normalized name holds."""
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.contains(name, F.lit(x)), F.lit(1 << i)).otherwise(F.lit(0)) for i, x in enumerate(LETTERS)]).cast("long")


def most_jw(norm_l: Column, norm_r: Column, tokens_l: Column, tokens_r: Column, letters_l: Column, letters_r: Column) -> Column:
    """No less than ``best_jw`` without a cutoff, from built-in functions. A letter that only one name holds is matched nowhere in it; names with unlike first letters have no bonus."""
    la, lb = F.length(norm_l), F.length(norm_r)
    lone = lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))
    m = F.least(la - lone(letters_l, letters_r), lb - lone(letters_r, letters_l))
    jaro = F.when(m > 0, (m / la + m / lb + F.lit(1.0)) / 3).otherwise(F.lit(0.0))
    alike = (F.substring(norm_l, 1, 1) == F.substring(norm_r, 1, 1)) | (F.substring(tokens_l, 1, 1) == F.substring(tokens_r, 1, 1))
    bonus = F.when(alike, F.lit(0.4)).otherwise(F.lit(0.0))
    return F.lit(1e-9) + bonus + (1 - bonus) * jaro
