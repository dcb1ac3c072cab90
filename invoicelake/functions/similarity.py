"""Similarity ratio of two strings (longest matching blocks, as defined by Python's ``difflib``).

The ratio is 2 M / S, with M matched characters in blocks and S the length of both strings. Two bounds make searches exact without comparing everything:

* M is at most the number of shared letters.
* Between two blocks lies an unmatched character of one side, so there are at most 1 + S - 2 M blocks, and a block of n characters holds n - q + 1 pieces of q
  characters. Strings with at least M matched characters hence share at least M - (q - 1) (1 + S - 2 M) pieces (counted as often as they occur).
  Of the pieces of one string, put in any order, all but that number less one must therefore contain a shared one.

The blocks are a common subsequence, so strings with S - 2 M unmatched characters become equal when these are left out. As M is at most the length l of one string,
S is at most 2 l / ratio, and names of a ratio or more have at most 2 l (1 - ratio) / ratio unmatched characters.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

PIECES = (2, 3, 4)  # lengths of the pieces of an index of names (one digit each)
SEED_NAMES = 8    # names of a batch compared in full for a text's first score
REACH = 2         # characters left out of a name and a text together when close ones are looked for
LONGEST = 64      # characters of a text that is looked for this way; left-out characters are too many beyond
ROUND = 16        # names compared before the others are checked against the best ratio again


@F.pandas_udf(DoubleType())
def ratio(first: pd.Series, second: pd.Series) -> pd.Series:
    """Ratio in argument order (it is not symmetric); NULL when either side is NULL."""
    out = [None if a is None or b is None else 1.0 if a == b else SequenceMatcher(None, a, b).ratio()
           for a, b in zip(first, second)]
    return pd.Series(out, dtype="float64")


# keeps Spark from copying the call into a pushed-down filter, where every string would be compared again
ratio = ratio.asNondeterministic()


class NameIndex:
    """Best match within a bounded list of (id, name).

    The shared letters of two strings bound their ratio from above. The names with the largest bounds are tried
    first, and a name whose bound is below the best ratio found is never compared in full: the answer is exact.
    """

    def __init__(self, master: list[tuple[str, str]]):
        self.master = sorted(master)
        self.names = [name.lower() for _, name in self.master]
        self.position: dict[str, int] = {}
        for i, name in enumerate(self.names):
            self.position.setdefault(name, i)
        self.letters = {c: j for j, c in enumerate(sorted(set("".join(self.names))))}
        self.table = np.zeros((len(self.letters), len(self.names)), dtype=np.int32)     # letter x name -> occurrences
        for i, name in enumerate(self.names):
            for c in name:
                self.table[self.letters[c], i] += 1
        self.lengths = np.array([len(name) for name in self.names], dtype=np.int64)

    def bounds(self, text: str) -> np.ndarray:
        shared = np.zeros(len(self.names), dtype=np.int32)
        for c, n in Counter(text).items():
            if c in self.letters:
                shared += np.minimum(self.table[self.letters[c]], n)
        return 2.0 * shared / np.maximum(self.lengths + len(text), 1)

    def best(self, text: str) -> tuple[str | None, str | None, float]:
        if text in self.position:
            return (*self.master[self.position[text]], 1.0)
        matcher = SequenceMatcher(None, "", text)
        bound = self.bounds(text)
        open_ = np.flatnonzero(bound > 0)
        top, at = 0.0, -1
        while len(open_):
            first = np.argpartition(-bound[open_], ROUND)[:ROUND] if len(open_) > ROUND else np.arange(len(open_))
            for i in open_[first]:
                if bound[i] >= top:
                    matcher.set_seq1(self.names[i])
                    score = matcher.ratio()
                    if score > top or (score == top and score > 0.0 and i < at):
                        top, at = score, int(i)
            rest = np.delete(open_, first)
            open_ = rest[bound[rest] >= top]
        return (None, None, 0.0) if at < 0 else (*self.master[at], top)


def shared_pieces(length: int, best: float, q: int) -> int:
    """How many pieces of ``q`` characters a text of ``length`` shares with any other of ratio ``best`` or more, at least (maybe none)."""
    if best <= 0:
        return 0
    least = math.inf
    for other in range(math.ceil(length * best / (2 - best) - 1e-9), math.floor(length * (2 - best) / best + 1e-9) + 1):
        both = length + other
        matched = math.ceil(best * both / 2 - 1e-9)  # more matches only raise the number of shared pieces
        least = min(least, matched - (q - 1) * (1 + both - 2 * matched))
    return max(int(least), 0) if least < math.inf else 0


@F.pandas_udf(ArrayType(StringType()))
def pieces_of(texts: pd.Series) -> pd.Series:
    """The pieces of ``PIECES`` characters of a text, the n-th occurrence of a piece (after the first) marked by its number."""
    def pieces(text: str) -> list[str]:
        seen: dict[str, int] = {}
        out = []
        for q in PIECES:
            for i in range(len(text) - q + 1):
                piece = f"{q}{text[i:i + q]}"
                seen[piece] = n = seen.get(piece, 0) + 1
                out.append(piece if n == 1 else f"{piece}\0{n}")
        return out
    return texts.map(pieces)


def left_out(text: Column, number: int) -> Column:
    """Hashes of the text without any ``number`` (0 to 2) of its characters, each once. Equal hashes are a hint; the ratio decides."""
    def without(value: Column, at: Column) -> Column:
        return F.concat(F.substring(value, F.lit(1), at - 1), F.substring(value, at + 1, F.length(value)))

    if number == 0:
        return F.array(F.xxhash64(text))
    last = F.length(text)
    if number == 1:
        every = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(without(text, i)))
    else:
        every = F.flatten(F.transform(F.sequence(F.lit(2), last), lambda j: F.transform(
            F.sequence(F.lit(1), j - 1), lambda i: F.xxhash64(without(without(text, j), i)))))
    return F.when(last >= number, F.array_distinct(every)).otherwise(F.array().cast("array<bigint>"))


def within_reach(length: Column, best: Column) -> Column:
    """Whether every name of ratio ``best`` or more to a text of ``length`` has at most ``REACH`` characters unmatched, on both sides together."""
    return F.coalesce((best > 0) & (2 * length * (1 - best) < (REACH + 1 - 1e-9) * best), F.lit(False))


def telling_pieces(length: int, best: float, pieces: list[tuple[int, str]], most: float) -> tuple[list[str] | None, int]:
    """Pieces (of (frequency, piece)) and a number: every name of ratio ``best`` or more holds so many of them.

    The rarest pieces of the length that meets the fewest names; one more than needed, so that a name must hold two. None if the names met are more than ``most``.
    """
    chosen, cost, held = None, most, 1
    for q in PIECES:
        shared = shared_pieces(length, best, q)
        if shared > 0:
            own = sorted(p for p in pieces if p[1][0] == str(q))
            at_least = min(shared, 2)
            first = own[:len(own) - shared + at_least]
            meets = sum(frequency for frequency, _ in first)
            if meets <= cost:
                chosen, cost, held = [piece for frequency, piece in first if frequency], meets, at_least
    return chosen, held


_BINS = 64


def _letter_counts(texts: list[str]) -> np.ndarray:
    """Letters per text in a few bins; letters that share a bin only raise a bound."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(text) for text in texts])
    counts = np.bincount(row * _BINS + codes % _BINS, minlength=len(texts) * _BINS).reshape(len(texts), _BINS)
    return counts.astype(np.uint16 if counts.max(initial=0) < 1 << 16 else np.int64)


def _bounded(name: pd.Series, text: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Upper bounds of the ratios, and both columns as places in their distinct values."""
    (name_at, names), (text_at, texts) = pd.factorize(name), pd.factorize(text)
    a, b = _letter_counts(list(names)), _letter_counts(list(texts))
    size = a.sum(1)[name_at] + b.sum(1)[text_at]
    shared = [np.minimum(a[name_at[k:k + 1024]], b[text_at[k:k + 1024]]).sum(1) for k in range(0, len(name_at), 1024)]
    return 2.0 * np.concatenate([np.empty(0), *shared]) / np.maximum(size, 1), name_at, names, text_at, texts


@F.pandas_udf(DoubleType())
def ratio_from(name: pd.Series, text: pd.Series, least: pd.Series) -> pd.Series:
    """Ratio of name and text where it may reach ``least``, NULL where the shared letters exclude that."""
    bound, name_at, names, text_at, texts = _bounded(name, text)
    out = np.full(len(name), np.nan)
    open_ = np.flatnonzero(bound >= least.to_numpy() - 1e-12)
    matcher, current = SequenceMatcher(None, "", ""), -1
    for k in open_[np.argsort(text_at[open_], kind="stable")].tolist():
        if text_at[k] != current:
            current = text_at[k]
            matcher.set_seq2(texts[current])
        matcher.set_seq1(names[name_at[k]])
        out[k] = matcher.ratio()
    return pd.Series(out).astype("Float64").where(~np.isnan(out))


ratio_from = ratio_from.asNondeterministic()


def first_scores(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(top, best): of some pairs (top, name) the ratios of each text's most promising names, lower bounds of its best one."""
    for frame in frames:
        if len(frame):
            bound, *_ = _bounded(frame["name"], frame["top"])
            most = frame.assign(bound=bound).sort_values("bound", kind="stable").groupby("top").tail(SEED_NAMES)
            yield pd.DataFrame({"top": most["top"], "best": [SequenceMatcher(None, a, b).ratio() for a, b in zip(most["name"], most["top"])]})


LONG = 64               # characters up to which strings are compared side by side
SIDE_BY_SIDE = 1 << 17  # pairs compared in the same steps
COLUMNS = 1 << 13       # of these, pairs whose tables of runs are held at once


def text_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters as small numbers from 2 on, a row of at most ``LONG`` per text (0 beyond its end), and the lengths."""
    lengths = np.array([len(text) for text in texts], np.int64)
    width = int(min(lengths.max(initial=0), LONG))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    letters, places = np.unique(points, return_inverse=True)
    codes = np.zeros((len(texts), width), np.uint8 if len(letters) < 254 else np.uint32)
    row = np.repeat(np.arange(len(texts)), lengths)
    at = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    codes[row[at < width], at[at < width]] = places[at < width] + 2
    return codes, lengths


def _longest_block(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per column of ``a`` and ``b`` (characters in rows) the longest common block: its length and both ends. Of several the first in ``a``, then in ``b``."""
    best, end, other = np.zeros(a.shape[1], np.uint8), np.zeros(a.shape[1], np.int32), np.zeros(a.shape[1], np.int32)
    runs = np.zeros((len(a) + 1, len(b) + 1, min(COLUMNS, a.shape[1])), np.uint8)
    for k in range(0, a.shape[1], COLUMNS):
        part = slice(k, k + COLUMNS)
        right, longest, ends = b[:, part], best[part], end[part]
        held = runs[:, :, :len(longest)]
        for i, letter in enumerate(a[:, part]):
            np.add(held[i, :-1], 1, out=held[i + 1, 1:])
            held[i + 1, 1:] *= right == letter
            top = held[i + 1].max(axis=0)
            ends[top > longest] = i + 1
            np.maximum(longest, top, out=longest)
        other[part] = (held[ends, :, np.arange(len(longest))] == longest[:, None]).argmax(axis=1)
    return best, end, other


def _piece(codes: np.ndarray, rows: np.ndarray, start: np.ndarray, stop: np.ndarray, blank: int) -> np.ndarray:
    """The characters ``start`` to ``stop`` of some rows, one column each, ``blank`` after the end."""
    first, out = rows * codes.shape[1] + start, np.empty((int((stop - start).max()), len(rows)), codes.dtype)
    for k, row in enumerate(out):
        np.take(codes.ravel(), first + k, out=row, mode="clip")
        row[stop - start <= k] = blank
    return out


@cache
def _small_tables() -> np.ndarray:
    """The matched characters of two texts of up to four, by the 16 bits that say which of their characters are equal (bit 4 i + j: i-th and j-th).

    What lies before and after the longest block is the same table without the other bits, so the counts follow from those of smaller tables.
    """
    tables = np.arange(1 << 16)
    equal = (tables >> np.arange(16)[:, None] & 1).astype(np.uint8).reshape(4, 4, -1)
    best, end, other = np.zeros((3, 1 << 16), np.int64)
    run = np.zeros((5, 5, 1 << 16), np.int64)
    for i in range(4):
        for j in range(4):
            run[i + 1, j + 1] = (run[i, j] + 1) * equal[i, j]
            longer = run[i + 1, j + 1] > best
            best[longer], end[longer], other[longer] = run[i + 1, j + 1][longer], i + 1, j + 1
    cells = [(1 << 4 * i + j, i, j) for i in range(4) for j in range(4)]
    before = sum(((i < end - best) & (j < other - best)) * bit for bit, i, j in cells)
    after = sum(((i >= end) & (j >= other)) * bit for bit, i, j in cells)
    out = np.zeros(1 << 16, np.int64)
    for _ in range(4):      # each time at least one character is taken off
        out = np.where(best > 0, best + out[tables & before] + out[tables & after], 0)
    return out.astype(np.uint8)


def matched_letters(codes: np.ndarray, lengths: np.ndarray, texts: list[str], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The characters in matching blocks (``M`` above) of text ``first`` with text ``second``, for many pairs of places in ``texts``.

    Texts up to ``LONG`` characters go side by side: the longest block of all pairs, then of what lies before and after it, until nothing is left.
    """
    out = np.zeros(len(first), np.int64)
    same = first == second
    out[same] = lengths[first[same]]
    long_ = ~same & (np.maximum(lengths[first], lengths[second]) > LONG)
    for k in np.flatnonzero(long_).tolist():
        out[k] = sum(block.size for block in SequenceMatcher(None, texts[first[k]], texts[second[k]]).get_matching_blocks())
    open_ = np.flatnonzero(~same & ~long_)
    for k in range(0, len(open_), SIDE_BY_SIDE):
        pair = open_[k:k + SIDE_BY_SIDE].astype(np.int32)
        zero = np.zeros(len(pair), np.int32)
        work = [(pair, zero, lengths[first[pair]].astype(np.int32), zero, lengths[second[pair]].astype(np.int32))]
        while work:
            pair, a0, a1, b0, b1 = (np.concatenate(part) for part in zip(*work))
            work = []
            size = np.maximum(a1 - a0, b1 - b0)
            size[(a1 <= a0) | (b1 <= b0)] = 0
            for low, high in ((0, 4), (4, 8), (8, 16), (16, LONG)):    # alike in size, so that little of a table is empty
                at = np.flatnonzero((size > low) & (size <= high))
                if not len(at):
                    continue
                p, i0, i1, j0, j1 = pair[at], a0[at], a1[at], b0[at], b1[at]
                a, b = _piece(codes, first[p], i0, i1, 0), _piece(codes, second[p], j0, j1, 1)
                if high == 4:
                    table = np.zeros(len(p), np.uint16)
                    for i in range(len(a)):
                        for j in range(len(b)):
                            table |= (a[i] == b[j]).astype(np.uint16) << np.uint16(4 * i + j)
                    np.add.at(out, p, _small_tables()[table].astype(np.int64))
                    continue
                found, i, j = _longest_block(a, b)
                np.add.at(out, p, found.astype(np.int64))
                hit = found > 0
                p, i0, i1, j0, j1, i, j, found = (v[hit] for v in (p, i0, i1, j0, j1, i, j, found.astype(np.int32)))
                work.append((p, i0, i0 + i - found, j0, j0 + j - found))
                work.append((p, i0 + i, i1, j0 + j, j1))
    return out
