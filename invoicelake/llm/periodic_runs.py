"""Runs: stretches of words that repeat with a period, at least ``EXPONENT`` times over and ``SHORTEST`` words long.

Per document, with words as symbols:

1. Only stretches where a run is possible are looked at. Inside a run of period q, words i to i+2 stand again q words before or behind, and a
   run inside a stretch of m words has 4 * q <= m. Triples without an equal one that near are cut out, again for what is left until
   nothing changes. Whatever is cut cannot belong to a run, so this loses none; it only keeps ordinary prose away from the trees.
2. Ukkonen's algorithm builds the suffix tree of the stretch and of its reversal. The Euler tour of a tree, with a range minimum over the string depths, gives
   the lowest common ancestor of two leaves and so the longest common extension of two places in constant time.
3. The longest Lyndon word that starts at a place ends before the next smaller suffix (before the next larger one for the reversed order of the words). Every
   run has a root among these words, so the candidates are two per place; each is extended to both sides by common extensions.

A Lyndon word is primitive, hence the period found is the smallest one. The trees take about 1 kB per word of the stretch at hand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.llm.common import byte_rows, row_groups

EXPONENT = 4
SHORTEST = 6
_TRIPLE = 3
_BLOCK = 16
_RUNS = "array<struct<start:long,length:long,period:long>>"


class RangeMinimum:
    """Least value of any stretch: minima from each block's start and to its end, a table over whole blocks between."""

    def __init__(self, values: np.ndarray) -> None:
        blocks = -(-len(values) // _BLOCK)
        self.values = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, np.int32)
        self.values[:len(values)] = values
        square = self.values.reshape(blocks, _BLOCK)
        self.ahead = np.minimum.accumulate(square, 1).ravel()
        self.behind = np.minimum.accumulate(square[:, ::-1], 1)[:, ::-1].ravel()
        self.table = [square.min(1)]
        while 2 << len(self.table) - 1 <= blocks:
            last, step = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(last[:-step], last[step:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima over first..last, both included."""
        a, b = first // _BLOCK, last // _BLOCK
        out = np.minimum(self.behind[first], self.ahead[last])
        for k, level in enumerate(self.table):
            at = np.flatnonzero((b - a - 1 >> k == 1))
            out[at] = np.minimum(out[at], np.minimum(level[a[at] + 1], level[b[at] - (1 << k)]))
        at = np.flatnonzero(a == b)
        inside = np.minimum(first[at, None] + np.arange(_BLOCK), last[at, None])
        out[at] = self.values[inside].min(1, initial=np.iinfo(np.int32).max)
        return out


def suffix_tree(text: list[int], base: int) -> tuple[dict[int, int], list[int], list[int]]:
    """Ukkonen's construction: edges ``node * base + first symbol -> child``, and per node the start and end of its edge label.

    The last symbol must occur only once, symbols lie below ``base``.
    """
    n = len(text)
    edges: dict[int, int] = {}
    start, end, link = [0], [0], [0]
    node = edge = length = waiting = 0
    for i, symbol in enumerate(text):
        waiting += 1
        unlinked = 0
        while waiting:
            if not length:
                edge = i
            key = node * base + text[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                head = start[child]
                span = end[child] - head
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                if text[head + length] == symbol:
                    if unlinked:
                        link[unlinked] = node
                    length += 1
                    break
                inner = len(start)
                start += (head, i)
                end += (head + length, n)
                link += (0, 0)
                edges[key] = inner
                edges[inner * base + symbol] = inner + 1
                edges[inner * base + text[head + length]] = child
                start[child] = head + length
                if unlinked:
                    link[unlinked] = inner
                unlinked = inner
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return edges, start, end


class CommonExtensions:
    """Longest common extensions of the suffixes of a list of symbols (1 and above); ``rank`` is their order."""

    def __init__(self, symbols: list[int], base: int) -> None:
        text = [*symbols, 0]
        edges, start, end = suffix_tree(text, base)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        children = np.fromiter(edges.values(), np.int64, len(edges))[order].tolist()
        bounds = np.searchsorted(keys[order], np.arange(len(start) + 1) * base).tolist()
        n, depth, tour = len(text), [0] * len(start), []
        seen = np.zeros(n, np.int64)
        leaves: list[int] = []
        stack = [0]
        while stack:  # a negative entry is a return to an inner node
            node = stack.pop()
            if node < 0:
                tour.append(depth[~node])
                continue
            deep, low, high = depth[node], bounds[node], bounds[node + 1]
            if low == high:
                seen[n - deep] = len(tour)
                leaves.append(n - deep)
            tour.append(deep)
            for at in range(high - 1, low - 1, -1):
                child = children[at]
                depth[child] = deep + end[child] - start[child]
                stack.append(child)
                if at > low:
                    stack.append(~node)
        self.rank = np.empty(n, np.int64)
        self.rank[leaves] = np.arange(n)
        self._seen = seen
        self._minimum = RangeMinimum(np.array(tour, np.int32))

    def length(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the text agrees from places ``a`` and ``b`` on (a != b)."""
        x, y = self._seen[a], self._seen[b]
        return self._minimum.least(np.minimum(x, y), np.maximum(x, y)).astype(np.int64)


def next_smaller(values: list[int]) -> list[int]:
    """For every place the next one with a smaller value, or the length."""
    out, stack = [len(values)] * len(values), []
    for i in range(len(values) - 1, -1, -1):
        while stack and values[stack[-1]] > values[i]:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return out


def runs_of(symbols: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> np.ndarray:
    """(start, length, period) of all runs of a list of symbols, in this order."""
    m = len(symbols)
    named = np.unique(symbols, return_inverse=True)[1] + 1
    base = int(named.max(initial=0)) + 1
    ahead = CommonExtensions(named.tolist(), base)
    rank = ahead.rank.tolist()
    place = np.arange(m)
    begin, period = [], []
    for values in (rank, [-r for r in rank[:-1]]):
        step = np.minimum(np.array(next_smaller(values)[:m]), m) - place
        at = np.flatnonzero((step * exponent <= m) & (place + step < m))
        at = at[named[at] == named[at + step[at]]]
        begin.append(at)
        period.append(step[at])
    i, p = np.concatenate(begin), np.concatenate(period)
    if not len(i):
        return np.empty((0, 3), np.int64)
    right = ahead.length(i, i + p)
    del ahead
    left = CommonExtensions(named[::-1].tolist(), base).length(m - i, m - i - p)
    found = np.stack([i - left, left + p + right, p], 1)
    return np.unique(found[found[:, 1] >= np.maximum(shortest, exponent * p)], axis=0)


def stretches(codes: np.ndarray, owner: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """The parts (first, end) of ``codes`` that may hold runs. ``owner`` tells the document of each word."""
    places = max(len(codes) - _TRIPLE + 1, 0)
    if not places:
        return []
    odd = np.uint64(0x9E3779B97F4A7C15)
    mixed = owner.astype(np.uint64)
    triple = mixed[:places].copy()
    for k in range(_TRIPLE):  # equal triples have equal codes; different ones with equal codes only mean a needless look
        triple = (triple ^ (triple >> np.uint64(29))) * odd + codes[k:k + places].astype(np.uint64)
    triple ^= triple >> np.uint64(32)
    whole = owner[:places] == owner[_TRIPLE - 1:]
    order = np.argsort(triple, kind="stable")
    gap = np.diff(order)
    gap[triple[order[1:]] != triple[order[:-1]]] = len(codes)
    near = np.full(places, len(codes), np.int64)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    at = np.flatnonzero(whole)
    part = owner[at]
    least = max(shortest, exponent) - _TRIPLE + 1
    while True:
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(part) != 0)) + 1
        heads = np.concatenate([[0], cut])
        sizes = np.diff(np.append(heads, len(at)))
        wide = np.repeat(sizes, sizes)
        kept = (wide >= least) & (near[at] * exponent <= wide + _TRIPLE - 1)
        if kept.all():
            return [(int(at[h]), int(at[h]) + int(s) + _TRIPLE - 1) for h, s in zip(heads, sizes)] if len(at) else []
        at = at[kept]
        part = np.repeat(np.arange(len(sizes)), sizes)[kept]


def _without_repeats(words: list[bytes], found: np.ndarray) -> bytes:
    dropped = np.zeros(len(words) + 1, np.int64)
    np.add.at(dropped, found[:, 0] + found[:, 2], 1)
    np.add.at(dropped, found[:, 0] + found[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(dropped[:-1]) == 0)])


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, shortest: int = SHORTEST) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, runs, collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``runs`` are (start, length, period) in words from 0, by start, then period: the stretches with smallest period q and at
    least max(shortest, exponent * q) words that no neighbouring word extends keeping period q. ``collapsed`` is the text without the words
    that lie in some run behind its first period, joined by one space. NULL and empty texts have no words, no runs and an empty text.
    Other columns of ``docs`` are not read; ids may be NULL or repeat.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_rows(batch.column("text"))
            for first, last in row_groups(offsets):
                split = [data[a:b].tobytes().split() for a, b in zip(offsets[first:last], offsets[first + 1:last + 1])]
                counts = np.array([len(words) for words in split], np.int64)
                heads = np.concatenate([[0], np.cumsum(counts)])
                number: dict[bytes, int] = {}
                codes = np.fromiter((number.setdefault(word, len(number)) for words in split for word in words), np.int64, int(heads[-1]))
                found: dict[int, list[np.ndarray]] = {}
                for a, b in stretches(codes, np.repeat(np.arange(len(split)), counts), exponent, shortest):
                    row = int(np.searchsorted(heads, a, side="right")) - 1
                    out = runs_of(codes[a:b], exponent, shortest)
                    if len(out):
                        found.setdefault(row, []).append(out + np.array([a - heads[row], 0, 0]))
                told, collapsed = [], []
                for row, words in enumerate(split):
                    mine = np.concatenate(found[row]) if row in found else np.empty((0, 3), np.int64)
                    told.append([{"start": s, "length": n, "period": p} for s, n, p in mine.tolist()])
                    collapsed.append(_without_repeats(words, mine) if len(mine) else b" ".join(words))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.array(told, kind),
                                                  pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, runs {_RUNS}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; one document in ten (by the checksum of its id; not where that is NULL) has a tail that repeats with a period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    rows = rows.withColumn("a", F.when(n > 0, g % n)).withColumn("p", F.lit(1) + F.floor((n - F.col("a")) / (g % 8 + 3)))
    a, p = F.col("a").cast("int"), F.col("p").cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), a), F.slice(tail, F.lit(1), (n - a).cast("int"))), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and checksums, one row per row."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))

    def line(r: Column) -> Column:
        return F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    rows = found.select("doc_id", "collapsed", "runs", best.alias("best"))
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"),
                       period.alias("period"), F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
                       F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))
