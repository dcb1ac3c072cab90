"""Quality rules on repetition inside a text, from a suffix array of its words.

The documents of a group are sorted together: words get numbers, every document ends in a word of its own, so no common prefix crosses a document. Prefix doubling
orders the suffixes; in each round only suffixes that still share a rank are sorted again, so prose, whose suffixes differ after a few
words, costs little more than its first two rounds. The ranks of the rounds are kept and give the longest common prefix of neighbours in the suffix array.

The intervals of equal common prefix are the right-maximal repeated substrings; those not always preceded by the same word are the maximal
ones. The union of their spans of at least ``LEAST`` words and the longest of them decide:

* more than ``MOST_COVERED`` percent of the words lie in such spans, or
* one of them is longer than ``LONGEST`` words.

Besides, a text fails the base rules when it has under ``FEWEST`` words or over ``MOST_REPEATED`` percent of them lie in ``WINDOW``-word windows that
occur twice or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoicelake.llm.common import byte_rows, row_groups

WINDOW = 5
FEWEST, MOST_REPEATED = 10, 20
LEAST, MOST_COVERED, LONGEST = 10, 10, 100
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CHARACTER = np.ones(256, bool)  # bytes that begin a character of a word
_CHARACTER[0x80:0xC0] = False
_CHARACTER[list(b" \t\n\x0b\x0c\r")] = False
_SPANS = "array<struct<start:long,length:long>>"


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """The order of the suffixes, and per round (h, places, ranks) of the suffixes whose first h symbols are not unique.

    Every symbol below 0 occurs once, and the last symbol is such a one.
    """
    order = np.argsort(symbols, kind="stable")
    slots, rounds, h = np.arange(len(symbols)), [], 1
    rank = np.empty(len(symbols), np.int64)
    places, keys = order, symbols[order]
    while len(places):
        new = np.append(True, keys[1:] != keys[:-1])
        head = np.maximum.accumulate(np.where(new, slots, 0))
        rank[places] = head
        alone = new & np.append(new[1:], True)
        order[slots] = places
        places, slots, head = places[~alone], slots[~alone], head[~alone]
        if len(places):
            rounds.append((h, places, head))
        # the next h symbols decide; a suffix that reaches its document's end is alone already
        keys = head * len(symbols) + rank[places + h]
        again = np.argsort(keys)
        places, keys = places[again], keys[again]
        h *= 2
    return order, rounds


def common_prefixes(order: np.ndarray, rounds: list[tuple[int, np.ndarray, np.ndarray]], least: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in the order; 0 where it is below ``least``."""
    out = np.zeros(len(order), np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    near = None
    for h, places, head in rounds:  # neighbours that share their first h <= least symbols
        if h <= least:
            slot = np.sort(rank[places])
            shared = np.full(len(order), -1, np.int64)
            shared[rank[places]] = head
            near = slot[(slot > 0) & (shared[slot] == shared[slot - 1])]
    if near is None or not len(near):
        return out
    a, b, length = order[near - 1].copy(), order[near].copy(), np.zeros(len(near), np.int64)
    last = len(order) - 1
    for h, places, head in reversed(rounds):
        rank[places] = head
        more = np.where(rank[a] == rank[b], h, 0)
        a, b, length = np.minimum(a + more, last), np.minimum(b + more, last), length + more
    out[near] = np.where(length >= least, length, 0)
    return out


def prefix_intervals(prefixes: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, first, last) of all stretches first..last of the order whose suffixes share ``length`` >= ``least`` symbols, and no more."""
    out: list[tuple[int, int, int]] = []
    open_: list[tuple[int, int]] = []
    before = -2
    slots = np.flatnonzero(prefixes >= least)
    for slot, value in zip(slots.tolist(), prefixes[slots].tolist()):
        if slot != before + 1:
            out += [(length, first, before) for length, first in open_]
            open_ = []
        first = slot - 1
        while open_ and open_[-1][0] > value:
            length, first = open_.pop()
            out.append((length, first, slot - 1))
        if not open_ or open_[-1][0] < value:
            open_.append((value, first))
        before = slot
    return out + [(length, first, before) for length, first in open_]


def _covered(size: int, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    marks = np.zeros(size + 1, np.int64)
    np.add.at(marks, start, 1)
    np.add.at(marks, start + length, -1)
    return np.cumsum(marks[:-1]) > 0


def _repetition(symbols: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Over some documents (``heads``: where each begins in ``symbols``, and the end): words in repeated windows (bool per word), words in maximal
    repeats (bool per word), and per document the number of maximal repeats and the longest one."""
    order, rounds = suffix_array(symbols)
    prefixes = common_prefixes(order, rounds, min(WINDOW, LEAST))
    deepest = np.maximum(prefixes, np.append(prefixes[1:], 0))  # of the intervals a suffix lies in
    at = np.flatnonzero(deepest >= WINDOW)
    windows = _covered(len(symbols), order[at], WINDOW)
    # a repeat that is not maximal lies inside a maximal one, so all deepest intervals give the union of the maximal ones
    at = np.flatnonzero(deepest >= LEAST)
    spans = _covered(len(symbols), order[at], deepest[at])
    before = np.where(order > 0, symbols[order - 1], -1)
    before = np.where(before < 0, -1 - order, before)  # the beginning of a document is no common word
    changes = np.cumsum(np.append(0, before[1:] != before[:-1]))
    found = np.array(prefix_intervals(prefixes, LEAST), np.int64).reshape(-1, 3)
    found = found[changes[found[:, 2]] > changes[found[:, 1]]]
    owner = np.searchsorted(heads, order[found[:, 1]], side="right") - 1
    number, longest = np.zeros(len(heads) - 1, np.int64), np.zeros(len(heads) - 1, np.int64)
    np.add.at(number, owner, 1)
    np.maximum.at(longest, owner, found[:, 0])
    return windows, spans, number, longest


def _duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def repetition(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_repeats, longest_repeat, n_covered, spans.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``word_chars`` counts code points in words, ``n_symbols`` the characters ``#*$%&|<>``, ``n_dup_lines`` the lines with a word that
    equal an earlier line of the text, ``n_repeat_words`` the words in windows of ``WINDOW`` words found twice or more. ``n_repeats`` maximal repeated
    substrings of ``LEAST`` words or more exist, the longest of ``longest_repeat`` words (0: none); their occurrences cover ``n_covered`` words, which
    are ``spans`` (start, length) in words. NULL and empty texts have zeros. Other columns are not read; ids may be NULL or repeat.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_rows(batch.column("text"))
            for first, last in row_groups(offsets):
                bounds = offsets[first:last + 1]
                raw = [data[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
                lines = [_duplicate_lines(text) if b"\n" in text else 0 for text in raw]
                split = [text.split() for text in raw]
                counts = np.array([len(words) for words in split], np.int64)
                heads = np.concatenate([[0], np.cumsum(counts + 1)])
                # a document's words have numbers of its own, so equal numbers always mean the same document
                flat: list[int] = []
                used = 0
                for k, words in enumerate(split):
                    number: dict[bytes, int] = {}
                    flat += [number.setdefault(word, used + len(number)) for word in words]
                    used += len(number)
                    flat.append(-1 - k)
                symbols = np.array(flat, np.int64)
                windows, spans, number_of, longest = _repetition(symbols, heads)
                body = data[bounds[0]:bounds[-1]]

                def per_row(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
                    return np.diff(np.append(0, np.cumsum(flags))[edges])
                edges = bounds - bounds[0]
                turn = np.flatnonzero(np.diff(np.concatenate([[0], spans, [0]])))
                owner = np.searchsorted(heads, turn[::2], side="right") - 1
                told: list[list[dict[str, int]]] = [[] for _ in split]
                for k, a, b in zip(owner.tolist(), turn[::2].tolist(), turn[1::2].tolist()):
                    told[k].append({"start": a - int(heads[k]), "length": b - a})
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), *(pa.array(column, pa.int64()) for column in (
                        counts, per_row(_CHARACTER[body], edges), per_row(_SYMBOL[body], edges), lines, per_row(windows, heads), number_of, longest,
                        per_row(spans, heads))), pa.array(told, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))], names)
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_repeats", "longest_repeat", "n_covered"]
    names = ["doc_id", *numbers, "spans"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {', '.join(f'{n} long' for n in numbers)}, spans {_SPANS}")


def judged(measured: DataFrame) -> DataFrame:
    """``base_failed`` and ``kept`` beside the measures."""
    base = (F.col("n_words") < FEWEST) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    repeats = (F.col("n_covered") * 100 > F.col("n_words") * MOST_COVERED) | (F.col("longest_repeat") > LONGEST)
    return measured.withColumn("base_failed", base).withColumn("kept", ~base & ~repeats)


def verdicts(docs: DataFrame) -> DataFrame:
    """The counts and the verdict per document, without the spans."""
    return judged(repetition(docs)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                                           "n_covered", (F.col("longest_repeat") > LONGEST).alias("long_repeat"))
