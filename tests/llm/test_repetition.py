"""Repetition rules by suffix arrays against sets of substrings."""

from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from invoicelake.llm import repetition as rp


def covered(words, size):
    windows = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
    seen = Counter(windows)
    return sorted({k for i, window in enumerate(windows) if seen[window] > 1 for k in range(i, i + size)})


def maximal_repeats(words, least):
    """Lengths of all substrings that occur twice or more and lose occurrences with any word more."""
    places = {}
    for i in range(len(words)):
        for j in range(i + least, len(words) + 1):
            places.setdefault(tuple(words[i:j]), []).append(i)
    out = []
    for text, at in places.items():
        before = {words[i - 1] if i else None for i in at}
        behind = {words[i + len(text)] if i + len(text) < len(words) else None for i in at}
        if len(at) > 1 and len(before) > 1 and len(behind) > 1:
            out.append(len(text))
    return out


words = st.lists(st.tuples(st.lists(st.integers(0, 3), max_size=14), st.integers(1, 3)), max_size=4).map(
    lambda parts: [x for part, times in parts for x in part * times])


@settings(max_examples=200, deadline=None)
@given(st.lists(words, min_size=1, max_size=4))
def test_against_substrings(texts):
    flat, heads, used = [], [0], 0
    for k, text in enumerate(texts):
        flat += [used + x for x in text] + [-1 - k]
        used += 4
        heads.append(len(flat))
    windows, spans, number, longest = rp._repetition(np.array(flat), np.array(heads))
    for k, text in enumerate(texts):
        repeats = maximal_repeats(text, rp.LEAST)
        assert np.flatnonzero(windows[heads[k]:heads[k + 1]]).tolist() == covered(text, rp.WINDOW)
        assert np.flatnonzero(spans[heads[k]:heads[k + 1]]).tolist() == covered(text, rp.LEAST)
        assert (number[k], longest[k]) == (len(repeats), max(repeats, default=0))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_suffix_array(symbols):
    text = [*symbols, -1]
    order, _ = rp.suffix_array(np.array(text))
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


LINE = "one two three four five six seven eight nine ten eleven"


def test_rows(spark):
    long = " ".join(f"w{k}" for k in range(2000))
    passage = " ".join(f"p{k}" for k in range(101))
    texts = [None, "", " \n\t\x0b", "a b", f"{LINE}\n{LINE}\n \n{LINE} \nend", long, f"{passage} {long} {passage}", f"{long} {LINE} x {LINE} {long[:300]}",
             "ü#é $x\x1cy <|> " + long, "word " * 30_000]
    rows = [(k if k != 3 else None, text, "clash", 5) for k, text in enumerate(texts)] + [(5, long, "clash", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_words long")
    got = rp.judged(rp.repetition(docs)).collect()
    assert len(got) == len(rows)
    for row in got:
        text = (long if row["doc_id"] == 5 else texts[3 if row["doc_id"] is None else row["doc_id"]]) or ""
        split = [w.decode() for w in text.encode().split()]
        lines = [line for line in text.split("\n") if line.encode().split()]
        assert row["n_words"] == len(split)
        assert row["word_chars"] == sum(map(len, split))
        assert row["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>")
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == len(covered(split, rp.WINDOW))
        where = sorted(k for span in row["spans"] for k in range(span["start"], span["start"] + span["length"]))
        assert where == covered(split, rp.LEAST) and row["n_covered"] == len(where)
    verdict = {row["doc_id"]: (row["base_failed"], row["kept"], row["longest_repeat"]) for row in got}
    assert verdict[0] == verdict[1] == (True, False, 0)
    assert verdict[4] == (True, False, 22)
    assert verdict[5] == (False, True, 0)
    assert verdict[6] == (False, False, 101)
    assert verdict[9] == (True, False, 29_999)


def test_empty_table(spark):
    assert rp.verdicts(spark.createDataFrame([], "doc_id long, text string")).collect() == []
