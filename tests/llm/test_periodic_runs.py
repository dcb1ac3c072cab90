"""Runs by suffix trees against trying every period."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from invoicelake.llm import periodic_runs as pr


def plain_runs(words, exponent=4, shortest=6):
    found, n = {}, len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(shortest, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


pieces = st.lists(st.tuples(st.lists(st.integers(0, 3), max_size=6), st.integers(1, 7)), max_size=5)


@settings(max_examples=300, deadline=None)
@given(pieces)
def test_all_runs_are_found(parts):
    symbols = [x for part, times in parts for x in part * times]
    expected = plain_runs(symbols)
    codes = np.array(symbols, np.int64)
    if len(symbols):
        assert [tuple(r) for r in pr.runs_of(codes).tolist()] == expected
    inside = [(a + s, n, p) for a, b in pr.stretches(codes, np.zeros(len(codes), np.int64)) for s, n, p in pr.runs_of(codes[a:b]).tolist()]
    assert sorted(inside) == expected


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=2, max_size=60), st.data())
def test_common_extensions(symbols, data):
    ahead = pr.CommonExtensions(symbols, 4)
    a = data.draw(st.integers(0, len(symbols) - 2))
    b = data.draw(st.integers(a + 1, len(symbols) - 1))
    expected = 0
    while b + expected < len(symbols) and symbols[a + expected] == symbols[b + expected]:
        expected += 1
    assert ahead.length(np.array([a]), np.array([b])).tolist() == [expected]
    suffixes = sorted(range(len(symbols)), key=lambda i: symbols[i:])
    assert np.argsort(ahead.rank)[1:].tolist() == suffixes


def expected_row(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    told = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(best if best else (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(told.encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


@pytest.mark.parametrize("order", [1, 7])
def test_query_against_brute_force(spark, order):
    rng = np.random.default_rng(order)
    texts = [None, "", "  \n\t", "a", "a a a a a a", "ja " * 3000, "x\x1cy x\x1cy x\x1cy x\x1cy x\x1cy x\x1cy", "né né né né né né né ü"]
    for _ in range(120):
        words = [f"w{k}" for k in rng.integers(0, rng.integers(1, 40), rng.integers(0, 90))]
        texts.append(" ".join(words) + "\n" + " ".join(words[:9]) * int(rng.integers(1, 6)))
    rows = [(k * 13 if k % 11 else None, text, "words", 1.0) for k, text in enumerate(texts)] + [(26, texts[5], "words", 2.0)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string, runs double")
    got = [tuple(r) for r in pr.digests(pr.periodic_runs(pr.planted(docs))).collect()]
    assert sorted(got, key=repr) == sorted((expected_row(r[0], r[1]) for r in rows), key=repr)


def test_runs_and_text(spark):
    docs = spark.createDataFrame([(1, "start ab cd ab cd ab cd ab cd ab end")], "doc_id long, text string")
    row = pr.periodic_runs(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 9, 2)]
    assert row["collapsed"] == "start ab cd end"


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pr.digests(pr.periodic_runs(pr.planted(none))).collect() == []


def test_long_text():
    codes = np.arange(120_000) % 997
    assert pr.stretches(codes, np.zeros(len(codes), np.int64)) == [(0, 120_000)]
    assert pr.runs_of(codes).tolist() == [[0, 120_000, 997]]
