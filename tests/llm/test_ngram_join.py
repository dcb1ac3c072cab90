import random
import re

import numpy as np
import pytest

from invoicelake.llm import ngram_join

SCHEMA = "doc_id long, text string, n long, component_id string, gram string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """Component of every row by all pairs of rows."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(members) if members and sets[i] else doc))
    return sorted(out, key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in ngram_join.near_duplicates(frame).collect()), key=repr)


def near_copies(seed, groups, size, length, edits):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(50_000)}" for _ in range(rng.randrange(*length))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randrange(edits)):
                kind, at = rng.randrange(3), rng.randrange(len(words))
                if kind == 0:
                    words[at] = f"v{rng.randrange(10**6)}"
                elif kind == 1:
                    words.insert(at, f"v{rng.randrange(10**6)}")
                elif len(words) > 5:
                    del words[at]
            rows.append((len(rows), " ".join(words)))
    return rows


def test_groups_of_near_copies(spark):
    rows = near_copies(1, 12, 14, (5, 120), 7) + [(10_000, None), (10_001, ""), (10_002, " \n"), (10_003, "one two"), (10_004, "ONE  two"),
                                                 (10_005, "two one"), (10_006, "a b c d e"), (10_007, "a b c d e"), (None, "a b c d e")]
    rows += [(3, rows[3][1]), (10_008, rows[0][1].upper()), (10_009, "x " * 60_000), (10_010, "x " * 50_000)]
    assert found(spark, rows) == brute(rows)


def test_one_large_group_with_outsiders(spark):
    """Copies so different that many pairs miss the threshold, and links that only hold between two of the edited ones."""
    rows = near_copies(2, 1, 150, (60, 61), 9)
    rows += [(1000 + i, t + f" tail{i // 2}") for i, (_, t) in enumerate(rows[:40])]
    assert found(spark, rows) == brute(rows)


def test_chain_and_shared_passage(spark):
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i:4 * i + 80])) for i in range(60)]  # neighbours link, ends do not
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(100 + i, passage + " " + " ".join(f"q{i}_{k}" for k in range(30))) for i in range(40)]
    rows += [(200 + i, passage + f" end{i}") for i in range(5)]
    got = found(spark, rows)
    assert got == brute(rows)
    assert len({c for d, _, c in got if d < 60}) == 1


@pytest.mark.parametrize("seed", [3, 4])
def test_few_words(spark, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choices("ab", k=rng.randrange(0, 14)))) for i in range(120)]
    assert found(spark, rows) == brute(rows)


def test_components_of_any_graph(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 360)] + [(500, i) for i in range(400, 460)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    want = {n: find(n) for n in root if any(n in e and e[0] != e[1] for e in edges)}
    got = ngram_join.components(spark.createDataFrame(edges, "x long, y long")).collect()
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_one_per_group_and_empty_table(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "z"), (4, None), (None, "z")]
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    kept = ngram_join.one_per_group(frame)
    assert kept.columns == frame.columns
    assert sorted([r["doc_id"] for r in kept.collect()], key=repr) == [1, 3, 4]  # the row without an id repeats the text of 3
    assert ngram_join.near_duplicates(frame.limit(0)).count() == 0


def test_seven_words_and_an_eighth(spark):
    """Three n-grams against four, three of them shared, are just 75%; no other set holds any of them."""
    rows = []
    for k in range(60):
        words = [f"s{k}w{i}" for i in range(8)]
        rows += [(2 * k, " ".join(words[k % 2:][:7])), (2 * k + 1, " ".join(words))]
    got = found(spark, rows)
    assert got == brute(rows)
    assert len({c for _, _, c in got}) == 60


def test_hashes_needed_of_every_partner():
    """Worst cases of all sizes: the hashes that only one of two linked sets has come first in its order."""
    sizes = np.arange(1, 701)
    taken, needed = ngram_join._taken(sizes).tolist(), ngram_join._needed(sizes).tolist()
    assert min(needed) >= 1
    for n in sizes.tolist():
        for m in range((3 * n + 3) // 4, 4 * n // 3 + 1):
            o = -(-3 * (n + m) // 7)
            if o <= min(n, m):
                assert needed[n - 1] <= min(o - (n - taken[n - 1]), o - (m - min(m, -(-2 * m // 5))))


def test_short_texts_spread_over_fragments(spark):
    """Sets of one n-gram send hashes from the whole range; no fragment holds a large part of them."""
    frame = spark.createDataFrame([(i, f"s{i}") for i in range(4000)], "doc_id long, text string").coalesce(1)
    rows = ngram_join._parts(frame, 8).filter("fragment >= 0").collect()
    held = {r["fragment"]: len(r["hashes"]) // 4 for r in rows}
    assert sum(held.values()) == 4000 and max(held.values()) < 500
