import hashlib
import random
import re

import numpy as np

from invoicelake.llm import exact_chunks

SCHEMA = "doc_id long, text string, keep_id string, recipe string"


def brute(rows):
    members = {}
    for doc, text in rows:
        members.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc)
    out = []
    for text, docs in members.items():
        known = [d for d in docs if d is not None]
        keep = min(known) if known else None
        out += [(d, keep, len(docs), d == keep, hashlib.sha256(text.encode()).hexdigest()) for d in docs]
    return sorted(out, key=repr)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in exact_chunks.groups(frame, **options).collect()), key=repr)


def sample():
    rng = random.Random(4)
    words = ["alpha", "β", "gamma", "", "\t", "\n", "\x1c", "\xa0", "delta"]
    passages = [" ".join(rng.choices(words, k=rng.randrange(1, 900))) for _ in range(12)]
    rows = [(i, rng.choice([" ", "\n\n", "\t "]).join(rng.choices(passages, k=rng.randrange(1, 4)))) for i in range(60)]
    rows += [(100 + i, rows[i][1].replace(" ", "  ")) for i in range(0, 60, 2)]
    rows += [(200, None), (201, ""), (202, " "), (203, "\x0b"), (204, "a" * 300_000), (205, "a" * 300_000), (206, "a" * 300_001)]
    return rows + [(207, "twice"), (207, "twice"), (None, "no id"), (None, "no id"), (None, "twice")]


def test_equals_brute_force(spark):
    rows = sample()
    assert found(spark, rows) == brute(rows)


def test_colliding_digests_are_noticed(spark):
    rows = sample()
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    assert exact_chunks.conflicts(exact_chunks.chunks(exact_chunks.texts(frame), 1)) > 0
    assert exact_chunks.conflicts(exact_chunks.chunks(exact_chunks.texts(frame), 16)) == 0
    assert found(spark, rows, size=1) == brute(rows)


def test_chunks_cover_and_follow_the_content():
    data = np.random.default_rng(1).integers(0, 256, 200_000, dtype=np.uint8)
    ends = exact_chunks.boundaries(data)
    assert ends[-1] == len(data) and all(0 < b - a <= exact_chunks.LONGEST_CHUNK for a, b in zip([0, *ends], ends))
    moved = exact_chunks.boundaries(np.concatenate([data[:777], data]))
    assert len(set(ends) & {e - 777 for e in moved}) > 0.9 * len(ends)
    assert exact_chunks.boundaries(data[:0]) == []


def test_deduplicated_keeps_columns_and_empty_tables(spark):
    frame = spark.createDataFrame([(*r, "x", "y") for r in sample()], SCHEMA)
    kept = exact_chunks.deduplicated(frame)
    assert kept.columns == frame.columns
    classes = {}
    for doc, text in sample():  # one row of every class stays, the smallest id, a row without an id last
        classes.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc)
    want = sorted([min(ids, key=lambda i: (i is None, i or 0)) for ids in classes.values()], key=repr)
    assert sorted([r["doc_id"] for r in kept.collect()], key=repr) == want
    empty = frame.limit(0)
    assert exact_chunks.groups(empty).count() == 0 and exact_chunks.deduplicated(empty).count() == 0
