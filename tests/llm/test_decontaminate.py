import hashlib
import random
import re

from invoicelake.llm import decontaminate

SCHEMA = "doc_id long, text string, item_id string, at string"


def split(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    out = []
    for doc, text in docs:
        own, hit, ids = split(text), set(), set()
        for item, body in items:
            want = split(body)
            k = min(len(want), 10)
            windows = {tuple(want[j:j + k]) for j in range(len(want) - k + 1)} if k else set()
            for s in range(len(own) - k + 1):
                if k and tuple(own[s:s + k]) in windows:
                    hit.update(range(s, s + k))
                    if item is not None:
                        ids.add(str(item))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


def found(spark, docs, items):
    left = spark.createDataFrame([(*r, "x", "y") for r in docs], SCHEMA).repartition(3)
    right = spark.createDataFrame([(*r, "z") for r in items], "item_id long, text string, doc_id string")
    return sorted((tuple(r) for r in decontaminate.report(left, right).collect()), key=repr)


def test_equals_brute_force_on_few_words(spark):
    """Texts over three words meet everywhere: ties, repeats and overlaps of hits."""
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choices(["of", "the", "Zé"], weights=[6, 2, 1], k=n))
    docs = [(i, text(rng.randrange(0, 60))) for i in range(60)]
    items = [(i, text(rng.randrange(8, 30))) for i in range(12)]
    got = found(spark, docs, items)
    assert got == brute(docs, items)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_equals_brute_force_on_passages(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(40)] + ["İ", "ÉCOLE", "10"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([1, 2, 4, 5, 9, 10, 11, 25, 40]))) for i in range(30)]
    items += [(30, items[12][1]), (30, items[12][1]), (31, None), (32, ""), (33, "!!"), (None, text(12))]
    docs = []
    for i in range(120):
        body = split(rng.choice(items)[1]) or ["x"]
        a = rng.randrange(len(body))
        docs.append((i, text(rng.randrange(30)) + ", " + " ".join(body[a:a + rng.randrange(1, 30)]).upper() + "; " + text(rng.randrange(30))))
    docs += [(200, None), (201, ""), (202, "..."), (203, text(5)), (204, items[-1][1]), (204, items[8][1]), (204, items[8][1]), (None, items[8][1]),
             (205, text(40_000) + " " + items[7][1])]
    assert found(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = [(1, "a b c d e f g h i j k"), (None, None)], [(1, "a b c d e f g h i j")]
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == brute(docs, [])
    assert found(spark, docs, [(1, None)]) == brute(docs, [])


def test_spans_and_clean_documents(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    docs = spark.createDataFrame([(1, f"a b {passage} c", "x", "y"), (2, "a b c", "x", "y"), (None, "d", "x", "y")], SCHEMA)
    items = spark.createDataFrame([(5, passage)], "item_id long, text string")
    row = decontaminate.contamination(docs, items).filter("doc_id = 1").first()
    covered = {s["start"] + k for s in row["spans"] for k in range(s["length"])}
    assert covered == set(range(2, 16)) and min(s["length"] for s in row["spans"]) >= 10 and row["items"] == ["5"]
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {2, None}


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a", "x", "y")], SCHEMA)
    plan = decontaminate.report(docs, spark.createDataFrame([(5, "a")], "item_id long, text string"))
    assert "Python" not in plan._jdf.queryExecution().toString()
