import random

import corpus_pipeline
from invoicelake.llm import decontaminate, exact_chunks, ngram_join, quality
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_exact_chunks import brute as equal_texts
from tests.llm.test_ngram_join import brute as near_texts


def folder(spark, tmp_path):
    rng = random.Random(6)
    vocabulary = [f"word{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    docs, labels = [], []
    for i in range(240):
        body = text(rng.randrange(20, 80))
        docs.append((i, body if i % 6 else body.replace(" ", "*** ")))
        labels.append((i, int(i % 6 != 0), 0))
    docs += [(300 + i, docs[i][1].replace(" ", "\n\t")) for i in range(0, 240, 9)]
    docs += [(1000 + i, docs[i][1] + " more") for i in range(1, 240, 11)]
    passage = text(25)
    docs += [(500 + i, f"{text(20)} {passage} {text(5)}") for i in range(6)] + [(600, ""), (601, None)]
    root = str(tmp_path)
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, text(30))], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, dict(docs), [(1, passage)]


def test_stages_against_brute_force(spark, tmp_path):
    root, texts, items = folder(spark, tmp_path)
    docs = spark.read.parquet(f"{root}/documents.parquet")
    labels = spark.read.parquet(f"{root}/labels.parquet")
    accepted = {r["doc_id"] for r in quality.classify(docs, labels).collect() if r["predicted"] == 1}
    kept = [accepted]
    for decide in (lambda rows: {r[0] for r in equal_texts(rows) if r[3]}, lambda rows: {r[0] for r in near_texts(rows) if r[2] == r[0]},
                   lambda rows: {r[0] for r in contaminated(rows, items) if not r[5]}):
        kept.append(decide([(i, texts[i]) for i in sorted(kept[-1])]))
    assert [len(k) for k in kept] == sorted({len(k) for k in kept}, reverse=True)  # every stage drops something
    for (name, stage), want in zip(corpus_pipeline.STAGES[:4], kept):
        out = corpus_pipeline.stored(stage(spark, docs, root), name)
        assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == sorted(want)
        docs = out
    final = corpus_pipeline.run(spark, root)
    assert {r["doc_id"] for r in final.select("doc_id").distinct().collect()} == kept[-1]


def test_empty_documents(spark, tmp_path):
    root, _, _ = folder(spark, tmp_path)
    docs = spark.read.parquet(f"{root}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, root), name)
        assert docs.count() == 0


def test_every_row_has_its_own_verdict(spark, tmp_path):
    """Rows without an id, ids shared by different texts, equal rows, and clashing column names."""
    rng = random.Random(8)
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    a, b, c, d, passage = (text(40) for _ in range(5))
    rows = [(None, a), (None, a), (7, b), (7, c), (8, b), (9, d), (9, d), (9, f"{text(10)} {passage} {text(10)}"), (None, f"{passage} x"), (10, text(30)),
            (None, c + " more"), (11, None), (11, ""), (None, None)]
    root = str(tmp_path)
    schema = "doc_id long, text string, __row int, __gone int, __score int"
    spark.createDataFrame([(*r, k, k, k) for k, r in enumerate(rows)], schema).repartition(3).write.parquet(f"{root}/rows")
    docs = spark.read.parquet(f"{root}/rows")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")

    def left(df):
        assert df.columns == docs.columns
        return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    once = [(None, a), (7, b), (7, c), (9, d), rows[7], rows[8], rows[9], rows[10], (11, rows[11][1])]
    got = left(exact_chunks.deduplicated(docs))
    assert [r for r in got if r[1]] == sorted([r for r in once if r[1]], key=repr) and sum(not r[1] for r in got) == 1
    near = [r for r in once[:-1] if r != rows[10]] + [(11, None), (11, ""), (None, None)]
    assert left(ngram_join.one_per_group(docs)) == sorted(near, key=repr)
    assert left(decontaminate.clean(docs, items)) == sorted([r for r in rows if passage not in (r[1] or "")], key=repr)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(7, 12)], "doc_id long, quality int, toxic int")
    assert quality.accepted(docs, labels, 0.0).count() == len(rows)
