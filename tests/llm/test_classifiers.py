import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from invoicelake.llm import common, labelled, quality, toxicity

SCHEMA = "doc_id long, text string, lang string, score string, label string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "en", "clash", "clash") for r in rows], SCHEMA).repartition(3)


def marked(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def sample(seed=1, size=400):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(size):
        words, bad, toxic = rng.choices(vocabulary, k=rng.randrange(5, 60)), i % 4 == 0, i % 5 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["nasty", "NASTY", "nastyer", "nastyly"]))
        text = " ".join(words)
        docs.append((i, text.replace(" ", "*** ") if bad and i % 8 else " ".join(w for w in words for _ in range(6)) if bad else text))
        labels.append((i, int(not bad), int(toxic), "clash"))
    return docs, labels


EDGES = [(9001, None), (9002, ""), (9003, " \n"), (9004, "word1 " * 200_000), (9004, "word1 " * 200_000), (None, "word2"), (9005, "x" * 3_000_000)]


@pytest.mark.parametrize("model, column", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy_and_edges(spark, model, column):
    docs, labels = sample()
    labels += [(9001, 1, 0, ""), (9002, None, None, ""), (None, 1, 1, ""), (77_777, 1, 1, "")]
    out = model.classify(table(spark, docs + EDGES), marked(spark, labels)).collect()
    assert len(out) == len(docs) + len(EDGES)
    truth = {r[0]: r[1 if column == "quality" else 2] for r in labels[:len(docs)]}
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= model.CUT)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    unseen = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in unseen) >= 0.95 * len(unseen) and len(unseen) > 50
    assert np.ptp([r["score"] for r in out if r["doc_id"] == 9004]) < 1e-4


@pytest.mark.parametrize("model", [quality, toxicity])
def test_held_out_labels_ids_and_language_do_not_matter(spark, model):
    docs, labels = sample(size=120)
    flipped = [(i, 1 - q, 1 - t, s) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t, s) for i, q, t, s in labels]
    plain = {r["doc_id"]: r["score"] for r in model.classify(table(spark, docs), marked(spark, labels)).collect()}
    other = {r["doc_id"]: r["score"] for r in model.classify(table(spark, docs), marked(spark, flipped)).collect()}
    assert plain == other
    again = docs + [(50_000 + i, t) for i, t in docs[:20]]
    scores = {r["doc_id"]: r["score"] for r in model.classify(table(spark, again), marked(spark, labels)).collect()}
    assert all(abs(scores[i] - scores[50_000 + i]) < 1e-4 for i in range(20))  # single precision, other blocks


@pytest.mark.parametrize("model", [quality, toxicity])
def test_without_labels_or_rows(spark, model):
    docs, _ = sample(size=10)
    assert {r["score"] for r in model.classify(table(spark, docs), marked(spark, [])).collect()} == {0.5}
    one = {r["score"] for r in model.classify(table(spark, docs), marked(spark, [(i, 1, 1, "") for i in range(10)])).collect()}
    assert len(one) == 1 and one.pop() > 0.9
    assert model.classify(table(spark, []), marked(spark, [])).count() == 0


def test_rejected_documents_go(spark):
    docs, labels = sample()
    frame = table(spark, docs)
    kept = quality.accepted(frame, marked(spark, labels))
    assert kept.columns == frame.columns
    good = {i for i, q, _, _ in labels if q}
    ids = {r["doc_id"] for r in kept.collect()}
    assert len(ids & good) >= 0.98 * len(good) and len(ids - good) <= 0.05 * len(good)


def test_sample_is_bounded_and_weighted(spark):
    rows = marked(spark, [(i, int(i % 10 != 0), 0, "") for i in range(20_000)])
    ids = labelled.training_ids(rows, "quality", most=600).toPandas()
    assert 480 < len(ids) < 720 and 200 < (ids["label"] == 0).sum() < 400
    assert abs(ids["weight"].sum() - 16_000) < 2_500


def test_dual_descent_separates_and_holds_its_box():
    rng = np.random.default_rng(0)
    rows = [rng.choice(200, 20, replace=False) + 200 * (i % 2) for i in range(60)]
    signs = np.array([1.0, -1.0] * 30)
    weights, bias = quality._descend(rows, signs, np.ones(quality.CELLS), np.full(60, 10.0), 50, 0)
    margins = np.array([weights[r].sum() / np.sqrt(20) + bias for r in rows])
    assert (margins * signs > 0.9).all()


def test_pieces_of_long_texts_change_nothing(monkeypatch):
    data = pa.array(["one two  three " * 50, "", "x" * 900, "é ü ö " * 40])
    bytes_, offsets = common.byte_rows(data)
    codes, counts = common.word_codes(bytes_, offsets, quality._WORD, (2, 3))
    whole = [set(found.tolist()) for found in quality._rows(data)]
    monkeypatch.setattr(common, "PIECE_BYTES", 32)
    monkeypatch.setattr(quality, "_LONG", 64)
    cut, again = common.word_codes(bytes_, offsets, quality._WORD, (2, 3))
    assert (codes == cut).all() and (counts == again).all() and counts.tolist() == [150, 0, 1, 120]
    assert [set(found.tolist()) for found in quality._rows(data)] == whole


def test_pooling_in_blocks_changes_nothing(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 1 << toxicity.BITS, (n, 1 + len(toxicity.PREFIXES))).astype(np.int32) for n in (40, 0, 1, 2, 300)]
    net = toxicity._initial([np.concatenate(texts)] * 5, 0)
    net.bias[:] = rng.normal(0, 0.1, len(net.bias))
    words, counts = net.row[np.concatenate(texts)], np.array([len(t) for t in texts])
    whole = net.pooled(words, counts)
    for k, text in enumerate(texts):
        vectors = net.words(net.row[text])
        for i, width in enumerate(toxicity.WIDTHS):
            answers = [sum(vectors[p + j] @ net.filters[i][j] for j in range(width)) for p in range(len(text) - width + 1)]
            best = np.max([np.zeros(toxicity.FILTERS), *(a + net.bias[i * toxicity.FILTERS:(i + 1) * toxicity.FILTERS] for a in answers)], axis=0)
            assert np.allclose(whole[k, i * toxicity.FILTERS:(i + 1) * toxicity.FILTERS], best, atol=1e-5)
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 16)
    assert np.allclose(net.pooled(words, counts), whole, atol=1e-6)


def small_network(rng, words=30):
    """A network in double precision over ``words`` rows, row 0 being the rare word."""
    embedding = rng.normal(0, 0.5, (words, toxicity.DIMENSION))
    embedding[0] = 0
    filters = [rng.normal(0, 0.5, (w, toxicity.DIMENSION, toxicity.FILTERS)) for w in toxicity.WIDTHS]
    size = toxicity.FILTERS * len(toxicity.WIDTHS)
    return toxicity.Network(np.arange(words), embedding, filters, rng.normal(0, 0.1, size), rng.normal(0, 0.5, size), 0.2)


def plain_loss(net, texts, labels, weights, kept):
    """The loss of a batch, word by word and filter by filter."""
    total = 0.0
    for r, text in enumerate(texts):
        vectors = [sum(net.embedding[row] for row in word) for word in text]
        margin = net.offset
        for i, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                best, cell = 0.0, i * toxicity.FILTERS + f
                for p in range(len(text) - width + 1):
                    best = max(best, net.bias[cell] + sum(float(vectors[p + j] @ net.filters[i][j][:, f]) for j in range(width)))
                margin += best * kept[r, cell] * net.output[cell]
        total += weights[r] * (math.log1p(math.exp(-abs(margin))) + max(margin, 0) - labels[r] * margin) / len(texts)
    return total + 0.5e-4 * float(net.output @ net.output)


def test_one_gradient_step_against_a_plain_loop(monkeypatch):
    rng = np.random.default_rng(5)
    net = small_network(rng)
    texts = [rng.integers(1, 30, (n, 1 + len(toxicity.PREFIXES))) for n in (0, 1, 2, 5, 11)]
    labels, weights, kept = np.array([0, 1, 1, 0, 1]), rng.random(5) + 0.5, (rng.random((5, len(net.bias))) < 0.8) / 0.8
    lengths = np.array([len(t) for t in texts])
    grid = np.zeros((5, 11 + max(toxicity.WIDTHS) - 1, 1 + len(toxicity.PREFIXES)), np.int32)
    for r, text in enumerate(texts):
        grid[r, :len(text)] = text
    whole = toxicity._gradient(net, grid, lengths, labels, weights, kept)
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 15)  # three words of each text at a time
    slopes, offset = toxicity._gradient(net, grid, lengths, labels, weights, kept)
    assert all(np.allclose(slopes[k], whole[0][k], atol=1e-12) for k in slopes)
    step = 1e-6

    def numerical(array, cell):
        held, ends = array[cell], []
        for sign in (1, -1):
            array[cell] = held + sign * step
            ends.append(plain_loss(net, texts, labels, weights, kept))
        array[cell] = held
        return (ends[0] - ends[1]) / 2 / step
    for name, array in net.parameters().items():
        cells = [tuple(int(rng.integers(0 if k else name == "embedding", n)) for k, n in enumerate(array.shape)) for _ in range(25)]
        assert all(abs(slopes[name][cell] - numerical(array, cell)) < 1e-6 for cell in cells), name
    net.offset += step
    up = plain_loss(net, texts, labels, weights, kept)
    net.offset -= 2 * step
    assert abs(offset - (up - plain_loss(net, texts, labels, weights, kept)) / 2 / step) < 1e-6


def test_training_holds_one_batch_beside_the_sample():
    rng = np.random.default_rng(2)
    lengths = [*rng.integers(5, 60, 64).tolist(), 1_000_000]
    texts = [rng.integers(0, 1 << toxicity.BITS, (n, 1 + len(toxicity.PREFIXES))).astype(np.int32) for n in lengths]
    tracemalloc.start()
    toxicity._train(texts, np.arange(len(texts)) % 2, rounds=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * texts[-1].nbytes  # the features of the text are 16 MB; all its answers at once would be 250
    groups = toxicity._batches(np.array(lengths), 32)
    assert sorted(np.concatenate(groups).tolist()) == list(range(len(texts))) and [len(g) for g in groups] == [32, 32, 1]


def test_ratios_and_dual_descent_against_plain_solvers():
    rng = np.random.default_rng(9)
    rows, labels = [rng.choice(40, 8, replace=False) for _ in range(14)], np.array([0, 1] * 7)
    scale = quality._ratios(rows, labels)
    counts = [[1.0] * quality.CELLS, [1.0] * quality.CELLS]
    for row, label in zip(rows, labels):
        for cell in row:
            counts[label][cell] += 1
    for cell in range(45):
        assert abs(scale[cell] - math.log(counts[1][cell] / sum(counts[1]) / (counts[0][cell] / sum(counts[0])))) < 1e-9
    signs, cost = np.where(labels == 1, 1.0, -1.0), np.full(14, 0.7)
    x = np.zeros((14, 41))
    for k, row in enumerate(rows):
        x[k, row] = scale[row] / np.sqrt(np.square(scale[row]).sum())
    x[:, 40] = 1  # the bias
    gram = (signs[:, None] * x) @ (signs[:, None] * x).T
    alpha = np.zeros(14)
    for _ in range(200_000):
        alpha = np.clip(alpha - (gram @ alpha - 1) / 30, 0, cost)
    want = (alpha * signs) @ x
    weights, bias = quality._descend(rows, signs, scale, cost, 2_000, 0)
    assert np.allclose(weights[:40], want[:40], atol=0.01) and abs(bias - want[40]) < 0.01


def test_toxicity_trains_on_all_labelled_rows(spark, monkeypatch):
    docs, labels = [(i, f"common {'nasty' if i % 4 == 0 else 'word'} {i % 7}") for i in range(1_200)], [(i, 1, int(i % 4 == 0), "") for i in range(1_200)]
    seen, fresh = [], toxicity._fresh
    monkeypatch.setattr(toxicity, "_fresh", lambda counts, seed: seen.append(counts) or fresh(counts, seed))
    for name, value in (("DRIVER_ROWS", 40), ("PART_ROWS", 500), ("ROUNDS", 1)):
        monkeypatch.setattr(toxicity, name, value)
    model = toxicity.fit(table(spark, docs + docs[:50]), marked(spark, labels))
    trained = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(1_200))
    assert [counts.max() for counts in seen][-1] == trained and seen[0].max() + seen[1].max() == trained
    assert np.abs(model.network.embedding - fresh(seen[-1], 2).embedding).max() > 0.05 and model.thresholds.keys() == {"", "en"}


def test_calibration_and_thresholds_of_rows_equal_those_in_memory(spark):
    rng = np.random.default_rng(4)
    labels = (rng.random(900) < 0.3).astype(int)
    margins, langs = np.round(rng.normal(labels * 1.5 - 0.5, 1.0), 1), np.where(rng.random(900) < 0.6, "en", np.where(rng.random(900) < 0.9, "de", ""))
    rows = spark.createDataFrame([(str(g), int(y), float(m)) for g, y, m in zip(langs, labels, margins)], "lang string, label int, margin double").repartition(3).cache()
    slope, offset = labelled.platt(margins, labels.astype(float), np.ones(900))
    assert np.allclose(labelled.platt_of_rows(rows), (slope, offset), atol=1e-6)
    scores = labelled.logistic(margins)
    found = toxicity._thresholds(spark.createDataFrame([(str(g), int(y), float(s)) for g, y, s in zip(langs, labels, scores)], "lang string, label int, score double"), 30)
    want = {"": toxicity._threshold(scores, labels, np.ones(900))}
    want |= {g: toxicity._threshold(scores[langs == g], labels[langs == g], np.ones((langs == g).sum())) for g in ("en", "de")}
    assert found.keys() == want.keys() and all(abs(found[g] - want[g]) < 1e-9 for g in want)


def test_sieve_keeps_every_named_row_and_few_others(spark, monkeypatch):
    docs, ids = spark.range(-10_000, 20_000).toDF("doc_id"), spark.range(-10_000, 20_000, 7).toDF("doc_id")
    left = {r["doc_id"] for r in labelled.sieved(docs, ids).collect()}
    assert left >= set(range(-10_000, 20_000, 7)) and len(left) < 1.15 * 4_286
    assert labelled.sieved(docs, ids.filter("doc_id = 5")).count() == 0
    monkeypatch.setattr(labelled, "SIEVE_BITS", (4, 4))
    assert {r["doc_id"] for r in labelled.sieved(docs, ids).collect()} >= set(range(-10_000, 20_000, 7))


@pytest.mark.parametrize("bits", [(10, 27), (4, 4)])
def test_labelled_texts_move_once_and_without_a_join(spark, monkeypatch, capsys, bits):
    docs = [(i, None if i == 3 else f"word{i % 9} nasty" * (i % 5)) for i in range(600)] + [(8, "other"), (8, "a copy"), (None, "no id"), (9001, "no label")]
    labels = [(i, 1, int(i % 4 == 0), "") for i in range(0, 600, 2)] + [(8, 1, 1, ""), (12, 1, 2, ""), (None, 1, 1, ""), (7_777, 1, 1, "")]
    for module, name, value in ((toxicity, "DRIVER_ROWS", 40), (toxicity, "PART_ROWS", 100), (labelled, "SIEVE_BITS", bits)):
        monkeypatch.setattr(module, name, value)
    rows, store = [], toxicity.stored

    def seen(df, name, *how):
        if name == "labelled":
            df.explain()
            rows.extend(df.collect())
        return store(df, name, *how)
    monkeypatch.setattr(toxicity, "stored", seen)
    monkeypatch.setattr(toxicity, "_fit_parts", lambda found, *_: found.count())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with more labels than Spark sends around
    try:
        count = toxicity.fit(spark.createDataFrame([(*r, "en", "", "") for r in docs], SCHEMA), marked(spark, labels))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "Join" not in plan
    want = {i: int(i % 4 == 0) for i in range(0, 600, 2) if zlib.crc32(str(i).encode()) % 5}
    assert {r["doc_id"]: r["label"] for r in rows} == want and len(rows) == count == len(want)
    of = {r["doc_id"]: len(r["features"]) for r in rows}
    assert all(n == 8 * len(set(t for d, t in docs if d == i).pop().split()) for i, n in of.items() if i not in (8, 3))


def test_features_of_batches_cut_anywhere():
    schema = pa.schema([("part", pa.int32()), ("fold", pa.int32()), ("doc_id", pa.int64()), ("label", pa.int32()), ("lang", pa.string()), ("text", pa.string())])
    cells = [(1, None, "no label"), (2, 1, None), (2, None, "one two"), (2, None, "its copy"), (3, 0, None), (4, 1, None), (4, None, None), (0, None, "no label"), (0, 0, None)]
    rows = [{"part": 0, "fold": 1, "doc_id": i, "label": y, "lang": "en", "text": t} for i, y, t in cells]
    for size in (1, 2, 3, 9):
        batches = [pa.RecordBatch.from_pylist(rows[i:i + size], schema) for i in range(0, 9, size)] + [pa.RecordBatch.from_pylist([], schema)]
        out = pa.Table.from_batches(toxicity._feature_batches(iter(batches)))
        assert [(r["doc_id"], r["label"], len(r["features"])) for r in out.to_pylist()] == [(2, 1, 16), (4, 1, 0)]


def test_a_round_sends_packed_sums_and_takes_their_means(spark, monkeypatch):
    rng = np.random.default_rng(6)
    values = np.append(rng.integers(-40_000, 40_000, 16_998), [-2**63, 2**63 - 1])
    assert (toxicity._unpacked(toxicity._packed(values), len(values)) == values).all()
    assert len(toxicity._packed(values[:16_000])) < 3 * 16_000 and len(toxicity._packed(np.zeros(17_000, np.int64))) < 200
    monkeypatch.setattr(toxicity, "BLOCK_CELLS", 64)
    texts = [rng.choice(400, (int(n), 1 + len(toxicity.PREFIXES))).astype(np.uint16) for n in rng.integers(0, 30, 240)]
    label, fold, part = rng.integers(0, 2, 240), np.arange(240) % 2, np.arange(240) // 80
    net = toxicity._initial(texts, 0)
    rows = [(int(part[i]), int(fold[i]), i, int(label[i]), "en", texts[i].tobytes()) for i in range(240)]
    frame = spark.createDataFrame(rows, "part int, fold int, doc_id long, label int, lang string, features binary").repartitionById(2, "part").sortWithinPartitions("part", "doc_id")
    got = toxicity._averaged_round(frame, net, 1, 0.4, 0, 2)
    moves = []
    for p in range(3):
        own = np.flatnonzero((part == p) & (fold != 1))
        y = label[own]
        after = toxicity._round(net, [texts[i] for i in own], y, toxicity._balance(y, 0.4), np.random.default_rng([1, 0, p]), 0.01)
        moves.append(np.rint((toxicity._cells(after) - toxicity._cells(net)) * toxicity.FIXED).astype(np.int64))
    parts = np.sum([m.any(axis=1) for m in moves], axis=0)
    want = toxicity._cells(net) + (np.sum(moves, axis=0) / np.maximum(parts, 1)[:, None] / toxicity.FIXED)
    assert np.allclose(toxicity._cells(got), want, atol=1e-6) and np.abs(want - toxicity._cells(net)).max() > 0.01
