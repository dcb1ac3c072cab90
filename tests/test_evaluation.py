import pytest
from pyspark.sql import functions as F

from invoicelake import schemas
from invoicelake.operators import classify, evaluation, labels, splits


def extracted(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.EXTRACTED)


def row(doc, number="INV-2026-00001", day="2026-01-01", gstin="G", vendor="V", total=118.0, review=0, flags=""):
    return (doc, number, day, gstin, vendor, "Name", 1.0, 100.0, 18.0, total, 90.0, flags, review)


def truth(spark, *files):
    return spark.createDataFrame([(f, "INV-2026-00001", "V", "Name", "G", "2026-01-01", 100.0, 18.0, 118.0, 0, 0) for f in files],
                                 schemas.TRUTH)


def documents(spark, *ids):
    return spark.createDataFrame([(i, f"{i}.png") for i in ids], "doc_id string, file_name string")


def graded(spark):
    rows = extracted(spark, row("1"), row("2", number=None, review=1), row("3", total=118.005), row("4", total=None),
                     row("5", gstin="X", review=1), row("9"))
    return evaluation.with_truth(rows, documents(spark, *"12345"), truth(spark, *[f"{i}.png" for i in "12345"]))


def test_accuracy_and_mismatches(spark, rows):
    acc = {r.field: r.accuracy for r in evaluation.field_accuracy(graded(spark)).collect()}
    assert acc == {"invoice_no": 0.8, "invoice_date": 1.0, "gstin": 0.8, "vendor_id": 1.0, "subtotal": 1.0, "gst": 1.0, "total": 0.8}
    assert rows(evaluation.mismatch_counts(graded(spark))) == [("gstin", 1), ("invoice_no", 1), ("total", 1)]
    wrong = {r.field: (r.doc_id, r.found, r.expected) for r in evaluation.mismatch_examples(graded(spark)).collect()}
    assert wrong["gstin"] == ("5", "X", "G") and wrong["invoice_no"][1] is None


def test_straight_through(spark):
    r = evaluation.straight_through(graded(spark)).first()
    assert (r.documents, r.fully_correct, r.straight_through) == (5, 0.4, 0.6)
    assert r.auto_accuracy == pytest.approx(2 / 3)
    assert (r.sent_to_review, r.reviewed_wrong, r.unflagged_wrong) == (2, 2, 1)
    none = evaluation.straight_through(graded(spark).withColumn("needs_review", F.lit(1))).first()
    assert none.auto_accuracy is None and none.unflagged_wrong == 0


def test_null_against_null_is_wrong(spark):
    rows = extracted(spark, row("1", number=None))
    gt = truth(spark, "1.png").withColumn("invoice_no", F.lit(None).cast("string"))
    acc = {r.field: r.accuracy for r in evaluation.field_accuracy(evaluation.with_truth(rows, documents(spark, "1"), gt)).collect()}
    assert acc["invoice_no"] == 0.0


def test_flags_and_describe(spark, rows):
    df = extracted(spark, row("1", flags="a,b"), row("2", flags="a"), row("3"))
    assert [tuple(r) for r in evaluation.top_flags(df).collect()] == [("a", 2), ("", 1), ("b", 1)]
    numbers = spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4, 10)], "mean_conf double")
    r = evaluation.describe(numbers, "mean_conf").first()
    assert (r["count"], r.mean, r.std, r.min, r.p25, r.p50, r.p75, r.max) == (5.0, 4.0, 3.5, 1.0, 2.0, 3.0, 4.0, 10.0)
    ocr = spark.createDataFrame([("1", "t1"), ("2", "t2")], "doc_id string, text string")
    df = extracted(spark, row("2", review=1, flags="x"), row("1"))
    assert rows(evaluation.failing_example(df, ocr)) == [("2", "x", "t2")]
    assert evaluation.failing_example(extracted(spark, row("1")), ocr).count() == 0


def test_entities(spark, rows):
    data = [("1", 1, "INV_NO", "inv-2026 -00001"), ("1", 2, "TOTAL", "Rs 1.00"), ("1", 3, "TOTAL", "1,180.00"), ("1", 4, "GST", "1.2.3"),
            ("1", 5, "DATE", "2026-01-01"), ("1", 6, "DATE", "2027-01-01"), ("1", 7, "VENDOR", "Acme Lid"), ("2", 1, "VENDOR", "zzzz")]
    df = spark.createDataFrame(data, schemas.ENTITIES)
    master = spark.createDataFrame([("V1", "Acme Ltd")], "vendor_id string, vendor_name string")
    got = {r.doc_id: r for r in evaluation.normalise_entities(df, master).collect()}
    assert got["1"].invoice_no == "INV-2026-00001" and got["1"].total == 1180.0 and got["1"].gst is None
    assert got["1"].invoice_date == "2026-01-01" and got["1"].vendor_id == "V1" and got["2"].vendor_id is None


def test_model_comparison(spark):
    rules = extracted(spark, row("1", number=None), row("2")).select("doc_id", *evaluation.REQUIRED)
    other = extracted(spark, row("1"), row("2", gstin="X")).select("doc_id", *evaluation.REQUIRED)
    key = truth(spark, "1.png", "2.png").withColumn("doc_id", F.substring("file", 1, 1))
    table = evaluation.compare_models({"rules": rules, "other": other, "hybrid": evaluation.hybrid(rules, other)}, key)
    got = {r.model: (r.all_fields_correct, r.avg_field_accuracy) for r in table.collect()}
    assert got["rules"] == (0.5, pytest.approx(13 / 14)) and got["hybrid"] == (1.0, 1.0)


def test_ocr_reports(spark):
    key = truth(spark, "1.png")
    texts = spark.createDataFrame([("1.png", "dirty", "inv-2026- 00001 g"), ("1.png", "perfect", "INV-2026-00001 2026-01-01 G 118.00")],
                                  "file string, version string, text string")
    got = {r.version: r.overall for r in evaluation.ocr_versions(evaluation.ocr_contains(texts, key)).collect()}
    assert got == {"dirty": 0.5, "perfect": 1.0}
    many = truth(spark, *[f"{i}.png" for i in range(80)])
    assert evaluation.sample_files(many).count() == 50
    assert evaluation.sample_files(many).exceptAll(evaluation.sample_files(many.repartition(5))).count() == 0


def test_group_split_keeps_families_together(spark):
    data = [(f"d{i}", f"INV-{i}") for i in range(101)] + [(f"c{i}", f"INV-{i}-COPY") for i in range(0, 101, 3)]
    df = spark.createDataFrame(data, "doc_id string, invoice_no string")
    got = {r.doc_id: r.split for r in splits.group_split(df).collect()}
    assert sum(v == "test" for k, v in got.items() if k[0] == "d") == 20
    assert all(got[k] == got["d" + k[1:]] for k in got if k[0] == "c")
    assert got == {r.doc_id: r.split for r in splits.group_split(df.repartition(7)).collect()}


def test_three_way(spark):
    parts = splits.three_way(spark.range(300), "id").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in parts} == {"train": 210, "val": 45, "test": 45}


def test_spans(spark):
    text = "Acme INV-1 5.00 2026-01-01 G1 5.00 0.90 5.90"
    df = spark.createDataFrame([("1", text, "INV-1", "2026-01-01", "G1", "Acme", 5.0, 0.9, 5.9), ("2", "nothing", "INV-1", "2026-01-01", "G1", "Acme", 5.0, 0.9, 5.9)],
                               "doc_id string, text string, invoice_no string, invoice_date string, gstin string, vendor_name string, subtotal double, gst double, total double")
    found = labels.find_spans(df)
    spans = {s.label: text[s.s:s.e] for s in found.filter("doc_id = '1'").first().spans}
    assert spans == {"INV_NO": "INV-1", "DATE": "2026-01-01", "GSTIN": "G1", "VENDOR": "Acme", "SUBTOTAL": "5.00", "GST": "0.90", "TOTAL": "5.90"}
    assert [s.s for s in found.filter("doc_id = '1'").first().spans if s.label == "SUBTOTAL"] == [text.rindex("5.00")]
    kept = labels.resolve_overlaps(found)
    assert tuple(labels.completeness(kept).first()) == (1, 1)
    assert labels.require_examples(kept).count() == 1
    with pytest.raises(ValueError):
        labels.require_examples(kept.filter("doc_id = '2'"))


def test_overlapping_spans_keep_the_first(spark):
    df = spark.createDataFrame([("1", [(5, 9, "B"), (0, 6, "A"), (6, 8, "C"), (8, 9, "D")])],
                               "doc_id string, spans " + labels.SPANS)
    assert [s.label for s in labels.resolve_overlaps(df).first().spans] == ["A", "C", "D"]


def test_baseline_learns(spark):
    df = spark.range(300).select("id", (F.col("id") % 3).cast("int").alias("label"))
    df = df.withColumn("x", F.array(*[(F.col("label") == i).cast("double") + F.rand(i) * 0.1 for i in range(3)]))
    r = classify.baseline_scores(df, splits.three_way(df, "id"), "id", "x").first()
    assert r.acc == 1.0 and r.macro_f1 == 1.0 and r.condition == "all"


def test_entities_are_grouped_once(spark, monkeypatch):
    """The search gets stored fields: reading them twice must not group all entities twice."""
    plans = []
    whole = evaluation.match_vendors

    def watched(docs, header, master):
        plans.append(docs._jdf.queryExecution().optimizedPlan().toString())
        return whole(docs, header, master)
    monkeypatch.setattr(evaluation, "match_vendors", watched)
    entities = spark.createDataFrame([("a", 1, "VENDOR", "Acme Ltd"), ("a", 2, "INV_NO", "inv 1"), ("b", 1, "VENDOR", "Acne Ltd"), ("c", 1, "TOTAL", "5")],
                                     "doc_id string, pos long, label string, text string")
    master = spark.createDataFrame([("V1", "Acme Ltd")], "vendor_id string, vendor_name string")
    found = {r.doc_id: (r.vendor_id, r.invoice_no, r.total) for r in evaluation.normalise_entities(entities, master).collect()}
    assert found == {"a": ("V1", "INV1", None), "b": ("V1", None, None), "c": (None, None, 5.0)}
    assert len(plans) == 1 and "Aggregate" not in plans[0]
