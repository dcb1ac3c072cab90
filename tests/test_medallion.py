from datetime import date

import pytest
from pyspark.sql import functions as F

from invoicelake import schemas
from invoicelake.operators import gold, silver
from invoicelake.plans.flow import Lake, ingest_folder, rebuild_gold, refresh_silver

DOC = "doc_id string, file_name string, sha256 string, ingested_at string, status string"


def extracted(spark, *rows):
    """(doc_id, invoice_no, invoice_date, vendor_id, total)"""
    data = [(d, n, day, "27G", v, f"Name {v}", 1.0, 1.0, 0.18, t, 90.0, "", 0) for d, n, day, v, t in rows]
    return spark.createDataFrame(data, schemas.EXTRACTED)


def documents(spark, *ids, status="INGESTED"):
    return spark.createDataFrame([(i, f"{i}.png", "s", "2026-01-02T03:04:05+00:00", status) for i in ids], DOC)


def quality(spark, *ids):
    return spark.createDataFrame([(i, 1.5, 200.0, "p") for i in ids], schemas.IMAGE_QUALITY)


def test_rules(spark):
    rows = extracted(spark, ("1", "N", "2026-01-01", "V", 5.0), ("2", None, "2026-02-30", None, None),
                     ("3", "N", "2027-01-01", "V", 0.0), ("4", "N", "bad", "V", -1.0), ("5", "N", "2026-01-01", "V", 5.0))
    joined = silver.join_bronze(rows, documents(spark, "1", "2", "3", "4"), quality(spark, "1"))
    checked = {r.doc_id: r for r in silver.with_reasons(joined, "2026-06-01").collect()}
    assert {k: r.dq_reasons for k, r in checked.items()} == {
        "1": "", "2": "missing_invoice_no,missing_vendor,bad_date,bad_total", "3": "future_date,bad_total",
        "4": "bad_date,bad_total"}
    assert checked["1"].skew_angle == 1.5 and checked["2"].skew_angle is None
    assert checked["1"].ingest_date == date(2026, 1, 2)


def test_only_ingested_documents_pass(spark):
    rows = extracted(spark, ("1", "N", "2026-01-01", "V", 5.0))
    assert silver.join_bronze(rows, documents(spark, "1", status="DUPLICATE_EXACT"), quality(spark)).count() == 0


def test_good_to_bad_and_back(spark, rows, tmp_path):
    lake = Lake(spark, str(tmp_path))
    docs, q = documents(spark, "1", "2"), quality(spark, "1", "2")
    refresh_silver(lake, extracted(spark, ("1", "N", "2026-01-01", "V", 5.0), ("2", None, "2026-01-01", "V", 5.0)), docs, q,
                   "2026-06-01")
    assert rows(lake.table("silver/invoices").read(), "doc_id") == [("1",)]
    assert rows(lake.table("silver/quarantine").read(), "doc_id") == [("2",)]
    refresh_silver(lake, extracted(spark, ("1", None, "2026-01-01", "V", 5.0), ("2", "M", "2026-01-01", "V", 5.0)), docs, q,
                   "2026-06-01")
    assert rows(lake.table("silver/invoices").read(), "doc_id", "invoice_no") == [("1", "N"), ("2", "M")]    # 1 stays
    assert rows(lake.table("silver/quarantine").read(), "doc_id", "dq_reasons") == [("1", "missing_invoice_no")]
    rebuild_gold(lake, "2026-01-01", "2026-12-31")
    monthly = spark.read.parquet(lake.gold("gold_vendor_monthly"))
    assert rows(monthly) == [("V", 2026, 1, 2, 10.0, 5.0)]
    assert spark.read.parquet(lake.gold("dim_date")).count() == 365


def test_vendor_ties_and_null_gstin(spark, rows):
    data = [("V1", "A", "g1"), ("V1", "A", "g2"), ("V2", "B", None), ("V2", "B", None), ("V2", "B", "g"), ("V3", "C", "g"),
            ("V3", "C", None)]
    df = spark.createDataFrame(data, "vendor_id string, vendor_name string, gstin string")
    assert rows(gold.dim_vendor(df)) == [("V1", "A", "g1"), ("V2", "B", None), ("V3", "C", None)]


def test_calendar(spark):
    days = gold.dim_date(spark)
    assert days.count() == 365
    r = days.filter("date_key = 20260704").first()
    assert (r.year, r.month, r.month_name, r.quarter, r.weekday) == (2026, 7, "July", 3, "Sat")


def test_monthly_drops_other_years_and_rounds_half_up(spark, rows):
    fact = spark.createDataFrame([("V", 20260101, 0.01), ("V", 20260131, 0.02), ("V", 20250101, 9.0)],
                                 "vendor_id string, date_key int, total double")
    assert rows(gold.vendor_monthly(fact, gold.dim_date(spark))) == [("V", 2026, 1, 2, 0.03, 0.02)]


def test_top_vendors(spark, rows):
    fact = spark.createDataFrame([(f"V{i}", float(i)) for i in range(7)] + [("V9", 6.0)], "vendor_id string, total double")
    names = spark.createDataFrame([(f"V{i}", f"N{i}") for i in range(10)], "vendor_id string, vendor_name string")
    assert [r.vendor_name for r in gold.top_vendors(fact, names).collect()] == ["N6", "N9", "N5", "N4", "N3"]


def test_ingest_folder_twice(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, data in [("a.png", b"1"), ("b.png", b"1"), ("c.pdf", b"2"), ("d.txt", b"3")]:
        (raw / name).write_bytes(data)
    lake = Lake(spark, str(tmp_path / "lake"))
    first = {r.status: r.n for r in ingest_folder(lake, str(raw), run_time="2026-01-02T03:04:05+00:00").collect()}
    assert first == {"INGESTED": 2, "DUPLICATE_EXACT": 1, "SKIPPED": 0, "FAILED": 0}
    landed = spark.read.parquet(f"{lake.root}/landing")
    assert sorted(bytes(r.content) for r in landed.collect()) == [b"1", b"2"]
    assert {str(r.ingest_date) for r in landed.collect()} == {"2026-01-02"}
    (raw / "e.png").write_bytes(b"2")
    second = {r.status: r.n for r in ingest_folder(lake, str(raw)).collect()}
    assert second == {"INGESTED": 0, "DUPLICATE_EXACT": 1, "SKIPPED": 3, "FAILED": 0}
    assert lake.table("bronze/documents").read().count() == 4


def test_preview(spark):
    bad = spark.createDataFrame([(f"{i:02d}.png", "bad_date") for i in range(15)], "file_name string, dq_reasons string")
    assert [r.file_name for r in silver.preview(bad).collect()] == [f"{i:02d}.png" for i in range(10)]


@pytest.mark.parametrize("text, day", [("2026-01-31", date(2026, 1, 31)), ("2026-13-45", None), (None, None), ("x", None)])
def test_parse_date(spark, text, day):
    df = spark.createDataFrame([(text,)], "d string").select(silver.parse_date("d"))
    assert df.first()[0] == day
    assert spark.range(1).select(F.lit(1)).count() == 1
