"""From files on disk to the star schema, twice with the same result."""

import numpy as np
from pyspark.sql import functions as F

from invoicelake.operators import extract
from invoicelake.plans.flow import Lake, ingest_folder, load_bronze, measure_pictures, rebuild_gold, rebuild_results, refresh_silver
from invoicelake.sources import files, tables
from tests.pictures import png

TEXT = ("{vendor} TAX INVOICE\nInvoice No: INV-2026-{n:05d}\nDate: 2026-02-0{day}\nGSTIN: 27ABCDE1234F1Z5\n"
        "Subtotal: 1000.00\nGST: 180.00\nTotal: 1180.00")


def run(lake, folder):
    spark = lake.spark
    counts = {r.status: r.n for r in ingest_folder(lake, folder, run_time="2026-03-04T05:06:07+00:00").collect()}
    failures = measure_pictures(lake, files.read_images(spark, folder)).count()
    documents = lake.documents().read()
    ingested = documents.filter("status = 'INGESTED'").select("doc_id", "file_name").collect()
    texts = [(r.doc_id, TEXT.format(vendor=("Acme Ltd", "Bolt Co")[int(r.file_name[1]) % 2], n=int(r.file_name[1]), day=1 + int(r.file_name[1])), 90.0)
             for r in ingested]
    ocr = spark.createDataFrame(texts, "doc_id string, text string, mean_conf double")
    master = spark.createDataFrame([("V1", "Acme Ltd"), ("V2", "Bolt Co")], "vendor_id string, vendor_name string")
    load_bronze(lake, ocr, extract.records(ocr, master))
    refresh_silver(lake, lake.table("bronze/extracted").read(), documents, lake.table("bronze/image_quality").read(), as_of="2026-06-01")
    rebuild_gold(lake, "2026-01-01", "2026-12-31")
    scores = lake.table("silver/invoices").read().select("doc_id", "total")
    rebuild_results(lake, scores.select(F.col("doc_id").alias("doc_a"), F.col("doc_id").alias("doc_b")), scores)
    read = lambda name: sorted(tuple(r) for r in tables.snapshot(spark, f"{lake.root}/{name}").collect())
    return counts, failures, [read(f"gold/{t}") for t in ("fact_invoices", "dim_vendor", "gold_vendor_monthly")] + [read("ml/anomaly_scores")]


def test_two_runs_give_equal_tables(spark, tmp_path):
    folder = tmp_path / "scans"
    folder.mkdir()
    random = np.random.default_rng(0)
    for k in range(4):
        (folder / f"p{k}.png").write_bytes(png(random.integers(0, 256, (20, 30), dtype=np.uint8)))
    lake = Lake(spark, str(tmp_path / "lake"))
    (folder / "p5.png").write_bytes((folder / "p1.png").read_bytes())
    first, failures, gold = run(lake, str(folder))
    assert first == {"INGESTED": 4, "DUPLICATE_EXACT": 1, "SKIPPED": 0, "FAILED": 0} and failures == 0
    assert len(gold[0]) == 4 and len(gold[1]) == 2
    second, _, again = run(lake, str(folder))
    assert second == {"INGESTED": 0, "DUPLICATE_EXACT": 0, "SKIPPED": 5, "FAILED": 0}
    assert again == gold
    assert lake.table("bronze/image_quality").read().count() == 4
