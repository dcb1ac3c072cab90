"""End-to-end jobs: files to registry, text to star schema. Each stage is handed over as a stored table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from invoicelake.operators import extract, gold, registry, silver
from invoicelake.operators import images as image_work
from invoicelake.schemas import DOCUMENTS
from invoicelake.session import cut_lineage
from invoicelake.sources import files, tables
from invoicelake.sources.change_table import ChangeTable


@dataclass
class Lake:
    """Folders of one lake; every table below it keeps its history except the rebuilt gold tables."""

    spark: SparkSession
    root: str

    def table(self, name: str, key: str = "doc_id") -> ChangeTable:
        return ChangeTable(self.spark, f"{self.root}/{name}", key)

    def documents(self) -> ChangeTable:
        """The registry. A file that failed comes back under the same id when its content could be hashed, so rows may change."""
        return self.table("bronze/documents")

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def ingest_folder(lake: Lake, folder: str, source: str = "scanner_folder", run_time: str | None = None) -> DataFrame:
    """Register the files of a folder and keep the bytes of the new ones. Returns the counts per status."""
    listing = files.list_files(lake.spark, folder)
    prints = cut_lineage(files.fingerprint_files(listing))      # every file is read and hashed once
    rows = register_batch(lake, prints, source, run_time)
    return registry.run_counts(prints, rows)


def register_batch(lake: Lake, prints: DataFrame, source: str, run_time: str | None = None) -> DataFrame:
    """Registry rows of a batch: bytes are kept first, a file that cannot be read any more becomes FAILED, then the rows are merged."""
    known = lake.documents()
    seen = known.read() if known.version() >= 0 else lake.spark.createDataFrame([], DOCUMENTS)
    rows = cut_lineage(registry.register(prints, seen, source, run_time, f"{lake.root}/landing"))
    rows = cut_lineage(registry.with_failures(rows, files.land(rows, f"{lake.root}/landing")))
    known.merge(rows)
    return rows


def measure_pictures(lake: Lake, images: DataFrame) -> DataFrame:
    """The cleaning stage: measures the ingested pictures that have no quality row yet and adds these rows. ``images`` are decoded pictures
    by path. Returns the failures (doc_id, error)."""
    known = lake.documents().read()
    quality = lake.table("bronze/image_quality")
    done = quality.read().select("doc_id") if quality.version() >= 0 else lake.spark.createDataFrame([], "doc_id string")
    pictures = files.with_normal_path(images).join(known.select("doc_id", F.col("source_path").alias("path")), "path").drop("path")
    good, bad = image_work.quality_job(known, pictures, done)
    quality.merge(good, update=False)
    return bad


def load_bronze(lake: Lake, ocr: DataFrame, extracted: DataFrame) -> None:
    """OCR rows are added for new documents, extracted rows replace older ones."""
    lake.table("bronze/ocr").merge(ocr, update=False)
    lake.table("bronze/extracted").merge(extracted)


def rebuild_results(lake: Lake, suspected: DataFrame, scores: DataFrame) -> None:
    """The tables of suspected duplicate pairs and of anomaly scores, as of the last run."""
    tables.overwrite(suspected, f"{lake.root}/ml/suspected_duplicates")
    tables.overwrite(scores, f"{lake.root}/ml/anomaly_scores")


def refresh_silver(lake: Lake, extracted: DataFrame, documents: DataFrame, quality: DataFrame,
                   as_of: date | str | None = None) -> None:
    """Merge clean rows into invoices and the others into quarantine; rows that pass now leave quarantine.

    A row that was clean before and fails now is quarantined and stays in invoices as well.
    """
    joined = silver.stamped(silver.join_bronze(extracted, documents, quality))
    checked = cut_lineage(silver.with_reasons(joined, as_of))
    good = silver.good_rows(checked)
    lake.table("silver/invoices").merge(good)
    quarantine = lake.table("silver/quarantine")
    quarantine.merge(silver.bad_rows(checked))
    quarantine.delete(good)


def rebuild_gold(lake: Lake, start: date | str = gold.CALENDAR[0], end: date | str = gold.CALENDAR[1]) -> None:
    """Fact, dimensions and monthly totals from the current silver invoices."""
    invoices = lake.table("silver/invoices").read()
    tables.overwrite(gold.fact_invoices(invoices), lake.gold("fact_invoices"))
    tables.overwrite(gold.dim_vendor(invoices), lake.gold("dim_vendor"))
    tables.overwrite(gold.dim_date(lake.spark, start, end), lake.gold("dim_date"))
    fact, calendar = (tables.snapshot(lake.spark, lake.gold(t)) for t in ("fact_invoices", "dim_date"))
    tables.overwrite(gold.vendor_monthly(fact, calendar), lake.gold("gold_vendor_monthly"))


def spend_report(ocr: DataFrame, master: DataFrame, documents: DataFrame, quality: DataFrame,
                 as_of: date | str | None = None) -> DataFrame:
    """OCR text to the top vendors. The clean rows feed two aggregates, so they are stored once."""
    fields = extract.records(ocr, master)
    good = cut_lineage(silver.good_rows(silver.with_reasons(silver.join_bronze(fields, documents, quality), as_of)))
    return gold.top_vendors(gold.fact_invoices(good), gold.dim_vendor(good))
