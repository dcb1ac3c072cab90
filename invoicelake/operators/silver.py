"""Cleansing: join the bronze tables, check the rows, split good from bad, release repaired rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.operators.merge import delete

PREVIEW_ROWS = 10


def ingested_only(documents: DataFrame) -> DataFrame:
    return documents.filter("status = 'INGESTED'")


def parse_date(column: str) -> Column:
    """Strict yyyy-MM-dd; anything else is NULL instead of an error."""
    return F.try_to_date(F.col(column), "yyyy-MM-dd")


def ingest_date(column: str = "ingested_at") -> Column:
    """Day of an ISO time stamp kept as text."""
    return F.try_to_date(F.substring(column, 1, 10))


def stamped(df: DataFrame, now: Column | None = None) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp() if now is None else now)


def join_bronze(extracted: DataFrame, documents: DataFrame, quality: DataFrame) -> DataFrame:
    """Extracted fields of ingested documents with file facts and, where measured, image quality."""
    files = ingested_only(documents).select("doc_id", "file_name", "sha256", ingest_date().alias("ingest_date"))
    measured = quality.select("doc_id", "skew_angle", "blur_score")
    joined = extracted.join(files, "doc_id").join(measured, "doc_id", "left")
    return joined.withColumn("invoice_date", parse_date("invoice_date"))


def with_reasons(rows: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Add dq_reasons: every broken rule in a fixed order, '' for a clean row."""
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    rules = {
        "missing_invoice_no": F.isnull("invoice_no"),
        "missing_vendor": F.isnull("vendor_id"),
        "bad_date": F.isnull("invoice_date"),
        "future_date": F.col("invoice_date") > today,
        "bad_total": ~F.coalesce(F.col("total") > 0, F.lit(False)),
    }
    broken = F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()])
    return rows.withColumn("dq_reasons", F.array_join(broken, ","))


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter("dq_reasons = ''").drop("dq_reasons")


def bad_rows(checked: DataFrame) -> DataFrame:
    return checked.filter("dq_reasons <> ''")


def release(quarantine: DataFrame, good: DataFrame, key: str = "doc_id") -> DataFrame:
    """Quarantine without the rows that pass now."""
    return delete(quarantine, good, key)


def preview(quarantine: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    return quarantine.select("file_name", "dq_reasons").orderBy("file_name").limit(rows)
