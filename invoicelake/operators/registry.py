"""Registry of incoming files: what is new, what is an exact copy, what failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.session import cut_lineage
from invoicelake.sources.files import file_name_of, suffix_of, with_normal_path

STATUSES = ["INGESTED", "DUPLICATE_EXACT", "SKIPPED", "FAILED"]


def _instant(run_time: str | Column | None) -> Column:
    if run_time is None:
        return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.lit(run_time) if isinstance(run_time, str) else run_time


def skip_seen(prints: DataFrame, registry: DataFrame) -> DataFrame:
    """Drop files whose path and content are registered already.

    A known path with new content is a new document. Failed files do not count as seen, so they are tried again.
    """
    seen = (registry.filter("status <> 'FAILED'")
            .select(F.col("source_path").alias("path"), "sha256").distinct())
    return prints.join(seen, ["path", "sha256"], "left_anti")


def document_id(path: str, digest: str, run_time: Column) -> Column:
    """Repeatable id: a retried task gives the same one. A file without digest is told apart by the run."""
    return F.sha2(F.concat_ws("#", path, F.coalesce(F.col(digest), run_time)), 256)


def register(prints: DataFrame, registry: DataFrame, source: str = "scanner_folder",
             run_time: str | Column | None = None, landing: str = "bronze") -> DataFrame:
    """Registry rows of a batch of fingerprints (path, length, sha256, error_message).

    Within the batch the smallest path of equal contents is the original, unless the registry already holds
    an ingested one. The new rows are stored once: they are joined with the originals among themselves. Those
    are found by an aggregate that combines on the map side, so one content repeated in a third of all files
    costs one row per task.
    """
    now = _instant(run_time)
    fresh = cut_lineage(skip_seen(with_normal_path(prints), registry).withColumn("doc_id", document_id("path", "sha256", now)))
    stored = (registry.filter("status = 'INGESTED'").filter(F.col("sha256").isNotNull())
              .groupBy("sha256").agg(F.min("doc_id").alias("stored_id")))
    first = (fresh.filter(F.col("sha256").isNotNull())
             .groupBy("sha256").agg(F.min(F.struct("path", "doc_id")).alias("first")))
    originals = (first.join(stored, "sha256", "left")
                 .select("sha256", F.coalesce("stored_id", "first.doc_id").alias("original")))
    rows = fresh.join(originals, "sha256", "left")
    status = (F.when(F.col("sha256").isNull(), "FAILED")
              .when(F.col("original") == F.col("doc_id"), "INGESTED").otherwise("DUPLICATE_EXACT"))
    rows = rows.withColumn("status", status).withColumn("ingested_at", now)
    ingested = F.col("status") == "INGESTED"
    drawer = F.concat(F.lit(f"{landing}/ingest_date="), F.substring("ingested_at", 1, 10), F.lit("/"))
    return rows.select(
        "doc_id", file_name_of("path").alias("file_name"), F.col("path").alias("source_path"),
        F.when(ingested, F.concat(drawer, "doc_id", suffix_of("path"))).alias("bronze_path"), "sha256",
        F.col("length").alias("size_bytes"), F.lit(source).alias("source"), "ingested_at", "status",
        F.when(F.col("status") == "DUPLICATE_EXACT", F.col("original")).alias("duplicate_of"), "error_message")


def with_failures(registered: DataFrame, failures: DataFrame) -> DataFrame:
    """Rows whose bytes could not be kept (doc_id, error) become FAILED; they are tried again in the next run."""
    rows = registered.join(failures.select("doc_id", "error"), "doc_id", "left")
    failed = F.col("error").isNotNull()
    changed = {"status": F.when(failed, "FAILED").otherwise(F.col("status")), "bronze_path": F.when(~failed, F.col("bronze_path")),
               "error_message": F.coalesce("error", "error_message")}
    return rows.withColumns(changed).select(*registered.columns)


def run_counts(prints: DataFrame, registered: DataFrame) -> DataFrame:
    """(status, n) for all four statuses; a file that got no row was skipped."""
    by_status = registered.groupBy("status").agg(F.count("*").alias("n"))
    skipped = prints.agg(F.count("*").alias("files")).select(
        F.lit("SKIPPED").alias("status"),
        (F.col("files") - registered.agg(F.count("*")).scalar()).alias("n"))
    names = prints.sparkSession.createDataFrame([(s,) for s in STATUSES], "status string")
    found = by_status.unionByName(skipped)
    return names.join(found, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


def pending(registry: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ingested documents a later stage has not handled yet."""
    return registry.filter("status = 'INGESTED'").join(done.select(key), key, "left_anti")
