"""The registry of files as a table split by the first digits of the content digest.

A file is known by its digest, so a batch can only meet rows whose digest begins like one of its own. ``touched`` reads just those
partitions: a small batch neither scans nor shuffles the registry of all files ever seen. Rows without a digest (files that could
not be read) share a partition of their own; they are neither seen nor originals, so no batch needs them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from invoicelake.schemas import DOCUMENTS

DIGITS = 2  # 16**DIGITS partitions; also the bound on the prefixes that reach the driver
UNREAD = "none"


def prefix(digits: int = DIGITS) -> Column:
    return F.coalesce(F.substring("sha256", 1, digits), F.lit(UNREAD)).alias("prefix")


def append(rows: DataFrame, path: str, digits: int = DIGITS) -> None:
    """Add registry rows. The rebalance hint brings a prefix together, one file per batch and prefix unless it is large."""
    rows.select("*", prefix(digits)).hint("rebalance", "prefix").write.mode("append").partitionBy("prefix").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their ``prefix``. The schema is declared: digits must not be read as numbers."""
    return spark.read.schema(f"{DOCUMENTS}, prefix string").parquet(path)


def touched(spark: SparkSession, path: str, prints: DataFrame, digits: int = DIGITS) -> DataFrame:
    """The rows that a batch of fingerprints can meet, in place of the whole registry: same answers, only the batch's partitions are read."""
    own = prints.filter(F.col("sha256").isNotNull()).select(prefix(digits)).distinct()
    found = sorted(row["prefix"] for row in own.collect())  # at most 16**digits
    return read(spark, path).filter(F.col("prefix").isin(found)).drop("prefix")
