"""Typed reads and plain writes of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from invoicelake import schemas
from invoicelake.session import cut_lineage


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in a floating point column means "no value"."""
    floats = {name for name, kind in df.dtypes if kind in ("double", "float")}
    return df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in floats else F.col(c) for c in df.columns])


def read_typed(spark: SparkSession, path: str, schema: str, form: str = "parquet", **options: str) -> DataFrame:
    """Read with a declared schema; nothing is inferred."""
    return nan_to_null(spark.read.schema(schema).options(**options).format(form).load(path))


def read_csv_checked(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of CSV files: the lines that fit the declared schema, and ``line``, the text of all others.

    The files are read once. A line with too few or too many fields or a value that is not of its type goes to the quarantine as a whole.
    """
    checked = cut_lineage(read_typed(spark, path, f"{schema}, _line string", "csv", header="true", mode="PERMISSIVE", columnNameOfCorruptRecord="_line"))
    return checked.filter("_line IS NULL").drop("_line"), checked.filter("_line IS NOT NULL").select(F.col("_line").alias("line"))


def read_truth_csv(spark: SparkSession, path: str) -> DataFrame:
    """The answer key."""
    return read_typed(spark, path, schemas.TRUTH, "csv", header="true")


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def path_sql(spark: SparkSession, query: str, **paths: str) -> DataFrame:
    """SQL over tables named by their path: every ``{name}`` of the query is a Parquet folder."""
    return spark.sql(query, **{name: snapshot(spark, path) for name, path in paths.items()})


def write_partitioned(df: DataFrame, path: str, column: str = "ingest_date") -> None:
    """Create a table split by a date column.

    The rebalance hint brings the rows of a date together and lets adaptive execution split a date that is too
    large for one task.
    """
    df.hint("rebalance", column).write.partitionBy(column).parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Full rebuild; the schema may change."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)
