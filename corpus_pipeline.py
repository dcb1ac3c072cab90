"""From raw documents to packed training sequences: five stages, each written to the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from invoicelake.llm import decontaminate, exact_chunks, ngram_join, quality
from invoicelake.llm.common import documents, stored
from invoicelake.llm.queries import packed
from invoicelake.session import ship_package


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return exact_chunks.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near copies the smallest doc_id stays."""
    return ngram_join.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences; one row per piece."""
    return packed(docs)


STAGES = [("quality", quality_filter), ("exact_dedup", exact_dedup), ("ngram_join", near_dedup),
          ("decontaminate", decontamination), ("packing", packing)]

# the classifier is trained, so SQL cannot express the first stage; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
