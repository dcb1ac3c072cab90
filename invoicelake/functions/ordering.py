"""Global order over distributed rows: prefix sums, ranks and top-k counts without a one-partition window.

Rows go to order-preserving buckets, each bucket is ordered on its own, and the totals of the buckets (a
row or two per task) carry the running sums across. Hot values cost nothing: numeric keys are
pre-aggregated to one row per distinct value, and ranks follow a uniform hash.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from invoicelake.session import cut_lineage

HASH_DIGITS = 3        # 16**3 = 4096 buckets for hashed keys


def _offsets(bucketed: DataFrame, sums: list[str]) -> DataFrame:
    """Running totals before each bucket; at most one row per bucket, so the plain window is bounded."""
    totals = bucketed.groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in sums])
    order = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_bucket", *[F.coalesce(F.sum(c).over(order), F.lit(0)).alias(f"_off_{c}") for c in sums])


def with_buckets(counts: DataFrame, key: str) -> DataFrame:
    """Add ``_bucket``: about equally filled ranges of a numeric key, the largest values first.

    There are two ranges per shuffle partition; equal keys always share one.
    """
    spark = counts.sparkSession
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), 16)
    cuts = counts.approxQuantile(key, [i / buckets for i in range(1, buckets)], 0.2 / buckets)
    splits = [-math.inf, *sorted({c for c in cuts if math.isfinite(c)}), math.inf]
    if len(splits) < 3:
        return counts.withColumn("_bucket", F.lit(0))
    ranges = Bucketizer(splits=splits, inputCol=key, outputCol="_range")
    return ranges.transform(counts).withColumn("_bucket", -F.col("_range").cast("int")).drop("_range")


def with_prefix(counts: DataFrame, key: str, sums: list[str]) -> DataFrame:
    """Add ``<c>_before`` for every column of ``sums``: its total over all rows with a larger key.

    ``counts`` holds one row per distinct numeric ``key`` (descending order, best score first). It is read
    several times: pass a table or a checkpoint.
    """
    bucketed = with_buckets(counts, key)
    before = Window.partitionBy("_bucket").orderBy(F.desc(key)).rowsBetween(Window.unboundedPreceding, -1)
    return (bucketed.join(F.broadcast(_offsets(bucketed, sums)), "_bucket")
            .select(*counts.columns,
                    *[(F.col(f"_off_{c}") + F.coalesce(F.sum(c).over(before), F.lit(0))).alias(f"{c}_before")
                      for c in sums]))


def seeded_hash(column: str | Column, seed: int | str) -> Column:
    """Uniform, engine-independent hash of a value: the same order on every cluster size."""
    value = F.col(column) if isinstance(column, str) else column
    return F.sha2(F.concat_ws("#", value.cast("string"), F.lit(str(seed))), 256)


def with_rank(df: DataFrame, hash_column: str, tie: str, name: str = "rank") -> DataFrame:
    """Number the rows from 1 in order of a hex hash; ``tie`` orders equal hashes."""
    bucketed = (df.withColumn("_bucket", F.substring(hash_column, 1, HASH_DIGITS))
                .withColumn("_one", F.lit(1).cast("long")))
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(hash_column, tie))
    return (bucketed.withColumn("_local", local).join(F.broadcast(_offsets(bucketed, ["_one"])), "_bucket")
            .select(*df.columns, (F.col("_off__one") + F.col("_local")).alias(name)))


def quantiles(df: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """One row with an array of exact, linearly interpolated quantiles; no task sees all values."""
    counts = (df.select(F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull())
              .groupBy("x").agg(F.count("*").alias("n")))
    counts = cut_lineage(counts)
    placed = with_prefix(counts, "x", ["n"]).withColumn("size", counts.agg(F.sum("n")).scalar())
    first = F.col("size") - F.col("n_before") - F.col("n")          # rows with a smaller value
    last = first + F.col("n") - 1

    def at(position: Column) -> Column:
        return F.max(F.when(position.between(first, last), F.col("x")))

    picks = []
    for q in shares:
        position = (F.col("size") - 1) * F.lit(float(q))
        picks += [at(F.floor(position)), at(F.ceil(position)), F.max(position - F.floor(position))]
    wide = placed.agg(*[p.alias(f"_{i}") for i, p in enumerate(picks)])
    return wide.select(F.array(*[F.col(f"_{3 * i}") + (F.col(f"_{3 * i + 1}") - F.col(f"_{3 * i}")) * F.col(f"_{3 * i + 2}")
                                 for i in range(len(shares))]).alias("q"))
