"""Exact medians of large groups.

The built-in median keeps every distinct value of a group in one buffer. Here a group is first counted per
value cell, the cells that hold the middle positions are picked, and only those cells are ordered, so a
vendor with a third of all rows stays spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from invoicelake.session import cut_lineage

CELLS_PER_UNIT = 64


def value_counts(df: DataFrame, key: str, value: str, weight: str | None = None) -> DataFrame:
    """(key, x, n): every value of a group once, stored, because a median reads it twice."""
    n = F.count("*") if weight is None else F.sum(weight)
    return cut_lineage(df.select(key, F.col(value).alias("x"), *([weight] if weight else []))
                       .filter(F.col("x").isNotNull()).groupBy(key, "x").agg(n.alias("n")))


def group_median(values: DataFrame, key: str, name: str = "median", cells_per_unit: int = CELLS_PER_UNIT) -> DataFrame:
    """(key, median) from ``value_counts``, with the mean of the two middle values for even counts."""
    counts = values.withColumn("cell", F.floor(F.col("x") * cells_per_unit))
    cells = counts.groupBy(key, "cell").agg(F.sum("n").alias("cell_n"))
    in_group = Window.partitionBy(key)
    upto = in_group.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = (cells.withColumn("upto", F.sum("cell_n").over(upto)).withColumn("size", F.sum("cell_n").over(in_group))
              .withColumn("low", F.floor((F.col("size") + 1) / 2)).withColumn("high", F.floor(F.col("size") / 2) + 1)
              .withColumn("skip", F.col("upto") - F.col("cell_n"))
              .filter((F.col("skip") < F.col("high")) & (F.col("upto") >= F.col("low")))
              .select(key, "cell", "skip", "low", "high"))
    inside = Window.partitionBy(key, "cell").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (counts.join(middle, [key, "cell"])
            .withColumn("last", F.col("skip") + F.sum("n").over(inside))
            .withColumn("first", F.col("last") - F.col("n") + 1)
            .groupBy(key)
            .agg(((F.min(F.when(F.col("low").between(F.col("first"), F.col("last")), F.col("x")))
                   + F.min(F.when(F.col("high").between(F.col("first"), F.col("last")), F.col("x")))) / 2).alias(name)))
