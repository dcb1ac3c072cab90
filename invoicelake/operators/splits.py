"""Repeatable splits: whole invoice families to one side, and three parts of a document list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.functions.ordering import seeded_hash, with_rank
from invoicelake.functions.text import without_copy_mark

# Fixed values.
TEST_SHARE = 0.2
PARTS = (0.70, 0.15)
SEED = 42


def _ranked(ids: DataFrame, key: str, seed: int) -> DataFrame:
    hashed = ids.select(key, seeded_hash(key, seed).alias("h"))
    return with_rank(hashed, "h", key).withColumn("size", ids.agg(F.count("*")).scalar())


def whole(size: Column, share: float) -> Column:
    """Whole part of a share; the small term keeps 0.15 * 300 at 45."""
    return F.floor(size * F.lit(share) + F.lit(1e-9))


def group_split(rows: DataFrame, number: str = "invoice_no", key: str = "doc_id", share: float = TEST_SHARE,
                seed: int = SEED) -> DataFrame:
    """(key, split): a share of the invoice families to 'test', the rest to 'train'.

    A family is the number without the copy mark, so a copy never sits on the other side of its original.
    """
    based = rows.select(key, without_copy_mark(F.col(number)).alias("base"))
    families = based.select("base").distinct()
    chosen = _ranked(families, "base", seed).filter(F.col("rank") <= whole(F.col("size"), share))
    marked = based.join(chosen.select("base", F.lit(True).alias("chosen")), "base", "left")
    return marked.select(key, F.when(F.col("chosen"), "test").otherwise("train").alias("split"))


def three_way(rows: DataFrame, key: str, parts: tuple[float, float] = PARTS, seed: int = SEED) -> DataFrame:
    """(key, split): 'train', 'val', 'test' by position in a seeded order of the distinct keys."""
    ranked = _ranked(rows.select(key).distinct(), key, seed)
    first = whole(F.col("size"), parts[0])
    second = first + whole(F.col("size"), parts[1])
    split = F.when(F.col("rank") <= first, "train").when(F.col("rank") <= second, "val").otherwise("test")
    return ranked.select(key, split.alias("split"))
