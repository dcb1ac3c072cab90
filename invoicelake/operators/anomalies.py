"""Unusual totals: robust z-scores per vendor, a global z-score, and the isolation forest score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.functions.medians import group_median, value_counts
from invoicelake.operators import forest, metrics
from invoicelake.session import cut_lineage

# Fixed values.
REVIEW_BUDGET = 0.05
MIN_MAD = 0.1
MAD_TO_SIGMA = 1.4826
SEED = 42


def usable() -> Column:
    """No copy, a vendor, a positive total."""
    return F.coalesce((F.col("is_duplicate") == 0) & (F.col("total") > 0) & F.col("vendor_id").isNotNull(), F.lit(False))


def scorable(rows: DataFrame) -> DataFrame:
    return rows.filter(usable())


def filter_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if(usable()).alias("scored"), F.count_if(~usable()).alias("excluded"))


def with_log_total(rows: DataFrame) -> DataFrame:
    return rows.withColumn("log_total", F.log1p("total"))


def with_vendor_z(rows: DataFrame) -> DataFrame:
    """How far log_total lies from the vendor's median, in robust standard deviations. The spread has a floor."""
    values = value_counts(rows, "vendor_id", "log_total")
    middle = cut_lineage(group_median(values, "vendor_id", "median"))
    deviations = values.join(middle, "vendor_id").select("vendor_id", F.abs(F.col("x") - F.col("median")).alias("d"), "n")
    spread = group_median(value_counts(deviations, "vendor_id", "d", "n"), "vendor_id", "mad")
    z = (F.col("log_total") - F.col("median")) / (F.greatest("mad", F.lit(MIN_MAD)) * MAD_TO_SIGMA)
    return rows.join(middle.join(spread, "vendor_id"), "vendor_id").withColumn("vendor_z", z).drop("median", "mad")


def with_global_z(rows: DataFrame) -> DataFrame:
    """Plain z-score over all rows (sample standard deviation), the baseline."""
    stats = rows.agg(F.struct(F.avg("total").alias("mean"), F.stddev_samp("total").alias("std")).alias("s")).scalar()
    return (rows.withColumn("_s", stats)
            .withColumn("global_z", F.try_divide(F.col("total") - F.col("_s.mean"), F.col("_s.std"))).drop("_s"))


def features(rows: DataFrame) -> DataFrame:
    """Scorable rows with log_total, vendor_z and global_z."""
    return with_global_z(with_vendor_z(with_log_total(scorable(rows))))


def with_iso_score(rows: DataFrame, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    return forest.score(rows, forest.grow(rows, ["log_total", "vendor_z"], key, seed), "iso_score")


def scores(scored: DataFrame, budget: float = REVIEW_BUDGET) -> DataFrame:
    """(doc_id, iso_score, vendor_z, flagged): flagged rows are within the review budget."""
    return metrics.within_budget(scored, "iso_score", budget).select("doc_id", "iso_score", "vendor_z", "flagged")


def compare(scored: DataFrame, names: list[str], label: str = "is_anomaly", key: str = "doc_id",
            budget: float = REVIEW_BUDGET) -> DataFrame:
    """One row per score: ROC-AUC, average precision, precision at the number of anomalies, recall in the budget.

    ``scored`` is read several times: pass a table or a checkpoint.
    """
    table = None
    for name in names:
        tops = {"k": F.col("positives"), "budget": metrics.budget_rows(budget)}
        row = metrics.score_report(scored, name, label, key, tops).select(
            F.lit(name).alias("score"), "roc_auc", "avg_precision", F.col("k_k").alias("k"),
            metrics.share(F.col("hits_k"), F.col("k_k")).alias("precision_at_k"), F.col("k_budget").alias("budget"),
            metrics.share(F.col("hits_budget"), F.col("positives")).alias("recall_at_budget"))
        table = row if table is None else table.unionByName(row)
    return table
