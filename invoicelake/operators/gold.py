"""Star schema, monthly totals and the spend report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The default calendar and report size.
CALENDAR = ("2026-01-01", "2026-12-31")
TOP_VENDORS = 5


def date_key(day: str) -> Column:
    """20260131 for 2026-01-31."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def to_money(amount: Column) -> Column:
    """Exact amounts for sums: a total of doubles would depend on the order in which tasks finish."""
    return amount.cast("decimal(24,4)")


def fact_invoices(invoices: DataFrame) -> DataFrame:
    return invoices.select("doc_id", "invoice_no", "vendor_id", date_key("invoice_date").alias("date_key"),
                           "subtotal", "gst", "total", "needs_review", "mean_conf", "skew_angle", "blur_score")


def dim_vendor(invoices: DataFrame) -> DataFrame:
    """Most frequent (vendor_name, gstin) of every vendor; ties go to the smaller name, then gstin, NULL first.

    The winner is an aggregate over the distinct spellings, so a vendor with many invoices is reduced before
    the shuffle.
    """
    spellings = invoices.groupBy("vendor_id", "vendor_name", "gstin").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), "vendor_name", "gstin")).alias("best")
    return spellings.groupBy("vendor_id").agg(best).select("vendor_id", "best.vendor_name", "best.gstin")


def dim_date(spark: SparkSession, start: date | str = CALENDAR[0], end: date | str = CALENDAR[1]) -> DataFrame:
    """One row per day from start to end, both included."""
    days = F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    return (spark.range(1).select(F.explode(days).alias("date"))
            .select(date_key("date").alias("date_key"), "date", F.year("date").alias("year"),
                    F.month("date").alias("month"), F.date_format("date", "MMMM").alias("month_name"),
                    F.quarter("date").alias("quarter"), F.dayname("date").alias("weekday")))


def vendor_monthly(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Count, sum and mean of the totals per vendor and month; days outside the calendar drop out."""
    month = calendar.select("date_key", "year", "month")
    sums = (fact.join(month, "date_key").groupBy("vendor_id", "year", "month")
            .agg(F.count("*").alias("invoice_count"), F.sum(to_money(F.col("total"))).alias("spend"),
                 F.count("total").alias("priced")))
    return sums.select("vendor_id", "year", "month", "invoice_count",
                       F.round("spend", 2).cast("double").alias("total_spend"),
                       F.round(F.col("spend") / F.col("priced"), 2).cast("double").alias("avg_invoice"))


def top_vendors(fact: DataFrame, vendors: DataFrame, rows: int = TOP_VENDORS) -> DataFrame:
    """Vendor names with the largest spend. Facts are summed per vendor before the join with the names."""
    per_vendor = (fact.groupBy("vendor_id")
                  .agg(F.count("*").alias("n"), F.sum(to_money(F.col("total"))).alias("spend")))
    per_name = (per_vendor.join(vendors.select("vendor_id", "vendor_name"), "vendor_id").groupBy("vendor_name")
                .agg(F.sum("n").alias("invoices"), F.round(F.sum("spend"), 2).cast("double").alias("spend")))
    return per_name.orderBy(F.desc("spend"), "vendor_name").limit(rows)
