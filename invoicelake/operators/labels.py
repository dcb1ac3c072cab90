"""Training labels: where the true values stand in the OCR text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.functions.text import printed_amount

# Label and truth column, in the order of the label set. Amounts use the last occurrence.
LABELS = {"INV_NO": "invoice_no", "DATE": "invoice_date", "GSTIN": "gstin", "VENDOR": "vendor_name",
          "SUBTOTAL": "subtotal", "GST": "gst", "TOTAL": "total"}
AMOUNTS = {"SUBTOTAL", "GST", "TOTAL"}

SPANS = "array<struct<s:int,e:int,label:string>>"


def find_spans(rows: DataFrame) -> DataFrame:
    """(doc_id, spans): 0-based character ranges of the seven values (doc_id, text and the truth columns).

    Values, positions and ranges are separate steps, so each string is printed and searched once.
    """
    values = rows.select("doc_id", "text", F.reverse("text").alias("backwards"),
                         *[(printed_amount(F.col(c)) if x in AMOUNTS else F.col(c)).alias(x) for x, c in LABELS.items()])
    hits = values.select("doc_id", F.length("text").alias("size"), *[F.length(x).alias(f"n_{x}") for x in LABELS], *[
        (F.position(F.reverse(x), F.col("backwards")) if x in AMOUNTS else F.position(F.col(x), F.col("text"))).alias(x)
        for x in LABELS])
    starts = hits.select("doc_id", *[f"n_{x}" for x in LABELS], *[
        F.when(F.col(x) > 0, F.col("size") - F.col(x) - F.col(f"n_{x}") + 1 if x in AMOUNTS else F.col(x) - 1).alias(x)
        for x in LABELS])
    spans = [F.when(F.col(x).isNotNull(), F.struct(F.col(x).alias("s"), (F.col(x) + F.col(f"n_{x}")).alias("e"),
                                                   F.lit(x).alias("label"))) for x in LABELS]
    return starts.select("doc_id", F.array_compact(F.array(*spans)).cast(SPANS).alias("spans"))


def resolve_overlaps(found: DataFrame) -> DataFrame:
    """Spans in text order; one that starts before the end of the last kept one is dropped."""
    def keep(kept: Column, span: Column) -> Column:
        free = (F.size(kept) == 0) | (span["s"] >= F.try_element_at(kept, F.lit(-1))["e"])
        return F.when(free, F.concat(kept, F.array(span))).otherwise(kept)

    merged = F.aggregate(F.array_sort("spans"), F.array().cast(SPANS), keep)
    return found.withColumn("spans", merged)


def complete_only(resolved: DataFrame) -> DataFrame:
    """Documents in which every label was found."""
    return resolved.filter(F.size("spans") == len(LABELS))


def completeness(resolved: DataFrame) -> DataFrame:
    """(kept, skipped)."""
    complete = F.size("spans") == len(LABELS)
    return resolved.agg(F.count_if(complete).alias("kept"), F.count_if(~complete).alias("skipped"))


def require_examples(resolved: DataFrame) -> DataFrame:
    """``complete_only``, or an error when nothing is left to learn from."""
    kept = complete_only(resolved)
    if kept.isEmpty():
        raise ValueError("no document shows all labelled values; check the OCR text and the answer key")
    return kept
