"""Reports against the answer key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from invoicelake.functions import text as T
from invoicelake.functions.ordering import quantiles, seeded_hash
from invoicelake.operators.extract import REQUIRED, match_vendors
from invoicelake.operators.metrics import share
from invoicelake.session import cut_lineage

# Tolerances and report sizes.
AMOUNT_TOLERANCE = 0.01
TOP_FLAGS = 8
EXAMPLES = 5
OCR_SAMPLE = 50
OCR_SEED = 1

TEXTS = ["invoice_no", "invoice_date", "gstin", "vendor_id"]
AMOUNTS = ["subtotal", "gst", "total"]


def with_truth(extracted: DataFrame, documents: DataFrame, truth: DataFrame) -> DataFrame:
    """Extracted rows next to their answer: truth columns that clash get the suffix ``_gt``."""
    key = truth.select(*[F.col(c).alias(f"{c}_gt" if c in extracted.columns else c) for c in truth.columns])
    named = extracted.join(documents.select("doc_id", "file_name"), "doc_id")
    return named.join(key, named["file_name"] == key["file"])


def labelled(extracted: DataFrame, documents: DataFrame, truth: DataFrame) -> DataFrame:
    """The part of the answer key that detection is graded with: number, copy and anomaly mark."""
    return with_truth(extracted, documents, truth.select("file", "invoice_no", "is_duplicate", "is_anomaly"))


def field_ok(field: str, found: str | None = None, expected: str | None = None) -> Column:
    """Texts must be equal, amounts closer than the tolerance; NULL is wrong, even against NULL."""
    a, b = F.col(found or field), F.col(expected or f"{field}_gt")
    right = F.abs(a - b) < AMOUNT_TOLERANCE if field in AMOUNTS else a == b
    return F.coalesce(right, F.lit(False))


def all_ok() -> Column:
    ok = F.lit(True)
    for field in REQUIRED:
        ok = ok & field_ok(field)
    return ok


def stage_counts(documents: DataFrame, quality: DataFrame, ocr: DataFrame) -> DataFrame:
    """How many documents reached every stage."""
    n = F.count("*")
    return documents.filter("status = 'INGESTED'").agg(n.alias("ingested")).select(
        "ingested", quality.agg(n).scalar().alias("cleaned"), ocr.agg(n).scalar().alias("ocr"))


def missing_share(extracted: DataFrame) -> DataFrame:
    """(field, missing): share of NULL per field, three digits."""
    wide = extracted.agg(*[F.round(F.avg(F.isnull(c).cast("int")), 3).alias(c) for c in REQUIRED])
    return wide.unpivot([], REQUIRED, "field", "missing")


def top_flags(extracted: DataFrame, rows: int = TOP_FLAGS) -> DataFrame:
    """Most common flags; documents without any count as ''. Equal combinations are counted before the split."""
    combos = extracted.groupBy("flags").agg(F.count("*").alias("n"))
    return (combos.select(F.explode(F.split("flags", ",")).alias("flag"), "n")
            .groupBy("flag").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "flag").limit(rows))


def describe(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles (interpolated) and maximum."""
    x = F.col(column)
    stats = df.agg(F.count(column).cast("double").alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                   F.min(x).alias("min"), F.max(x).alias("max")).withColumn(
        "q", quantiles(df, column, [0.25, 0.5, 0.75]).scalar())
    values = {"count": F.col("count"), "mean": F.col("mean"), "std": F.col("std"), "min": F.col("min"),
              "p25": F.col("q")[0], "p50": F.col("q")[1], "p75": F.col("q")[2], "max": F.col("max")}
    return stats.select(*[F.round(v.cast("double"), digits).alias(k) for k, v in values.items()])


def failing_example(extracted: DataFrame, ocr: DataFrame) -> DataFrame:
    """Flags and text of the first document that needs review."""
    first = extracted.filter("needs_review = 1").select("doc_id", "flags").orderBy("doc_id").limit(1)
    return first.join(ocr.select("doc_id", "text"), "doc_id")


def mismatches(graded: DataFrame) -> DataFrame:
    """(doc_id, field, found, expected) of every wrong field; an amount is wrong beyond the tolerance or when missing."""
    def wrong(field: str) -> Column:
        if field in AMOUNTS:
            return F.coalesce(F.abs(F.col(field) - F.col(f"{field}_gt")), F.lit(1.0)) > AMOUNT_TOLERANCE
        return ~field_ok(field)

    cells = F.array_compact(F.array(*[
        F.when(wrong(f), F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("found"),
                                  F.col(f"{f}_gt").cast("string").alias("expected"))) for f in REQUIRED]))
    return graded.select("doc_id", F.explode(cells).alias("m")).select("doc_id", "m.*")


def mismatch_counts(graded: DataFrame) -> DataFrame:
    return mismatches(graded).groupBy("field").agg(F.count("*").alias("wrong"))


def mismatch_examples(graded: DataFrame, rows: int = EXAMPLES) -> DataFrame:
    """The first documents per wrong field. Row number limits are pushed below the shuffle by Spark."""
    order = Window.partitionBy("field").orderBy("doc_id")
    return (mismatches(graded).withColumn("nr", F.row_number().over(order)).filter(F.col("nr") <= rows).drop("nr"))


def field_accuracy(graded: DataFrame, digits: int = 3) -> DataFrame:
    """(field, accuracy)."""
    wide = graded.agg(*[F.round(F.avg(field_ok(f).cast("int")), digits).alias(f) for f in REQUIRED])
    return wide.unpivot([], REQUIRED, "field", "accuracy")


def straight_through(graded: DataFrame) -> DataFrame:
    """How many documents pass without a human, and how right the decision was. Shares of nothing are NULL."""
    rows = graded.select(all_ok().alias("ok"), (F.col("needs_review") == 0).alias("auto"))
    sums = rows.agg(F.count("*").alias("documents"), F.count_if("ok").alias("ok"), F.count_if("auto").alias("auto"),
                    F.count_if(F.col("auto") & F.col("ok")).alias("auto_ok"),
                    F.count_if(~F.col("auto") & ~F.col("ok")).alias("reviewed_wrong"))
    n = F.col("documents")
    return sums.select(
        "documents", share(F.col("ok"), n).alias("fully_correct"), share(F.col("auto"), n).alias("straight_through"),
        share(F.col("auto_ok"), F.col("auto")).alias("auto_accuracy"), (n - F.col("auto")).alias("sent_to_review"),
        "reviewed_wrong", (F.col("auto") - F.col("auto_ok")).alias("unflagged_wrong"))


def hybrid(rules: DataFrame, other: DataFrame) -> DataFrame:
    """The rule value, or the other model's where the rules found none."""
    second = other.select("doc_id", *[F.col(f).alias(f"{f}_2") for f in REQUIRED])
    return (rules.select("doc_id", *REQUIRED).join(second, "doc_id", "left")
            .select("doc_id", *[F.coalesce(f, f"{f}_2").alias(f) for f in REQUIRED]))


def normalise_entities(entities: DataFrame, master: DataFrame | None = None) -> DataFrame:
    """Tagged entities (doc_id, pos, label, text) to field values: the first of a label, the last TOTAL.

    Numbers lose their spaces and become upper case, amounts keep digits and dots (NULL when that is no
    number), vendors are looked up in ``master`` by similarity.
    """
    def pick(label: str, last: bool = False) -> Column:
        at = F.when(F.col("label") == label, F.col("pos"))
        return F.max_by("text", at) if last else F.min_by("text", at)

    def money(column: str) -> Column:
        return F.regexp_replace(column, r"[^\d.]", "").try_cast("double")

    raw = entities.groupBy("doc_id").agg(
        pick("INV_NO").alias("number"), pick("DATE").alias("invoice_date"), pick("GSTIN").alias("gstin"),
        pick("VENDOR").alias("vendor"), pick("SUBTOTAL").alias("sub"), pick("GST").alias("tax"),
        pick("TOTAL", last=True).alias("sum"))
    fields = raw.select("doc_id", F.upper(F.regexp_replace("number", r"\s+", "")).alias("invoice_no"), "invoice_date",
                        "gstin", F.lower("vendor").alias("vendor"), money("sub").alias("subtotal"),
                        money("tax").alias("gst"), money("sum").alias("total"))
    if master is None:
        return fields.drop("vendor")
    # the search reads them twice; grouping the entities again would cost more than keeping one row per document
    return match_vendors(cut_lineage(fields), "vendor", master).select("doc_id", *REQUIRED)


def compare_models(models: dict[str, DataFrame], truth: DataFrame, split: DataFrame | None = None,
                   part: str = "test") -> DataFrame:
    """Accuracy per field, of whole documents and averaged over the fields, for every model on the held-out part.

    ``truth`` carries doc_id. One pass: the models are stacked and joined with the answers once.
    """
    answers = truth.select("doc_id", *[F.col(f).alias(f"{f}_gt") for f in REQUIRED])
    if split is not None:
        answers = answers.join(split.filter(F.col("split") == part).select("doc_id"), "doc_id", "left_semi")
    stacked = None
    for name, rows in models.items():
        rows = rows.select(F.lit(name).alias("model"), "doc_id", *REQUIRED)
        stacked = rows if stacked is None else stacked.unionByName(rows)
    accuracies = [F.avg(field_ok(f).cast("int")).alias(f) for f in REQUIRED]
    table = stacked.join(answers, "doc_id").groupBy("model").agg(
        *accuracies, F.avg(all_ok().cast("int")).alias("all_fields_correct"))
    mean = sum((F.col(f) for f in REQUIRED), F.lit(0.0)) / len(REQUIRED)
    return table.withColumn("avg_field_accuracy", mean)


def ocr_contains(texts: DataFrame, truth: DataFrame) -> DataFrame:
    """(file, version, text) -> does the squeezed text hold number, date, tax id and printed total of its file."""
    found = T.squeeze(F.col("text"))
    key = truth.select("file", *[T.squeeze(F.col(c)).alias(n) for c, n in
                                 [("invoice_no", "invoice_no"), ("invoice_date", "date"), ("gstin", "gstin")]],
                       T.printed_amount(F.col("total")).alias("total"))
    return (texts.withColumn("_t", found).join(key, "file")
            .select("file", "version", *[F.contains(F.col("_t"), F.col(c)).alias(c)
                                         for c in ("invoice_no", "date", "gstin", "total")]))


def sample_files(truth: DataFrame, rows: int = OCR_SAMPLE, seed: int = OCR_SEED) -> DataFrame:
    """A repeatable random sample of original invoices."""
    return (truth.filter("is_duplicate = 0").select("*", seeded_hash("file", seed).alias("_h"))
            .orderBy("_h", "file").limit(rows).drop("_h"))


def ocr_versions(contains: DataFrame) -> DataFrame:
    """Hit rates per version and their mean."""
    parts = ["invoice_no", "date", "gstin", "total"]
    rates = contains.groupBy("version").agg(*[F.avg(F.col(c).cast("int")).alias(c) for c in parts])
    return rates.withColumn("overall", sum((F.col(c) for c in parts), F.lit(0.0)) / len(parts))
