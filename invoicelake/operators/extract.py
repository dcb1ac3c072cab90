"""Invoice fields from text, their validation, and the vendor behind a header."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.functions import text as T
from invoicelake.functions.similarity import LONGEST, REACH, NameIndex, first_scores, left_out, pieces_of, ratio_from, telling_pieces, within_reach
from invoicelake.session import cut_lineage

# Limits of the validation rules.
VENDOR_THRESHOLD = 0.8
AMOUNT_SLACK = 0.02
GST_RATE = 0.18
MIN_CONFIDENCE = 60

REQUIRED = ["invoice_no", "invoice_date", "gstin", "vendor_id", "subtotal", "gst", "total"]
SEEDS = 3                  # pieces of a header that give its first score
MOST_MET = 0.5             # share of the names the pieces of one header may lead to
NAMES_PER_TASK = 20_000    # names one task of the search holds
HEADERS_PER_TASK = 600     # headers one task of the search compares with its names


def printed_fields(text: str | Column = "text") -> dict[str, Column]:
    """The fields a regular expression can find."""
    column = F.col(text) if isinstance(text, str) else text
    return {
        "invoice_no": T.first_of(column, T.INVOICE_NO),
        "invoice_date": T.first_of(column, T.INVOICE_DATE),
        "gstin": T.first_of(column, T.GSTIN),
        "subtotal": T.first_amount(column, T.SUBTOTAL),
        "gst": T.first_amount(column, T.GST),
        "total": T.last_amount(column, T.TOTAL),
    }


def vendor_master(truth: DataFrame) -> DataFrame:
    """Known vendors; equal scores are decided in the order of (vendor_id, vendor_name)."""
    return truth.select("vendor_id", "vendor_name").distinct()


def match_vendors(docs: DataFrame, header: str, master: DataFrame, threshold: float = VENDOR_THRESHOLD,
                  names_per_task: int = NAMES_PER_TASK, headers_per_task: int = HEADERS_PER_TASK) -> DataFrame:
    """Add vendor_id, vendor_name and vendor_match: the most similar vendor name of every header.

    A score under the threshold gives no vendor but is reported. Headers spelled exactly like a name are settled by a join. The other distinct headers
    meet the names that differ by so few characters that both become equal when ``similarity.REACH`` are left out (``_by_deletions``); this settles every
    header that has a name so close that no better one can lie farther away. What remains goes through an index of pieces (``_by_pieces``). All ways are exact.
    """
    known = (master.groupBy(F.lower("vendor_name").alias("top"))
             .agg(F.min(F.struct("vendor_id", "vendor_name")).alias("hit"))
             .select("top", F.struct("hit.vendor_id", "hit.vendor_name", F.lit(1.0).alias("score")).alias("_match")))
    tops = docs.select(F.col(header).alias("top")).filter(F.col("top").isNotNull()).distinct()
    rest = cut_lineage(tops.join(known.select("top"), "top", "left_anti"))
    matched = known
    if not rest.isEmpty():
        names = cut_lineage(master.filter("vendor_name IS NOT NULL").groupBy(F.lower("vendor_name").alias("name"))
                            .agg(F.min(F.struct("vendor_id", "vendor_name")).alias("hit")))
        near = cut_lineage(_by_deletions(rest, names, headers_per_task))
        settled = near.groupBy("top").agg(F.max("score").alias("best")).filter(within_reach(F.length("top"), F.col("best")))
        found = near.join(settled, "top").filter(F.col("score") >= F.col("best") - 1e-12).join(names, "name")
        found = found.select("top", "hit.vendor_id", "hit.vendor_name", "score")
        far = cut_lineage(rest.join(settled.select("top"), "top", "left_anti"))
        if not far.isEmpty():
            found = found.unionByName(_by_pieces(far, names, names_per_task, headers_per_task))
        best = (found.groupBy("top")
                .agg(F.min(F.struct((-F.col("score")).alias("minus"), F.coalesce("vendor_id", F.lit("￿")).alias("i"),
                                    F.coalesce("vendor_name", F.lit("￿")).alias("n"), "vendor_id",
                                    "vendor_name", "score")).alias("b"))
                .select("top", F.struct("b.vendor_id", "b.vendor_name", "b.score").alias("_match")))
        matched = known.unionByName(best)
    return _with_vendor(docs.join(matched.withColumnRenamed("top", header), header, "left").select(*docs.columns, "_match"), threshold)


def _by_deletions(tops: DataFrame, names: DataFrame, headers_per_task: int) -> DataFrame:
    """(top, name, score): the names that become equal to a header when at most ``REACH`` characters of both together are left out.

    Only numbers of left-out characters that lead from a length among the headers (up to ``LONGEST``) to one among the names are formed.
    """
    def lengths(df: DataFrame, column: str) -> list[int]:
        return sorted(row[0] for row in df.select(F.length(column)).distinct().collect())    # as many rows as there are lengths

    of_tops, of_names = lengths(tops, "top"), set(lengths(names, "name"))
    pairs = [(top, a, top - a + b, b) for top in of_tops for a in range(REACH + 1) for b in range(REACH + 1 - a)
             if a + b and top - a + b in of_names and 0 < top <= LONGEST and top - a + b > 0]
    if not pairs:
        return tops.sparkSession.createDataFrame([], "top string, name string, score double")

    def spread(df: DataFrame, column: str, wanted: set[tuple[int, int]], gone: str) -> DataFrame:
        parts = [df.filter(F.length(column).isin([n for n, k in wanted if k == number]))
                 .select(column, F.lit(number).alias(gone), F.explode(left_out(F.col(column), number)).alias("kept"))
                 for number in sorted({k for _, k in wanted})]
        return reduce(DataFrame.unionByName, parts)

    left = spread(tops, "top", {(n, a) for n, a, _, _ in pairs}, "gone_top")
    right = spread(names, "name", {(n, b) for _, _, n, b in pairs}, "gone_name")
    met = left.join(right, "kept").filter(F.col("gone_top") + F.col("gone_name") <= REACH).select("top", "name").distinct()
    tasks = max(1, math.ceil(tops.count() / headers_per_task))  # comparing costs more than the few bytes of the pairs tell
    return met.repartition(tasks, "top").select("top", "name", ratio_from("name", "top", F.lit(0.0)).alias("score"))


def _by_pieces(rest: DataFrame, names: DataFrame, names_per_task: int, headers_per_task: int) -> DataFrame:
    """(top, vendor_id, vendor_name, score): the best names of headers that no name is close to.

    An index leads from pieces of characters to names: the names that hold one of a header's rarest pieces give a first score, and with that score a
    proven count of shared pieces (``functions.similarity``) tells which few pieces lead to every name that is as good. Headers for which those pieces would lead to
    more than ``MOST_MET`` of all names, since they resemble none, meet the names in blocks (``_by_blocks``).
    """
    tasks = max(1, math.ceil(rest.count() / headers_per_task))  # comparing costs more than the few bytes of the pairs tell
    index = cut_lineage(names.repartition(max(1, math.ceil(names.count() / names_per_task * 8)), "name")
                        .select("name", F.explode(pieces_of("name")).alias("piece")))
    frequency = index.groupBy("piece").agg(F.count("*").alias("names"))
    told = (rest.repartition(tasks, "top").select("top", F.explode_outer(pieces_of("top")).alias("piece")).join(frequency, "piece", "left")
            .groupBy("top").agg(F.collect_list(F.coalesce("piece", F.lit(""))).alias("pieces"), F.collect_list(F.coalesce("names", F.lit(0))).alias("names")))

    def rarest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            first = [[p for _, p in sorted(x for x in zip(n, pieces) if x[0])[:SEEDS]] for n, pieces in zip(frame["names"], frame["pieces"])]
            yield frame.assign(seeds=first)[["top", "pieces", "names", "seeds"]]
    told = cut_lineage(told.repartition(tasks, "top").mapInPandas(rarest, "top string, pieces array<string>, names array<long>, seeds array<string>"))

    def met(wanted: DataFrame) -> DataFrame:
        """(top, best, name): the names that hold ``held`` of the pieces of (top, best, held, piece)."""
        return (wanted.join(index, "piece").select("top", "best", "held", "name").repartition(tasks, "top")
                .groupBy("top", "best", "held", "name").count().filter("count >= held"))

    seeds = met(told.select("top", F.lit(0.0).alias("best"), F.lit(1).alias("held"), F.explode("seeds").alias("piece")))
    first = seeds.select("top", "name").mapInPandas(first_scores, "top string, best double").groupBy("top").agg(F.max("best").alias("best"))
    total = names.count()

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            chosen = [telling_pieces(len(top), best, [x for x in zip(n, pieces) if x[1]], MOST_MET * total)
                      for top, best, n, pieces in zip(frame["top"], frame["best"], frame["names"], frame["pieces"])]
            yield frame.assign(chosen=[c for c, _ in chosen], held=[h for _, h in chosen])[["top", "best", "chosen", "held"]]

    plan = cut_lineage(told.drop("seeds").join(first, "top", "left").fillna(0.0, ["best"]).repartition(tasks, "top").mapInPandas(
        choose, "top string, best double, chosen array<string>, held int"))
    scored = met(plan.select("top", "best", "held", F.explode("chosen").alias("piece"))).select(
        "top", "name", "best", ratio_from("name", "top", "best").alias("score"))
    indexed = scored.filter(F.col("score") >= F.col("best") - 1e-12).join(names, "name").select("top", "hit.vendor_id", "hit.vendor_name", "score")
    blocks = _by_blocks(cut_lineage(plan.filter("chosen IS NULL").select("top")), names.select("hit.*"), names_per_task, headers_per_task)
    return indexed.unionByName(blocks)


def _by_blocks(tops: DataFrame, names: DataFrame, names_per_task: int, headers_per_task: int) -> DataFrame:
    """(top, vendor_id, vendor_name, score): the best name of every block of names, for headers that resemble none."""
    parts = max(1, math.ceil(names.count() / names_per_task))
    slices = math.ceil(tops.count() / headers_per_task)
    schema = "top string, vendor_id string, vendor_name string, score double"
    if not slices:
        return tops.sparkSession.createDataFrame([], schema)

    def spread(df: DataFrame, own: str, other: str, n_own: int, n_other: int, *keys: str) -> DataFrame:
        return (df.withColumn(own, F.pmod(F.xxhash64(*keys), F.lit(n_own)))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long")))))

    left = spread(tops, "slice", "part", slices, parts, "top")
    right = spread(names, "part", "slice", parts, slices, "vendor_id", "vendor_name")

    def search(headers, names):
        index = NameIndex(list(zip(names["vendor_id"], names["vendor_name"])))
        found = [(top, *index.best(top)) for top in headers["top"]]
        columns = ["top", "vendor_id", "vendor_name", "score"]
        return pd.DataFrame(found, columns=columns, dtype=object).astype({"score": float})

    return (left.groupBy("part", "slice").cogroup(right.groupBy("part", "slice"))
            .applyInPandas(search, schema))


def _with_vendor(matched: DataFrame, threshold: float) -> DataFrame:
    sure = F.col("_match.score") >= threshold
    return (matched.withColumn("vendor_id", F.when(sure, F.col("_match.vendor_id")))
            .withColumn("vendor_name", F.when(sure, F.col("_match.vendor_name")))
            .withColumn("vendor_match", F.coalesce("_match.score", F.lit(0.0))).drop("_match"))


def flags(min_confidence: float = MIN_CONFIDENCE) -> Column:
    """Ordered list of problems of a row; NULL confidence counts as low."""
    sub, gst, total, conf = (F.col(c) for c in ("subtotal", "gst", "total", "mean_conf"))
    complete = sub.isNotNull() & gst.isNotNull() & total.isNotNull()
    rules = [(F.col(c).isNull(), f"missing_{c}") for c in REQUIRED]
    rules += [
        (complete & (F.abs(sub + gst - total) > AMOUNT_SLACK), "total_mismatch"),
        (complete & (F.abs(sub * GST_RATE - gst) > AMOUNT_SLACK), "gst_rate_mismatch"),
        (F.coalesce(conf < min_confidence, F.lit(True)), "low_ocr_confidence"),
    ]
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for broken, name in rules]))


def validated(fields: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Stored form: flags as one comma-separated string, needs_review 0 or 1."""
    rows = fields.withColumn("_flags", flags(min_confidence))
    return rows.select(
        "doc_id", "invoice_no", "invoice_date", "gstin", "vendor_id", "vendor_name", "vendor_match",
        "subtotal", "gst", "total", "mean_conf", F.array_join("_flags", ",").alias("flags"),
        (F.size("_flags") > 0).cast("long").alias("needs_review"))


def records(ocr: DataFrame, master: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One validated row per OCR document (doc_id, text, mean_conf). A missing text is an empty one."""
    body = F.coalesce("text", F.lit(""))
    fields = ocr.select("doc_id", "mean_conf", T.vendor_header(body).alias("_header"),
                        *[c.alias(n) for n, c in printed_fields(body).items()])
    return validated(match_vendors(fields, "_header", master), min_confidence)
