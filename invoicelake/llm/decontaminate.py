"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased, and held as 64-bit hashes. Of the hashes of ``GRAM`` words the
smallest of every ``WINDOW`` consecutive ones is kept (all of them on a tie), for documents and items alike. Two texts that share
``SPAN = GRAM + WINDOW - 1`` words in a row keep the same hash there, so joining the kept hashes meets every shared span. Each
kept hash carries the words around it, and a meeting is extended over them to both sides; it counts if ``SPAN`` words agree.
Items of fewer words are met whole, by a join on the hashes of all word sequences of their length.

The documents are read once and their texts are never shuffled, only a row per document and per meeting. Spark broadcasts the item side
when it is small by its measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.llm.common import stored, with_row, without_rows

GRAM = 5
WINDOW = 6
SPAN = GRAM + WINDOW - 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text; NULL has none. ``lower`` is the quicker form where all characters are ASCII."""
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.filter(F.split(F.coalesce(low, F.lit("")), _GAPS, -1), lambda w: w != "")


def fingerprints(rows: DataFrame) -> DataFrame:
    """``rows`` (columns ..., codes) with a column ``kept``: structs of ``at`` (word place from 0), ``gram`` and the words ``left`` of
    it (the nearest first) and ``right`` from it on, as far as a shared span that holds it may reach.

    A hash is kept when it is the smallest of some window, that is when it equals the largest of the window minima around it.
    Arrays used inside a function are referenced more than once, so that Spark computes them once per row.
    """
    others = rows.columns
    long = F.size("codes") >= SPAN
    grams = rows.select(*others, F.when(long, F.transform(F.sequence(F.lit(0), F.size("codes") - GRAM), lambda i: F.xxhash64(
        *(F.get("codes", i + k) for k in range(GRAM))))).alias("grams"))
    lows = grams.select(*others, "grams", F.transform(F.sequence(F.lit(0), F.size("grams") - WINDOW), lambda i: F.least(
        *(F.get("grams", i + k) for k in range(WINDOW)))).alias("lows"))

    def smallest(at: Column) -> Column:  # places outside the array are NULL and do not count
        return F.get("grams", at) == F.greatest(*(F.get("lows", at - k) for k in range(WINDOW)))

    def mark(at: Column) -> Column:
        reach = F.least(at, F.lit(SPAN - GRAM))
        return F.struct(at.alias("at"), F.get("grams", at).alias("gram"), F.reverse(F.slice("codes", at - reach + 1, reach)).alias("left"),
                        F.slice("codes", at + 1, SPAN).alias("right"))
    kept = F.transform(F.filter(F.sequence(F.lit(0), F.size("grams") - 1), smallest), mark)
    none = F.array().cast("array<struct<at:int,gram:bigint,left:array<bigint>,right:array<bigint>>>")
    return lows.select(*others, F.when(F.size("lows") > 0, kept).otherwise(none).alias("kept"))


def _agreeing(a: Column, b: Column) -> Column:
    """How many leading values of two arrays are equal."""
    same_so_far = F.filter(F.sequence(F.lit(1), F.least(F.size(a), F.size(b))), lambda n: F.slice(a, F.lit(1), n) == F.slice(b, F.lit(1), n))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(same_so_far)).otherwise(0)


def _coded(table: DataFrame, *columns: Column) -> DataFrame:
    return (table.select(*columns, words(F.col("text")).alias("words"))
            .withColumn("codes", F.transform("words", lambda w: F.xxhash64(w))).drop("words"))


def _meetings(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, mark, n_words, item, start, length``: for every document a row without an item that has its number of words, and a row for
    every meeting with an item, ``length`` words from word ``start`` on being equal. ``docs`` has doc_id, mark and codes."""
    # explode_outer: for explode Spark would infer a filter, push it below and compute the arrays again for every element
    long = fingerprints(items.filter(F.size("codes") >= SPAN)).select("item", F.explode_outer("kept").alias("k"))
    long = long.select("item", F.col("k.gram").alias("gram"), F.col("k.left").alias("item_left"), F.col("k.right").alias("item_right"))
    total = F.struct(F.lit(-1).alias("at"), F.lit(None).cast("long").alias("gram"), F.array(F.size("codes").cast("long")).alias("left"),
                     F.array().cast("array<bigint>").alias("right"))
    rows = fingerprints(docs).select("doc_id", "mark", F.explode_outer(F.concat(F.array(total), "kept")).alias("k"))
    met = (rows.select("doc_id", "mark", "k.*").join(long, "gram", "left").filter((F.col("at") < 0) | F.col("item").isNotNull())
           .withColumn("before", F.when(F.col("at") >= 0, _agreeing(F.col("left"), F.col("item_left"))))
           .withColumn("length", F.when(F.col("at") >= 0, F.col("before") + _agreeing(F.col("right"), F.col("item_right")))))
    out = met.filter((F.col("at") < 0) | (F.col("length") >= SPAN)).select(
        "doc_id", "mark", F.when(F.col("at") < 0, F.get("left", F.lit(0))).alias("n_words"), "item",
        (F.col("at") - F.col("before")).alias("start"), "length")
    short = items.filter(F.size("codes") < SPAN)
    for span in sorted(row["n"] for row in short.select(F.size("codes").alias("n")).distinct().collect()):  # 1 to SPAN - 1
        own = short.filter(F.size("codes") == span).select("item", F.xxhash64("codes").alias("gram"), F.col("codes").alias("item_codes"))
        found = docs.filter(F.size("codes") >= span).select("doc_id", "mark", F.posexplode(F.transform(
            F.sequence(F.lit(1), F.size("codes") - (span - 1)), lambda i: F.slice("codes", i, span))).alias("start", "codes"))
        found = found.withColumn("gram", F.xxhash64("codes")).join(own, "gram").filter(F.col("codes") == F.col("item_codes"))
        out = out.unionByName(found.select("doc_id", "mark", F.lit(None).cast("long").alias("n_words"), "item", "start", F.lit(span).alias("length")))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, items, spans``.

    ``spans`` are (start, length) in words, ``items`` the ids of the items found, as sorted strings; an item without an id adds
    spans only. NULL texts have no words. Rows that share a doc_id are told apart by a hash of their text.
    """
    rows = _coded(docs, F.col("doc_id"), F.xxhash64("text").alias("mark"))
    items = stored(_coded(benchmark, F.col("item_id").cast("string").alias("item_id")).filter(F.size("codes") > 0)
                   .groupBy("codes").agg(F.collect_set("item_id").alias("ids")).withColumn("item", F.monotonically_increasing_id()), "items")
    met = _meetings(rows, items).join(items.select("item", "ids"), "item", "left")
    found = met.groupBy("doc_id", "mark").agg(F.max("n_words").alias("n_words"), F.count("n_words").alias("rows"), F.collect_set("ids").alias("ids"),
                                              F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "length"))).alias("spans"))
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))
    return found.select("doc_id", "n_words", F.size(covered).alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("ids"))).alias("items"),
                        "spans", F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int"))).alias("row")).drop("row")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per document."""
    return contamination(docs, benchmark).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows, all columns as they are. Every row has its own verdict, whatever its id; ``docs`` is a table read from files."""
    rows, row = with_row(docs)
    found = contamination(rows.select(F.col(row).alias("doc_id"), "text"), benchmark)
    return without_rows(rows, row, found.filter("n_hit > 0").select("doc_id"))
