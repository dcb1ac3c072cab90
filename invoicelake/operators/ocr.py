"""OCR words to document text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.functions.text import strip


def aggregate_words(words: DataFrame, documents: DataFrame | None = None, line: str | None = None) -> DataFrame:
    """(doc_id, text, mean_conf, n_words) from word rows (doc_id, pos, word, conf).

    Words without letters, without a numeric confidence or with a negative one are left out. Documents of the
    list that keep no word get an empty text, 0.0 and 0. With ``line`` (a line number column) line breaks stay.
    """
    kept = (words.withColumn("word", strip(F.col("word"))).withColumn("conf", F.col("conf").try_cast("double"))
            .filter((F.col("word") != "") & (F.col("conf") >= 0)))
    keys = ["doc_id"] if line is None else ["doc_id", line]
    text = _in_order(kept, "pos", "word", " ")
    rows = kept.groupBy(*keys).agg(text.alias("text"), F.sum("conf").alias("conf"), F.count("*").alias("n_words"))
    if line is not None:
        rows = rows.groupBy("doc_id").agg(_in_order(rows, line, "text", "\n").alias("text"),
                                          F.sum("conf").alias("conf"), F.sum("n_words").alias("n_words"))
    rows = rows.select("doc_id", "text", (F.col("conf") / F.col("n_words")).alias("mean_conf"), "n_words")
    if documents is None:
        return rows
    return (documents.select("doc_id").join(rows, "doc_id", "left")
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                    F.coalesce("mean_conf", F.lit(0.0)).alias("mean_conf"),
                    F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words")))


def _in_order(rows: DataFrame, position: str, value: str, separator: str) -> Column:
    """Positions and values travel as two lists, which take less room in a shuffle than one list of structs; a missing position comes first in both."""
    missing = F.collect_list(F.col(position).isNull())
    places = F.collect_list(F.coalesce(F.col(position), F.lit(0).cast(rows.schema[position].dataType)))
    order = F.array_sort(F.zip_with(F.arrays_zip(missing.alias("m"), places.alias("p")), F.collect_list(value),
                                    lambda at, t: F.struct((~at["m"]).alias("there"), at["p"].alias("p"), t.alias("t"))))
    return F.array_join(F.transform(order, lambda row: row["t"]), separator)
