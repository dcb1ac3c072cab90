"""Quality numbers of scores and predictions. Every one reduces to counts before anything is ordered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.functions.ordering import seeded_hash, with_prefix, with_rank
from invoicelake.session import cut_lineage


def share(part: Column, whole: Column, otherwise: float | None = None) -> Column:
    """part / whole as double; ``otherwise`` when whole is 0."""
    value = F.try_divide(part.cast("double"), whole.cast("double"))
    return value if otherwise is None else F.coalesce(value, F.lit(float(otherwise)))


def score_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score: n rows, p of them positive. Rows without a score are left out."""
    return (scored.select(F.col(score).cast("double").alias("score"), F.col(label).cast("long").alias("y"))
            .filter(F.col("score").isNotNull())
            .groupBy("score").agg(F.count("*").alias("n"), F.sum("y").alias("p")))


def _ranked(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Score counts with the rows and positives above each score and the totals."""
    counts = cut_lineage(score_counts(scored, score, label))
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.sum("p").alias("p")).alias("t")).scalar()
    return with_prefix(counts, "score", ["n", "p"]).withColumn("all", totals)


def _auc() -> Column:
    """Share of (positive, negative) couples in the right order; a tie counts half."""
    n, p = F.col("n") - F.col("p"), F.col("p")
    below = (F.col("all.n") - F.col("all.p")) - (F.col("n_before") - F.col("p_before")) - n
    return share(F.sum(p * (below + n / 2)), F.first("all.p") * (F.first("all.n") - F.first("all.p")))


def _average_precision() -> Column:
    """Precision at every distinct score, weighted by the recall it adds."""
    precision = (F.col("p_before") + F.col("p")) / (F.col("n_before") + F.col("n"))
    return share(F.sum(F.col("p") * precision), F.first("all.p"))


def roc_auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    return _ranked(scored, score, label).agg(_auc().alias("roc_auc"))


def average_precision(scored: DataFrame, score: str, label: str) -> DataFrame:
    return _ranked(scored, score, label).agg(_average_precision().alias("avg_precision"))


def budget_rows(budget: float) -> Column:
    """Rows a review budget pays for: the whole part of the share, one at least."""
    return F.greatest(F.lit(1).cast("long"), F.floor(F.col("rows") * F.lit(budget)))


def score_report(scored: DataFrame, score: str, label: str, key: str, tops: dict[str, Column]) -> DataFrame:
    """One row: rows, positives, roc_auc, avg_precision and, for every entry of ``tops``, its size ``k_<name>``
    and the positives among that many best scores ``hits_<name>``.

    Sizes are expressions over ``rows`` and ``positives``. Equal scores are ordered by a hash of ``key``; only the
    rows that tie at a cut are ranked.
    """
    base = (scored.select(F.col(score).cast("double").alias("score"), F.col(label).cast("long").alias("y"),
                          F.col(key).alias("key")).filter(F.col("score").isNotNull()))
    ranked = (_ranked(base, "score", "y").withColumn("rows", F.col("all.n")).withColumn("positives", F.col("all.p")))
    columns = [F.max("rows").alias("rows"), F.max("positives").alias("positives"), _auc().alias("roc_auc"),
               _average_precision().alias("avg_precision")]
    for name, size in tops.items():
        ranked = ranked.withColumn(f"k_{name}", size.cast("long"))
        k, upto = F.col(f"k_{name}"), F.col("n_before") + F.col("n")
        cut = (F.col("n_before") < k) & (k < upto)
        columns += [F.max(k).alias(f"k_{name}"), F.sum(F.when(upto <= k, F.col("p")).otherwise(0)).alias(f"whole_{name}"),
                    F.max(F.when(cut, F.col("score"))).alias(f"cut_{name}"),
                    F.max(F.when(cut, k - F.col("n_before"))).alias(f"left_{name}")]
    summary = ranked.agg(*columns).first()          # one row of sums
    out = [F.lit(summary[c]).cast(t).alias(c) for c, t in
           [("rows", "long"), ("positives", "long"), ("roc_auc", "double"), ("avg_precision", "double")]]
    for name in tops:
        hits = F.lit(summary[f"whole_{name}"]).cast("long")
        if summary[f"cut_{name}"] is not None:
            ties = base.filter(F.col("score") == F.lit(summary[f"cut_{name}"]))
            ties = with_rank(ties.withColumn("h", seeded_hash("key", "tie")), "h", "key")
            inside = ties.filter(F.col("rank") <= summary[f"left_{name}"])
            hits = hits + inside.agg(F.coalesce(F.sum("y"), F.lit(0))).scalar()
        out += [F.lit(summary[f"k_{name}"]).cast("long").alias(f"k_{name}"), hits.alias(f"hits_{name}")]
    return scored.sparkSession.range(1).select(*out)


def precision_at_k(scored: DataFrame, score: str, label: str, key: str, k: Column | None = None) -> DataFrame:
    """Share of positives among the top k; k is the number of positives unless given."""
    report = score_report(scored, score, label, key, {"top": F.col("positives") if k is None else k})
    return report.select(F.col("k_top").alias("k"), share(F.col("hits_top"), F.col("k_top")).alias("precision_at_k"))


def recall_at_budget(scored: DataFrame, score: str, label: str, key: str, budget: float) -> DataFrame:
    """Share of all positives found within the review budget."""
    report = score_report(scored, score, label, key, {"top": budget_rows(budget)})
    return report.select(F.col("k_top").alias("budget"),
                         share(F.col("hits_top"), F.col("positives")).alias("recall_at_budget"))


def within_budget(scored: DataFrame, score: str, budget: float, name: str = "flagged") -> DataFrame:
    """Add 0/1: the average rank of the score (largest first, ties share it) is within the budget.

    The rank falls with the score, so the flag is a comparison with the lowest score that still passes. A row
    without a score is never flagged and does not take part in the ranking, but it counts for the budget.
    """
    counts = cut_lineage(score_counts(scored.withColumn("_y", F.lit(0)), score, "_y"))
    ranked = with_prefix(counts, "score", ["n"]).withColumn("rows", F.lit(scored.count()))
    rank = F.col("n_before") + (F.col("n") + 1) / 2
    lowest = ranked.filter(rank <= budget_rows(budget)).agg(F.min("score")).first()[0]
    inside = F.lit(False) if lowest is None else F.coalesce(F.col(score).cast("double") >= F.lit(lowest), F.lit(False))
    return scored.withColumn(name, inside.cast("int"))


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction",
              by: list[str] | None = None) -> DataFrame:
    """Counts of (truth, predicted) in long form, one matrix per group of ``by``."""
    return (predictions.groupBy(*(by or []), F.col(label).alias("label"), F.col(prediction).alias("prediction"))
            .agg(F.count("*").alias("n")))


def confusion_matrix(predictions: DataFrame, classes: list, label: str = "label",
                     prediction: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """Rows are truths, columns ``p_<class>`` predictions."""
    cells = confusion(predictions, label, prediction, by)
    return cells.groupBy(*(by or []), "label").agg(
        *[F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("n"))), F.lit(0)).alias(f"p_{c}")
          for c in classes])


def accuracy_macro_f1(predictions: DataFrame, by: list[str], label: str = "label",
                      prediction: str = "prediction") -> DataFrame:
    """Accuracy and the plain mean of F1 over every class seen as truth or prediction."""
    cells = confusion(predictions, label, prediction, by)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = cells.select(*by, "n", F.explode(F.array(
        F.struct(F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("t"), F.lit(0).cast("long").alias("q")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("tp"),
                 F.lit(0).cast("long").alias("t"), F.col("n").alias("q")))).alias("s"))
    classes = sides.groupBy(*by, "s.class").agg(F.sum("s.tp").alias("tp"), F.sum("s.t").alias("t"), F.sum("s.q").alias("q"))
    f1 = share(2 * F.col("tp"), F.col("t") + F.col("q"), otherwise=0)
    return classes.groupBy(*by).agg(share(F.sum("tp"), F.sum("t")).alias("acc"), F.avg(f1).alias("macro_f1"))


def mean_std(results: DataFrame, metrics: list[str], by: list[str], digits: int = 3) -> DataFrame:
    """Mean and sample standard deviation over repeated runs."""
    out = []
    for m in metrics:
        out += [F.round(F.avg(m), digits).alias(f"{m}_mean"), F.round(F.stddev_samp(m), digits).alias(f"{m}_std")]
    return results.groupBy(*by).agg(*out)


def improvement(results: DataFrame, model: str, metric: str, base: str) -> DataFrame:
    """Every other model against ``base``: points gained, relative gain and share of the errors removed, in %.

    The relative gain is NULL for a base of 0, the error reduction for a base of 1.
    """
    baseline = results.filter(F.col(model) == base).agg(F.avg(metric)).scalar()
    means = (results.filter(F.col(model) != base).groupBy(model).agg(F.avg(metric).alias("value"))
             .withColumn("base", baseline))
    gain = F.col("value") - F.col("base")
    return means.select(model, "base", "value", (gain * 100).alias("absolute_points"),
                        (share(gain, F.col("base")) * 100).alias("relative_pct"),
                        (share(gain, 1 - F.col("base")) * 100).alias("error_reduction_pct"))


def binary_report(counts: DataFrame) -> DataFrame:
    """Add precision, recall and F1 to rows with caught, false_alarms and missed; 0 where undefined."""
    tp, fp, fn = F.col("caught"), F.col("false_alarms"), F.col("missed")
    return counts.select("*", share(tp, tp + fp, 0).alias("precision"), share(tp, tp + fn, 0).alias("recall"),
                         share(2 * tp, 2 * tp + fp + fn, 0).alias("f1"))


def prediction_report(rows: DataFrame, prediction: str, label: str) -> DataFrame:
    """The report of a 0/1 prediction column."""
    hit, true = F.col(prediction) == 1, F.col(label) == 1
    return binary_report(rows.agg(F.count_if(hit & true).alias("caught"), F.count_if(hit & ~true).alias("false_alarms"),
                                  F.count_if(~hit & true).alias("missed")))
