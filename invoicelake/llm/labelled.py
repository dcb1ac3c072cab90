"""Labelled rows for fitting a classifier (all of them, or a bounded sample), and turning raw margins into probabilities."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoicelake.llm.common import held_out

MAX_LABELLED = 6_000
SIEVE_BITS = (10, 27)  # the map of ids has 2 to the power of these many bits, at least and at most


def labelled_ids(labels: DataFrame, label: str, id_column: str = "doc_id") -> DataFrame:
    """``doc_id, label`` of all rows outside the held-out fifth.

    A document labelled twice takes its smaller label; NULL ids and labels do not count.
    """
    return (labels.select(F.col(id_column).alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
            .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label")))


def sieved(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without most rows whose ``doc_id`` is not in ``ids``, and with all others; no text moves.

    A row stays when both bits of its id are set in a map of about 16 bits per id (some 2 % of the other rows stay; more where the ids
    outgrow the map), so an exact match has to follow, which then moves few texts in vain.
    """
    context = docs.sparkSession.sparkContext
    power = min(max(SIEVE_BITS[0], (16 * ids.count()).bit_length()), SIEVE_BITS[1])
    code = F.xxhash64(F.col("doc_id").cast("long"), F.lit(37))
    cells = ids.select(F.explode(F.array(*[F.shiftright(code, k).bitwiseAND((1 << power) - 1) for k in (0, 32)])).alias("cell"))
    marks = cells.groupBy(F.shiftright("cell", 3).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1, cast(cell & 7 as int))")).alias("mark")).toArrow()
    bits = np.zeros(1 << power - 3, np.uint8)
    bits[marks["at"].to_numpy()] = marks["mark"].to_numpy()
    sent = context.broadcast(bits)

    @F.pandas_udf("boolean")
    def may_be_there(codes: pd.Series) -> pd.Series:
        kept = np.ones(len(codes), bool)
        for k in (0, 32):
            cell = (codes.to_numpy() >> k) & ((1 << power) - 1)
            kept &= (sent.value[cell >> 3] >> (cell & 7) & 1).astype(bool)
        return pd.Series(kept)
    return docs.filter(may_be_there(code))


def training_ids(labels: DataFrame, label: str, id_column: str = "doc_id", most: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, label, weight`` of at most about ``most`` rows outside the held-out fifth, half of them per class.

    Rows are drawn by a hash of the id with a probability per class; ``weight`` is its inverse, so weighted counts
    stand for all labelled rows (``labelled_ids``).
    """
    rows = labelled_ids(labels, label, id_column)
    sizes = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    share = {k: min(1.0, most / 2 / n) for k, n in sizes.items() if k in (0, 1)}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    chance = F.when(F.col("label") == 1, share.get(1, 0.0)).otherwise(F.when(F.col("label") == 0, share.get(0, 0.0)).otherwise(0.0))
    return rows.withColumn("weight", chance).filter(draw < F.col("weight")).withColumn("weight", F.try_divide(F.lit(1.0), F.col("weight")))


def sampled_features(docs: DataFrame, ids: DataFrame, features: Callable, extra: tuple[str, ...] = ()) -> pd.DataFrame:
    """``label, weight, features`` (bytes) of the sampled documents, in the order of their ids.

    The sample is bounded by ``MAX_LABELLED``, so its ids may be broadcast and its features fetched.
    """
    rows = docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label", "weight", *extra)
    schema = "doc_id long, label int, weight double, " + "".join(f"{name} string, " for name in extra) + "features binary"
    out = rows.mapInArrow(features, schema).toPandas()
    return out.drop_duplicates("doc_id").sort_values("doc_id", ignore_index=True)


def logistic(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margins, -60, 60)))


def platt(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities: weighted logistic fit by Newton steps."""
    scale = float(np.sqrt(np.average(margins**2, weights=weights))) or 1.0
    x, ridge = np.stack([margins / scale, np.ones_like(margins)], 1), np.array([1e-3, 1e-6])
    weights = weights / weights.sum()
    beta = np.array([1.0, 0.0])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(weights @ (np.logaddexp(0, z) - labels * z) + 0.5 * ridge @ b**2)
    for _ in range(50):
        p = logistic(x @ beta)
        slope = x.T @ (weights * (p - labels)) + ridge * beta
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step, size = np.linalg.solve(curve, slope), 1.0
        while loss(beta - size * step) > loss(beta) and size > 1e-4:
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def platt_of_rows(rows: DataFrame) -> tuple[float, float]:
    """``platt`` for a table of ``margin, label`` of any size: the sums of a Newton step are one pass of the tasks.

    ``rows`` is read several times: pass a table. Rounded, so that the order of the sums does not show.
    """
    scale = float(np.sqrt(rows.agg(F.avg(F.col("margin") ** 2)).first()[0] or 0)) or 1.0
    x, y, ridge = F.col("margin") / scale, F.col("label"), np.array([1e-3, 1e-6])

    def sums(b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z = x * float(b[0]) + float(b[1])
        p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(60.0)), F.lit(-60.0))))
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - y * z
        got = rows.agg(*[F.avg(c) for c in (loss, x * (p - y), p - y, x * x * p * (1 - p), x * p * (1 - p), p * (1 - p))]).first()
        return got[0] + 0.5 * float(ridge @ b**2), np.array(got[1:3]) + ridge * b, np.array([[got[3], got[4]], [got[4], got[5]]])
    beta = np.array([1.0, 0.0])
    loss, slope, curve = sums(beta)
    for _ in range(50):
        step, size = np.linalg.solve(curve + np.diag(ridge + 1e-9), slope), 1.0
        found = sums(beta - step)
        while found[0] > loss and size > 1e-4:
            size /= 2
            found = sums(beta - size * step)
        beta = beta - size * step
        loss, slope, curve = found
        if np.abs(size * step).max() < 1e-8:
            break
    return round(float(beta[0] / scale), 9), round(float(beta[1]), 9)
