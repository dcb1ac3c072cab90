"""Quality classifier: naive Bayes support vectors over n-grams.

A document is the set of its hashed byte n-grams and of its repetition n-grams: each word is replaced by 1 if it equals
the word before, 2 if it equals the one before that, else 0, and the n-grams of these signs are indicators too. Every n-gram indicator is scaled by the log ratio of its class counts,
the rows are brought to length one, and a linear hinge-loss model is fitted by dual coordinate descent. Margins become
probabilities by a logistic fit on margins of rows the model has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from invoicelake.llm.common import _BYTE_CODE, _STEP, byte_rows, give_back, held_out, mixed, row_groups, unused, word_codes
from invoicelake.llm.labelled import logistic, platt, sampled_features, training_ids

BITS = 18
SIZES = (2, 4)
REPEATS = (3, 6)
CUT = 0.3
_LONG = 4 << 20
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
CELLS = (1 << BITS) + sum(3**n for n in REPEATS)


def _grams(piece: np.ndarray) -> np.ndarray:
    """Hash buckets of all n-grams of some bytes."""
    codes, out = _BYTE_CODE[piece], []
    for n in SIZES:
        if len(piece) < n:
            continue
        total = codes[:len(codes) - n + 1].copy()
        for k in range(1, n):
            total *= _STEP
            total += codes[k:len(codes) - n + 1 + k]
        out.append((mixed(total + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _distinct(buckets: np.ndarray, stamp: np.ndarray) -> np.ndarray:
    """Distinct values; ``stamp`` is scratch space with a cell per bucket."""
    place = np.arange(len(buckets), dtype=np.int64)
    stamp[buckets] = place
    return buckets[stamp[buckets] == place]


def _repeats(words: np.ndarray) -> np.ndarray:
    """Cells of the repetition n-grams of the word codes of a text."""
    signs = np.zeros(len(words), np.int64)
    signs[2:][words[2:] == words[:-2]] = 2
    signs[1:][words[1:] == words[:-1]] = 1
    out, base = [], 1 << BITS
    for n in REPEATS:
        if len(words) >= n:
            out.append(base + sum(signs[k:len(signs) - n + 1 + k] * 3**k for k in range(n)))
        base += 3**n
    return np.concatenate(out) if out else np.empty(0, np.int64)


def indicators(text: np.ndarray, words: np.ndarray, stamp: np.ndarray) -> np.ndarray:
    """The distinct n-gram cells of a text; a text of many megabytes is taken in overlapping pieces."""
    parts = [_distinct(_grams(text[i:i + _LONG + max(SIZES) - 1]), stamp) for i in range(0, len(text), _LONG)]
    return _distinct(np.concatenate([*parts, _repeats(words)]), stamp)


def _rows(column: pa.Array) -> Iterator[np.ndarray]:
    stamp = np.zeros(CELLS, np.int64)
    data, offsets = byte_rows(column)
    for first, last in row_groups(offsets):
        own = offsets[first:last + 1]
        codes, counts = word_codes(data, own, _WORD)
        ends = np.append(0, np.cumsum(counts))
        for k in range(last - first):
            yield indicators(data[own[k]:own[k + 1]], codes[ends[k]:ends[k + 1]], stamp)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [found.astype(np.int32).tobytes() for found in _rows(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("doc_id", "label", "weight")), pa.array(rows, pa.binary())],
                                         ["doc_id", "label", "weight", "features"])


@dataclass
class Model:
    """``table``: weight of each bucket times its scale; ``scale``: log-count ratios; the rest: margin to probability."""
    table: np.ndarray
    scale: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        length = float(np.sqrt(np.square(self.scale[found]).sum())) or 1.0
        return float(self.table[found].sum()) / length + self.bias


def _descend(rows: list[np.ndarray], signs: np.ndarray, scale: np.ndarray, cost: np.ndarray, rounds: int, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for hinge loss; a constant feature of length one carries the bias."""
    values = []
    for found in rows:
        v = scale[found]
        values.append((v / (float(np.sqrt(np.square(v).sum())) or 1.0)).astype(np.float32))
    weights, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    curve = np.array([1.0 + float(v @ v) for v in values])
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            found, v, y = rows[i], values[i], signs[i]
            slope = y * (float(weights[found] @ v) + bias) - 1.0
            fresh = min(max(alpha[i] - slope / curve[i], 0.0), cost[i])
            step = (fresh - alpha[i]) * y
            if step:
                weights[found] += step * v
                bias += step
                alpha[i] = fresh
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def _ratios(rows: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    sums = [np.full(CELLS, smooth), np.full(CELLS, smooth)]
    for found, label in zip(rows, labels):
        sums[label][found] += 1
    return np.log(sums[1] / sums[1].sum()) - np.log(sums[0] / sums[0].sum())


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", cost: float = 10.0, rounds: int = 15, folds: int = 3) -> Model:
    """Fit on a bounded labelled sample (``labelled.MAX_LABELLED`` rows, none of them held out).

    With no labelled rows, or one class only, every text gets the share of label 1 (0.5 without labels).
    """
    sample = sampled_features(docs, training_ids(labels, label), _feature_batches)
    empty = np.zeros(CELLS)
    y = sample["label"].to_numpy(int)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(empty, empty, 0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    rows = [np.frombuffer(b, np.int32) for b in sample.pop("features")]
    signs, part = np.where(y == 1, 1.0, -1.0), np.arange(len(y)) % folds
    margins = np.zeros(len(y))

    def model(chosen: np.ndarray, seed: int) -> Model:
        own, own_y = [rows[i] for i in chosen], y[chosen]
        scale = _ratios(own, own_y)
        balance = np.where(own_y == 1, (own_y == 0).sum(), (own_y == 1).sum()) / len(own_y) * 2
        weights, bias = _descend(own, signs[chosen], scale, cost * balance, rounds, seed)
        return Model(weights * scale, scale, bias, 1.0, 0.0)
    for k in range(folds):
        chosen, rest = np.flatnonzero(part != k), np.flatnonzero(part == k)
        if len(set(y[chosen].tolist())) == 2:
            fold = model(chosen, k)
            margins[rest] = [fold.margin(rows[i]) for i in rest]
    whole = model(np.arange(len(y)), folds)
    whole.slope, whole.offset = platt(margins, y.astype(float), sample["weight"].to_numpy(float))
    return whole


def scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a new column: the probability of label 1, from the text alone. NULL and empty texts are scored too."""
    names = docs.columns
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = np.array([model.margin(found) for found in _rows(batch.column("text"))])
            score = logistic(model.slope * margins + model.offset)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(score, pa.float64())], [*names, name])
        give_back()
    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document; one narrow pass over the texts after the fit."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    scored = scores(rows, fit(rows, labels)).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score at least ``cut``, all columns as they are; no row is moved."""
    model = fit(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), labels)
    name = unused("__score", docs.columns)
    return scores(docs, model, name).filter(F.col(name) >= cut).drop(name)
