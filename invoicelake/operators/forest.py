"""Isolation forest (Liu, Ting, Zhou 2008) on Spark.

Every tree sees a small random subsample by definition of the method, so growing is one bounded group per
tree. Scoring is the part that grows with the data: all rows pass through the broadcast forest in Arrow batches.

Nothing is drawn from a sequential generator. The feature and the cut of a node are numbers hashed from (seed, tree, node), and a row's place in
the order of a tree is a linear function modulo a prime of two numbers hashed from its key. Any order of the rows, any partitioning, and any other
implementation of the same definition give the same forest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the method.
TREES = 200
SUBSAMPLE = 256
EULER = 0.5772156649

PRIME = 2 ** 31 - 1      # orders of the rows lie below it
DIGITS, ORDER_DIGITS = 13, 7  # hexadecimal digits of a hash that make a draw, and a number of a row

NODES = "tree int, node int, feature int, cut double, size double"


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n values."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    long = 2 * (np.log(np.maximum(safe - 1, 1.0)) + EULER) - 2 * (safe - 1) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def drawn(seed: int, tree: int, *what: int | str) -> float:
    """A number in [0, 1), the same for the same arguments."""
    return int(hashlib.md5(":".join(map(str, (seed, tree, *what))).encode()).hexdigest()[:DIGITS], 16) / 16 ** DIGITS


def subsamples(rows: DataFrame, features: list[str], key: str, seed: int, trees: int = TREES,
               size: int = SUBSAMPLE) -> DataFrame:
    """(tree, x): per tree the ``size`` rows that come first in its order. Rows with a NULL or NaN feature take no part."""
    hashed = F.md5(F.col(key).cast("string"))
    part = [F.conv(F.substring(hashed, 1 + i * ORDER_DIGITS, ORDER_DIGITS), 16, 10).cast("long") for i in range(2)]
    complete = rows.select(F.col(key).cast("string").alias("key"), *(p.alias(f"k{i}") for i, p in enumerate(part)),
                           F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    for i in range(len(features)):
        complete = complete.filter(F.col("x")[i].isNotNull() & ~F.isnan(F.col("x")[i]))
    n = complete.count()
    # about twice the rows a tree needs pass this test, which every row takes once per tree without being copied
    share = min(1.0, (2.0 * size + 40) / max(n, 1))
    limit = math.ceil(share * PRIME)
    factors = np.array([[int(drawn(seed, tree, name) * 16 ** ORDER_DIGITS) for name in "abc"] for tree in range(trees)], np.int64)

    def first_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k0, k1 = (batch.column(c).to_numpy() for c in ("k0", "k1"))
            rows, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for a, b, c in factors:
                place = (a * k0 + b * k1 + c) % PRIME
                rows.append(np.flatnonzero(place < limit))
                places.append(place[rows[-1]])
            tree = np.repeat(np.arange(trees, dtype=np.int32), [len(r) for r in rows[1:]])
            chosen = batch.select(["x", "key"]).take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays([*chosen.columns, pa.array(tree), pa.array(np.concatenate(places))], ["x", "key", "tree", "h"])

    first = complete.mapInArrow(first_of, "x array<double>, key string, tree int, h long")
    nr = F.row_number().over(Window.partitionBy("tree").orderBy("h", "key"))
    return first.withColumn("nr", nr).filter(F.col("nr") <= size).select("tree", "nr", "x")


def grow(rows: DataFrame, features: list[str], key: str, seed: int, trees: int = TREES, size: int = SUBSAMPLE):
    """Nodes of the forest, as (features, subsample size, node table). At most trees * 2 * size nodes."""
    sample = subsamples(rows, features, key, seed, trees, size)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("nr")
        tree = int(group["tree"].iloc[0])
        points = np.array(group["x"].tolist(), dtype=float)
        deepest = math.ceil(math.log2(max(len(points), 2)))
        nodes, open_ = [], [(1, np.arange(len(points)), 0)]
        while open_:
            node, members, depth = open_.pop()
            x = points[members]
            usable = np.flatnonzero(x.max(axis=0) > x.min(axis=0))
            if depth >= deepest or len(members) < 2 or len(usable) == 0:
                nodes.append((tree, node, -1, 0.0, float(len(members))))
                continue
            f = int(usable[int(drawn(seed, tree, node, "feature") * len(usable))])
            low, high = float(x[:, f].min()), float(x[:, f].max())
            cut = low + drawn(seed, tree, node, "cut") * (high - low)
            if cut >= high:  # between neighbouring numbers rounding may end there, and nothing would go right
                cut = low
            left = x[:, f] <= cut
            nodes.append((tree, node, f, cut, float(len(members))))
            open_ += [(2 * node + 1, members[~left], depth + 1), (2 * node, members[left], depth + 1)]
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "size"])

    return features, size, sample.groupBy("tree").applyInPandas(build, NODES)


def score(rows: DataFrame, forest, name: str) -> DataFrame:
    """Add the anomaly score 2 ** (-mean path / average path): larger is odder, always between 0 and 1."""
    features, size, table = forest
    nodes = table.toPandas()                      # bounded by the size of the forest, not by the data
    if nodes.empty:
        return rows.withColumn(name, F.lit(None).cast("double"))
    tree_ids = np.sort(nodes["tree"].unique())
    slots = int(nodes["node"].max()) + 1
    at = (np.searchsorted(tree_ids, nodes["tree"]), nodes["node"].to_numpy())
    feature = np.full((len(tree_ids), slots), -1, dtype=np.int16)
    cut = np.zeros((len(tree_ids), slots))
    leaf = np.zeros((len(tree_ids), slots))
    feature[at], cut[at] = nodes["feature"], nodes["cut"]
    depth = np.floor(np.log2(nodes["node"]))
    leaf[at] = depth + average_path(nodes["size"].to_numpy())
    drawn = float(nodes.loc[nodes["node"] == 1, "size"].max())
    norm = float(average_path(drawn)) or 1.0
    # a leaf leads to itself, whatever the value, so that all rows take the same steps
    inner = feature >= 0
    own = np.broadcast_to(np.arange(slots), feature.shape)
    after = np.stack([np.where(inner, 2 * own, own), np.where(inner, 2 * own + 1, own)], axis=2).astype(np.int32)
    after += np.arange(len(tree_ids), dtype=np.int32)[:, None, None] * slots
    flat = (np.maximum(feature, 0).astype(np.int32).ravel(), cut.ravel(), leaf.ravel(), after.ravel())
    shared = rows.sparkSession.sparkContext.broadcast((*flat, len(tree_ids), slots, int(depth.max()), norm))

    @F.pandas_udf("double")
    def path_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        feature, cut, leaf, after, trees, slots, deepest, norm = shared.value
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            known = ~np.isnan(x).any(axis=1)
            values, row = x.ravel(), np.arange(len(x), dtype=np.int32) * x.shape[1]
            total = np.zeros(len(x))
            for tree in range(trees):
                node = np.full(len(x), tree * slots + 1, dtype=np.int32)
                for _ in range(deepest):
                    right = values.take(row + feature.take(node)) > cut.take(node)
                    node = after.take(2 * node + right)
                total += leaf.take(node)
            result = np.power(2.0, -(total / trees) / norm)
            yield pd.Series(np.where(known, result, np.nan)).astype("Float64").where(known)

    return rows.withColumn(name, path_score.asNondeterministic()(*[F.col(f) for f in features]))
