"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word is the sum of rows of a hashed embedding table: one for the word, one for each of its proper prefixes of ``PREFIXES``
bytes, so that endings the training rows have not shown still count. Filters of several widths slide over the words, each keeps its largest
answer over the whole text (rectified), and a linear layer with a logistic gives the score. Thresholds are calibrated by
language on rows the network was not trained on; they decide ``flagged`` and never touch the score.

All labelled rows outside the held-out fifth are trained on, and all of them count in the vocabulary, the calibration and the
thresholds. A few thousand rows are trained on in the driver. More are dealt into parts by a hash of their ids: in every round each part
trains a copy of the network in a task, and the moves of the copies are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from invoicelake.functions.ordering import with_buckets
from invoicelake.llm.common import byte_rows, give_back, held_out, row_groups, stored, word_codes
from invoicelake.llm.labelled import labelled_ids, logistic, platt, platt_of_rows, sieved
from invoicelake.session import cut_lineage

BITS = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (5, 6, 7)
DIMENSION = 16
LEAST_DOCUMENTS = 5
HIDE = 0.4
CUT = 0.5
DRIVER_ROWS = 4_000  # labelled rows the driver trains on alone, at most; with more, all are trained on in the tasks
PART_ROWS = 1 << 14
PART_BYTES = 1 << 26
ROUNDS = 6  # of the parts, at least; with few rows so many that no fewer texts are met than by the driver
BLOCK_CELLS = 1 << 10
FIXED = 1 << 20  # moves are summed as whole numbers, so the order of the sums does not show
BLOCK_WORDS = 1 << 16
GRID_WORDS = 1 << 20
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _bucket(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - BITS)).astype(np.int32)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of every labelled text as bytes, for rows in the order of their ids, the row with the label of an id before its texts.

    Of several texts with one ``doc_id`` the first stays; texts without a label go.
    """
    last_id, last_label = 0, -1
    for batch in batches:
        ids, labels = batch.column("doc_id").to_numpy(), batch.column("label").fill_null(-1).to_numpy()
        id_before, label_before = np.append(last_id, ids)[:-1], np.append(last_label, labels)[:-1]
        chosen = (labels < 0) & (label_before >= 0) & (id_before == ids)
        if len(ids):
            last_id, last_label = ids[-1], labels[-1]
        batch = batch.filter(pa.array(chosen))
        data, offsets = byte_rows(batch.column("text"))
        rows = []
        for first, last in row_groups(offsets):
            codes, counts = word_codes(data, offsets[first:last + 1], _WORD, PREFIXES)
            rows += [part.tobytes() for part in np.split(_bucket(codes).astype(np.uint16), np.cumsum(counts)[:-1])]
        columns = [*(batch.column(k) for k in ("part", "fold", "doc_id")), pa.array(label_before[chosen], pa.int32()), batch.column("lang"), pa.array(rows, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "fold", "doc_id", "label", "lang", "features"])
    give_back()


def _texts(features: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """A row of buckets per word, for every text, without copying."""
    out = []
    for chunk in features.chunks if isinstance(features, pa.ChunkedArray) else [features]:
        data, offsets = byte_rows(chunk)
        out += [data[first:last].view(np.uint16).reshape(-1, 1 + len(PREFIXES)) for first, last in zip(offsets[:-1], offsets[1:])]
    return out


@dataclass
class Network:
    """``row``: embedding row of each hash bucket (0: a rare word); ``filters[i]``: width x dimension x filters."""
    row: np.ndarray
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    output: np.ndarray
    offset: float

    def parameters(self) -> dict[str, np.ndarray]:
        return {"embedding": self.embedding, "bias": self.bias, "output": self.output, **{f"filter{i}": f for i, f in enumerate(self.filters)}}

    def words(self, rows: np.ndarray) -> np.ndarray:
        """Vectors of words, given their rows of the table (one column per code of a word)."""
        total = self.embedding.take(rows[..., 0], axis=0)
        for k in range(1, rows.shape[-1]):
            total += self.embedding.take(rows[..., k], axis=0)
        return total

    def pooled(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Largest answer of every filter over each text of ``counts`` words, 0 at least (so also for an empty text).

        Words are taken in blocks of ``BLOCK_WORDS`` that overlap by the filter width; filters do not reach over the end of a text.
        """
        text = np.repeat(np.arange(len(counts)), counts)
        out = np.zeros((len(counts), len(self.bias)), np.float32)
        for start in range(0, len(words), BLOCK_WORDS):
            stop = min(start + BLOCK_WORDS + max(WIDTHS) - 1, len(words))
            own, of = self.words(words[start:stop]), text[start:stop]
            for i, width in enumerate(WIDTHS):
                n = min(len(own) - width + 1, BLOCK_WORDS)
                if n <= 0:
                    continue
                total = own[:n] @ self.filters[i][0]
                for k in range(1, width):
                    total += own[k:n + k] @ self.filters[i][k]
                whole = of[:n] == of[width - 1:n + width - 1]
                total, at = total[whole], of[:n][whole]
                if not len(at):
                    continue
                heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                best = np.maximum.reduceat(total, heads, axis=0) + self.bias[i * FILTERS:(i + 1) * FILTERS]
                cells = out[at[heads], i * FILTERS:(i + 1) * FILTERS]
                out[at[heads], i * FILTERS:(i + 1) * FILTERS] = np.maximum(cells, best)
        return out

    def margins(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.pooled(words, counts).astype(np.float64) @ self.output + self.offset


def _documents_with(texts: list[np.ndarray]) -> np.ndarray:
    """How many of the texts hold each bucket."""
    seen, here = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, bool)
    for words in texts:
        here[words] = True
        found = np.flatnonzero(here)
        here[found] = False
        seen[found] += 1
    return seen


def _initial(texts: list[np.ndarray], seed: int) -> Network:
    return _fresh(_documents_with(texts), seed)


def _fresh(seen: np.ndarray, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    row = np.zeros(1 << BITS, np.int32)
    common = np.flatnonzero(seen >= LEAST_DOCUMENTS)
    common = common[common > 0]
    row[common] = np.arange(1, len(common) + 1)
    embedding = rng.normal(0, 0.1, (len(common) + 1, DIMENSION)).astype(np.float32)
    embedding[0] = 0
    filters = [rng.normal(0, (1 / (w * DIMENSION)) ** 0.5, (w, DIMENSION, FILTERS)).astype(np.float32) for w in WIDTHS]
    size = FILTERS * len(WIDTHS)
    return Network(row, embedding, filters, np.zeros(size, np.float32), rng.normal(0, 0.1, size), 0.0)


def _batches(lengths: np.ndarray, most: int) -> list[np.ndarray]:
    """Texts of similar length together: ``most`` at most, and no more than ``GRID_WORDS`` words with the padding unless one text has more."""
    out: list[list[int]] = []
    for i in np.argsort(lengths, kind="stable").tolist():
        if out and len(out[-1]) < most and (len(out[-1]) + 1) * lengths[i] <= GRID_WORDS:
            out[-1].append(i)
        else:
            out.append([i])
    return [np.array(group) for group in out]


def _windows(net: Network, grid: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Largest answer of every filter over each padded text, 0 at least, and per width the first word of the window that gave it.

    The words of a batch are taken in blocks of about ``BLOCK_WORDS``, so a long text costs no more memory than its place in the grid.
    """
    longest = grid.shape[1] - max(WIDTHS) + 1
    size = max(BLOCK_WORDS // len(grid), 1)
    pooled = np.zeros((len(grid), len(net.bias)), net.bias.dtype)
    where = [np.zeros((len(grid), FILTERS), np.int64) for _ in WIDTHS]
    for start in range(0, longest, size):
        n = min(size, longest - start)
        vectors = net.words(grid[:, start:start + n + max(WIDTHS) - 1])
        for i, width in enumerate(WIDTHS):
            total = vectors[:, :n] @ net.filters[i][0]
            for k in range(1, width):
                total += vectors[:, k:n + k] @ net.filters[i][k]
            total += net.bias[i * FILTERS:(i + 1) * FILTERS]
            total[np.arange(start, start + n)[None, :] > (lengths - width)[:, None]] = 0
            at = total.argmax(1)
            best, cells = np.take_along_axis(total, at[:, None, :], 1)[:, 0, :], pooled[:, i * FILTERS:(i + 1) * FILTERS]
            better = best > cells
            cells[better], where[i][better] = best[better], at[better] + start
    return pooled, where


def _gradient(net: Network, grid: np.ndarray, lengths: np.ndarray, labels: np.ndarray, weights: np.ndarray,
              kept: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Slopes of the weighted mean logistic loss of a batch by parameter, and of the offset; ``kept`` scales the pooled answers.

    Only the winning window of a filter gets a slope, so the backward pass touches one window per text and filter.
    """
    pooled, where = _windows(net, grid, lengths)
    hidden = pooled * kept
    error = (logistic(hidden @ net.output + net.offset) - labels) * weights / len(grid)
    slopes = {k: np.zeros_like(v) for k, v in net.parameters().items()}
    slopes["output"] = hidden.T @ error + 1e-4 * net.output
    back = (error[:, None] * net.output[None, :] * kept * (pooled > 0)).astype(net.bias.dtype)
    slopes["bias"] = back.sum(0)
    for i, width in enumerate(WIDTHS):
        own = back[:, i * FILTERS:(i + 1) * FILTERS]
        for k in range(width):
            rows = grid[np.arange(len(grid))[:, None], where[i] + k]
            slopes[f"filter{i}"][k] = np.einsum("bfd,bf->df", net.words(rows), own)
            share_of_row = own[:, :, None] * net.filters[i][k].T[None, :, :]
            for c in range(rows.shape[-1]):
                np.add.at(slopes["embedding"], rows[..., c], share_of_row)
    slopes["embedding"][0] = 0
    return slopes, float(error.sum())


def _batch(net: Network, texts: list[np.ndarray], chosen: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding rows of some texts, padded, with a share ``HIDE`` of the words hidden; their lengths; the pooled answers that are kept."""
    lengths = np.array([len(texts[i]) for i in chosen])
    grid = np.zeros((len(chosen), max(lengths.max(), 1) + max(WIDTHS) - 1, 1 + len(PREFIXES)), np.int32)
    for r, i in enumerate(chosen):
        grid[r, :len(texts[i])] = net.row[texts[i]] * (rng.random((len(texts[i]), 1)) >= HIDE)
    return grid, lengths, (rng.random((len(chosen), len(net.bias))) < 0.8) / 0.8


def _balance(labels: np.ndarray, share: float) -> np.ndarray:
    return np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))


def _train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 0, rounds: int = 16, batch: int = 32, rate: float = 0.01) -> Network:
    """Adam on the logistic loss with balanced classes. In every round a share ``HIDE`` of the words is hidden, so that no
    text is learned by heart from a few words. Beside the texts it holds one batch at a time."""
    net, rng = _initial(texts, seed), np.random.default_rng(seed)
    balance = _balance(labels, labels.mean())
    named = net.parameters()
    steps = 0
    first, second = ({k: np.zeros_like(v) for k, v in named.items()} for _ in range(2))
    groups = _batches(np.array([len(words) for words in texts]), batch)
    for turn in range(rounds):
        for g in rng.permutation(len(groups)):
            chosen = groups[g]
            grid, lengths, kept = _batch(net, texts, chosen, rng)
            slopes, offset_slope = _gradient(net, grid, lengths, labels[chosen], balance[chosen], kept)
            steps += 1
            pace = rate * (1 - turn / rounds) * (1 - 0.999**steps) ** 0.5 / (1 - 0.9**steps)
            for name, value in named.items():
                first[name] += 0.1 * (slopes[name] - first[name])
                second[name] += 0.001 * (np.square(slopes[name]) - second[name])
                value -= pace * first[name] / (np.sqrt(second[name]) + 1e-8)
            net.offset -= rate * (1 - turn / rounds) * offset_slope
    return net


def _round(shared: Network, texts: list[np.ndarray], labels: np.ndarray, balance: np.ndarray, rng: np.random.Generator, rate: float,
           batch: int = 32) -> Network:
    """A copy of ``shared`` after one round over the texts of a part: as in ``_train``, but of the embedding a step touches only the rows
    that got a slope, so that its cost does not grow with the vocabulary."""
    net = replace(shared, **{name: getattr(shared, name).copy() for name in ("embedding", "bias", "output")}, filters=[f.copy() for f in shared.filters])
    named = net.parameters()
    first, second = ({k: np.zeros_like(v) for k, v in named.items()} for _ in range(2))
    here, place = np.zeros(len(net.embedding), bool), np.zeros(len(net.embedding), np.int32)
    groups = _batches(np.array([len(words) for words in texts]), batch)
    for steps, g in enumerate(rng.permutation(len(groups)), 1):
        chosen = groups[g]
        grid, lengths, kept = _batch(net, texts, chosen, rng)
        here[0] = here[grid] = True
        used = np.flatnonzero(here)
        here[used], place[used] = False, np.arange(len(used))
        slopes, offset_slope = _gradient(replace(net, embedding=net.embedding[used]), place[grid], lengths, labels[chosen], balance[chosen], kept)
        pace = rate * (1 - 0.999**steps) ** 0.5 / (1 - 0.9**steps)
        for name, value in named.items():
            at, slope = ..., slopes[name]
            if name == "embedding":
                moved = slope.any(axis=1)
                at, slope = used[moved], slope[moved]
            first[name][at] += 0.1 * (slope - first[name][at])
            second[name][at] += 0.001 * (np.square(slope) - second[name][at])
            value[at] -= pace * first[name][at] / (np.sqrt(second[name][at]) + 1e-8)
        net.offset -= rate * offset_slope
    return net


@dataclass
class Model:
    """The network, its logistic calibration, and the score from which a text of a language is flagged ('' for others)."""
    network: Network | None
    slope: float
    offset: float
    thresholds: dict[str, float]

    def scores(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.network is None:
            return logistic(np.full(len(counts), self.offset))
        return logistic(self.slope * self.network.margins(self.network.row[words], counts) + self.offset)


def _threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The cut with the best F1; midway to the next lower score."""
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], (weights * labels)[order]
    f1 = 2 * np.cumsum(hit) / (np.cumsum(weights[order]) + hit.sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    best = int(np.argmax(f1))
    return float((s[best] + (s[best + 1] if best + 1 < len(s) else 0)) / 2)


def _cells(net: Network) -> np.ndarray:
    """All parameters as rows of ``DIMENSION`` numbers, those of the embedding first."""
    rest = np.concatenate([*(f.ravel() for f in net.filters), net.bias, net.output, [net.offset]])
    return np.concatenate([net.embedding, np.append(rest, np.zeros(-len(rest) % DIMENSION)).reshape(-1, DIMENSION)], dtype=np.float64)


def _with_cells(net: Network, cells: np.ndarray) -> Network:
    rest = cells[len(net.embedding):].ravel()
    ends = np.cumsum([f.size for f in net.filters] + [len(net.bias), len(net.output)])
    *filters, bias, output, offset = np.split(rest[:ends[-1] + 1], ends)
    return Network(net.row, cells[:len(net.embedding)].astype(np.float32), [f.reshape(own.shape).astype(np.float32) for f, own in zip(filters, net.filters)],
                   bias.astype(np.float32), output, float(offset[0]))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of a task by part. A part lies in one file and fills at most a few batches (``PART_ROWS``, ``PART_BYTES``)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        parts = batch.column("part").to_numpy()
        heads = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
        for first, last in zip(heads[:-1], heads[1:]):
            if first == last:
                continue
            if held and held[0].column("part")[0].as_py() != parts[first]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held)


def _vocabularies(rows: DataFrame, folds: int) -> np.ndarray:
    """How many documents of each fold hold each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            texts, fold = _texts(part["features"]), part["fold"].to_numpy()
            for k in range(folds):
                seen = _documents_with([texts[i] for i in np.flatnonzero(fold == k)])
                found = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), k), pa.int32()), pa.array(found, pa.int32()), pa.array(seen[found])],
                                                 ["fold", "bucket", "n"])
        give_back()
    out = np.zeros((folds, 1 << BITS), np.int64)
    got = rows.mapInArrow(run, "fold int, bucket int, n long").groupBy("fold", "bucket").agg(F.sum("n").alias("n")).toArrow()
    out[got["fold"].to_numpy(), got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, mostly small: their bytes by place and compressed, so that the empty places cost nothing."""
    values = values.ravel()
    return pa.Codec("zstd").compress(((values << 1) ^ (values >> 63)).view(np.uint8).reshape(-1, 8).T.tobytes(), asbytes=True)


def _unpacked(data: bytes, count: int) -> np.ndarray:
    places = np.frombuffer(pa.Codec("zstd").decompress(data, 8 * count), np.uint8).reshape(8, count)
    values = np.ascontiguousarray(places.T).view(np.int64).ravel()
    return (values >> 1 & (1 << 63) - 1) ^ -(values & 1)


def _averaged_round(rows: DataFrame, net: Network, k: int, share: float, turn: int, rounds: int, rate: float = 0.01) -> Network:
    """Network ``k``, which does not see the rows of fold k, after one round over all parts. A parameter moves by the mean of its moves in
    the parts that moved it.

    A task sends the sums of its parts in blocks of ``BLOCK_CELLS`` rows of ``DIMENSION`` numbers, with the parts that moved a row as
    one more number; the driver gets the means.
    """
    pace = rate * (1 - turn / rounds)
    sent = rows.sparkSession.sparkContext.broadcast(net)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in _parts(batches):
            own, texts = np.flatnonzero(part["fold"].to_numpy() != k), _texts(part["features"])
            if not len(own):
                continue
            y, seed = part["label"].to_numpy()[own], [k, turn, part["part"][0].as_py()]
            before = _cells(sent.value)
            after = _round(sent.value, [texts[i] for i in own], y, _balance(y, share), np.random.default_rng(seed), pace)
            moves = np.rint((_cells(after) - before) * FIXED).astype(np.int64)
            if total is None:
                total = np.zeros((-(-len(moves) // BLOCK_CELLS) * BLOCK_CELLS, DIMENSION + 1), np.int64)
            total[:len(moves), :DIMENSION] += moves
            total[:len(moves), DIMENSION] += moves.any(axis=1)
        if total is not None:
            for block, own in enumerate(total.reshape(-1, BLOCK_CELLS, DIMENSION + 1)):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([_packed(own)], pa.binary())], ["block", "moves"])
        give_back()

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, moves in zip(batch.column("block").to_pylist(), batch.column("moves")):
                own = totals.setdefault(block, np.zeros((BLOCK_CELLS, DIMENSION + 1), np.int64))
                own += _unpacked(moves.as_py(), own.size).reshape(own.shape)
        for block, own in totals.items():
            means = (own[:, :DIMENSION] / (np.maximum(own[:, DIMENSION:], 1) * FIXED)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([means.tobytes()], pa.binary())], ["block", "moves"])
    got = rows.mapInArrow(train, "block int, moves binary").repartition("block").mapInArrow(mean, "block int, moves binary").toArrow()
    sent.destroy()
    cells = _cells(net)
    for block, moves in zip(got["block"].to_pylist(), got["moves"].to_pylist()):
        own = cells[block * BLOCK_CELLS:(block + 1) * BLOCK_CELLS]
        own += np.frombuffer(moves, np.float32).reshape(-1, DIMENSION)[:len(own)]
    return _with_cells(net, cells)


def _unseen_margins(rows: DataFrame, nets: dict[int, Network]) -> DataFrame:
    """``lang, label, margin`` of all rows, by the network that was not trained on their fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, fold, margins = _texts(batch.column("features")), batch.column("fold").to_numpy(), np.zeros(batch.num_rows)
            for k, net in nets.items():
                for i in np.flatnonzero(fold == k):
                    margins[i] = net.margins(net.row[texts[i]], np.array([len(texts[i])]))[0]
            yield pa.RecordBatch.from_arrays([batch.column("lang").fill_null(""), batch.column("label"), pa.array(margins)], ["lang", "label", "margin"])
        give_back()
    return rows.mapInArrow(run, "lang string, label int, margin double")


def _thresholds(scored: DataFrame, least_of_language: int) -> dict[str, float]:
    """``_threshold`` of all rows ('') and of every language with enough rows of label 1, for a table of ``lang, label, score`` of any size."""
    by_language = scored.groupBy("lang", "score").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
    whole = scored.groupBy("score").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
    counts = cut_lineage(by_language.filter("lang != ''").unionByName(whole.withColumn("lang", F.lit(""))))
    totals = counts.groupBy("lang").agg(F.sum("hits").alias("all_hits")).filter((F.col("all_hits") >= least_of_language) | (F.col("lang") == ""))
    bucketed = with_buckets(counts.join(totals, "lang"), "score")
    order = Window.partitionBy("lang").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (bucketed.groupBy("lang", "_bucket").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
              .select("lang", "_bucket", *[F.coalesce(F.sum(c).over(order), F.lit(0)).alias(f"{c}_before") for c in ("n", "hits")]))
    inside = Window.partitionBy("lang", "_bucket").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    n, hits = (F.col(f"{c}_before") + F.sum(c).over(inside) for c in ("n", "hits"))
    best = (bucketed.join(before, ["lang", "_bucket"]).select("lang", "score", (2 * hits / (n + F.col("all_hits"))).alias("f1"))
            .groupBy("lang").agg(F.max(F.struct("f1", "score"))["score"].alias("best")))
    below = F.coalesce(F.max(F.when(F.col("score") < F.col("best"), F.col("score"))), F.lit(0.0))
    return {row["lang"]: row["cut"] for row in counts.join(best, "lang").groupBy("lang", "best").agg(((F.col("best") + below) / 2).alias("cut")).collect()}


def _constant(rows: int, ones: int) -> Model:
    share = ones / rows if rows else 0.5
    return Model(None, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))), {"": CUT})


def _fit_rows(sample: pd.DataFrame, folds: int, least_of_language: int) -> Model:
    """``fit`` in the driver, on no more rows than one part holds."""
    y = sample["label"].to_numpy(int)
    if len(set(y.tolist())) < 2:
        return _constant(len(y), int(y.sum()))
    weights, rows = np.ones(len(y)), _texts(pa.array(sample["features"], pa.binary()))
    part, margins = np.arange(len(y)) % folds, np.zeros(len(y))
    for k in range(folds):
        chosen, rest = np.flatnonzero(part != k), np.flatnonzero(part == k)
        if len(set(y[chosen].tolist())) == 2 and len(rest):
            net = _train([rows[i] for i in chosen], y[chosen], k)
            margins[rest] = [net.margins(net.row[rows[i]], np.array([len(rows[i])]))[0] for i in rest]
    slope, offset = platt(margins, y.astype(float), weights)
    scores, lang = logistic(slope * margins + offset), sample["lang"].fillna("").to_numpy(str)
    thresholds = {"": _threshold(scores, y, weights)}
    for name in sorted(set(lang) - {""}):
        own = lang == name
        if y[own].sum() >= least_of_language:
            thresholds[name] = _threshold(scores[own], y[own], weights[own])
    return Model(_train(rows, y, folds), slope, offset, thresholds)


def _fit_parts(rows: DataFrame, folds: int, least_of_language: int) -> Model:
    """``fit`` in the tasks, on a stored table of parts: the driver holds the networks, never rows."""
    sizes = np.zeros((folds, 2), np.int64)
    for row in rows.groupBy("fold", "label").count().collect():
        sizes[row["fold"], row["label"]] = row["count"]
    if not sizes.sum(0).all():
        return _constant(int(sizes.sum()), int(sizes[:, 1].sum()))
    trained = {k: np.arange(folds) != k for k in range(folds + 1)}
    seen = _vocabularies(rows, folds)
    nets = {k: _fresh(seen[own].sum(0), k) for k, own in trained.items() if sizes[own].sum(0).all()}
    shares = {k: sizes[trained[k], 1].sum() / sizes[trained[k]].sum() for k in nets}
    rounds = max(ROUNDS, -(-16 * DRIVER_ROWS // int(sizes.sum())))
    for k in nets:
        for turn in range(rounds):
            nets[k] = _averaged_round(rows, nets[k], k, shares[k], turn, rounds)
    give_back()
    whole = nets.pop(folds)
    margins = stored(_unseen_margins(rows, nets), "margins")
    slope, offset = platt_of_rows(margins)
    z = F.greatest(F.least(slope * F.col("margin") + offset, F.lit(60.0)), F.lit(-60.0))
    return Model(whole, slope, offset, _thresholds(margins.withColumn("score", 1 / (1 + F.exp(-z))), least_of_language))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 2, least_of_language: int = 20) -> Model:
    """Train on all labelled rows outside the held-out fifth; a document that comes twice counts once.

    Every row is also scored by a network that was trained on the other folds; these scores fix the calibration and the
    thresholds. A language with fewer than ``least_of_language`` rows of label 1 takes the threshold of all rows. Without labels,
    or with one class only, every text gets the share of label 1 (0.5 without labels).
    """
    ids = stored(labelled_ids(labels, label).filter(F.col("label").isin(0, 1)), "labelled-ids")  # a table, so Spark knows its size
    open_docs = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    lengths = open_docs.select("doc_id", F.octet_length("text").alias("bytes")).join(ids, "doc_id")
    size = lengths.agg(F.count("*").alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    small = size["rows"] <= DRIVER_ROWS and size["bytes"] <= PART_BYTES
    parts = 1 if small else max(-(-size["rows"] // PART_ROWS), -(-size["bytes"] // PART_BYTES))
    named = ids.select("doc_id", F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("lang"), "label")
    both = sieved(open_docs, ids).withColumn("label", F.lit(None).cast("int")).unionByName(named)  # texts meet their labels where they are dealt to: they move once
    dealt = (both.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(parts)).cast("int"))
             .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(folds)).cast("int"))
             .repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id", F.col("label").isNull(), F.xxhash64("text"), "text"))
    found = (dealt.select("part", "fold", "doc_id", "label", "lang", "text")
             .mapInArrow(_feature_batches, "part int, fold int, doc_id long, label int, lang string, features binary"))
    return _fit_rows(found.toPandas(), folds, least_of_language) if small else _fit_parts(stored(found, "labelled", "zstd"), folds, least_of_language)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``score``, from the whole text alone. NULL and empty texts are scored too."""
    fields = [f for f in docs.schema.fields if f.name != "score"]
    names = [f.name for f in fields]
    schema = StructType([*fields, StructField("score", DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_rows(batch.column("text"))
            parts = [np.empty(0)]
            for first, last in row_groups(offsets):
                codes, counts = word_codes(data, offsets[first:last + 1], _WORD, PREFIXES)
                parts.append(model.scores(_bucket(codes), counts))
            score = pa.array(np.concatenate(parts), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), score], [*names, "score"])
    return docs.select(*names).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted, threshold, flagged`` per document; one narrow pass over the texts after the fit.

    ``predicted`` compares with ``cut``, ``flagged`` with the threshold of the row's language.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    model = fit(rows, labels)
    scored = scores(rows, model).drop("text")
    threshold = F.lit(model.thresholds[""])
    for name, value in sorted(model.thresholds.items()):
        threshold = F.when(F.col("lang") == name, value).otherwise(threshold) if name else threshold
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"), threshold.alias("threshold"),
                         (F.col("score") >= threshold).alias("flagged"))
