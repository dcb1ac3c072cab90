"""Helpers of the subpackage: stored intermediates, null-safe keys, and byte-level work on Arrow batches."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from invoicelake.session import shared_folder

PIECE_BYTES = 1 << 20

_rng = np.random.default_rng(20_011)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one, so that two runs never meet."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files: lost executors then cost tasks, not the job."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder, compression=compression)
    return spark.read.schema(df.schema).parquet(folder)


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The two columns the operators work on, whatever else the table has; a NULL text counts as empty."""
    return docs.select(F.col(id_column).alias("doc_id"),
                       F.coalesce(F.col(text_column), F.lit("")).alias("text"))


def unused(name: str, columns: list[str]) -> str:
    """``name``, or a longer one where a table has that column already."""
    while name.lower() in {column.lower() for column in columns}:
        name += "_"
    return name


def with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for every row, and the name of that column: rows that share an id, have none, or are equal are told apart.

    The number is the row's place in the scan, so ``docs`` has to be a table read from files. Scans are cut by the number of cores, which falls
    when an executor is lost; the number of the first call is therefore kept for the session, so that places do not change between two reads.
    """
    conf = docs.sparkSession.conf
    if conf.get("spark.sql.files.minPartitionNum", None) is None:
        conf.set("spark.sql.files.minPartitionNum", str(docs.sparkSession.sparkContext.defaultParallelism))
    name = unused("__row", docs.columns)
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def without_rows(docs: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """``docs`` (see ``with_row``) without the rows whose numbers are in the first column of ``dropped``.

    The numbers are a table of their own, so their size is known when the join is planned: Spark broadcasts a small one, and no text moves.
    """
    return docs.join(stored(dropped.toDF(row), "dropped"), row, "left_anti").select(*(c for c in docs.columns if c != row))


def later_copies(docs: DataFrame, row: str, groups: DataFrame) -> DataFrame:
    """Of ``groups`` (doc_id: the number of a row, group) all rows but the first of each group, by doc_id (none last), then place."""
    ids = docs.select(F.col(row).alias("at"), F.col("doc_id").alias("id"))
    member = groups.select(F.col("doc_id").alias("at"), "group").join(ids, "at")
    first = member.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "at")).alias("first"))
    return member.select("at").join(first.select(F.col("first.at").alias("at")), "at", "left_anti")


def same(left: Column, right: Column) -> Column:
    """Equal keys; a NULL id is an id like any other."""
    return left.eqNullSafe(right)


def held_out(doc_id: Column) -> Column:
    """One document in five, by the checksum of its id, is kept from every fit."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without copying, and the row offsets in them."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
    return data, offsets


def row_groups(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes, one row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def give_back() -> None:
    """Hand the memory a worker has freed back to the system. Python workers live on between tasks, and would otherwise keep the
    work space of one stage beside the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit codes."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(count: int) -> np.ndarray:
    out = np.full(count, _STEP, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(1 << 16)


def word_codes(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray,
               prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of the words of every row (A-Z lower-cased), and how many words each row has.

    ``is_word`` tells for each byte value whether it belongs to a word. With ``prefixes`` every word has a row of codes:
    its own, then one per prefix of so many bytes, 0 where the word is no longer than that. Work arrays hold about ``PIECE_BYTES`` bytes at a
    time: rows are taken in groups, and a longer row is cut where a word ends.
    """
    codes, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for first, last in row_groups(offsets):
        start, stop = int(offsets[first]), int(offsets[last])
        while start < stop:
            cut = stop
            if stop - start > 2 * PIECE_BYTES:
                gap = np.flatnonzero(~is_word[data[start + PIECE_BYTES:stop]])
                cut = start + PIECE_BYTES + int(gap[0]) if len(gap) else stop
            piece = data[start:cut]
            inside = is_word[piece]
            starts = inside.copy()
            starts[1:] &= ~inside[:-1]
            heads = offsets[first:last] - start
            heads = heads[(heads > 0) & (heads < len(piece))]
            starts[heads] = inside[heads]
            begin = np.flatnonzero(starts)
            if len(begin):
                kept = _LOWER[piece[inside]]
                rank = np.cumsum(inside) - 1
                first_of = rank[begin]
                lengths = np.diff(np.append(first_of, len(kept)))
                place = np.arange(len(kept)) - np.repeat(first_of, lengths)
                total = np.append(np.uint64(0), np.cumsum(_BYTE_CODE[kept] * _POWER[place & 0xFFFF]))
                code = mixed(total[first_of + lengths] - total[first_of])
                if prefixes:
                    parts = [np.where(lengths > k, mixed(total[first_of + np.minimum(k, lengths)] - total[first_of] + np.uint64(k)), np.uint64(0))
                             for k in prefixes]
                    code = np.stack([code, *parts], 1)
                codes.append(code)
                counts[first:last] += np.histogram(begin, np.append(offsets[first:last] - start, offsets[last] - start))[0] \
                    if last - first > 1 else len(begin)
            start = cut
    shape = (0, 1 + len(prefixes)) if prefixes else (0,)
    return (np.concatenate(codes) if codes else np.empty(shape, np.uint64)), counts
