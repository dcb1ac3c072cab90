"""Exact deduplication by content-defined chunk recipes.

Every text (white space runs made one space) is cut where a rolling hash of its last bytes has a certain pattern, so equal
passages give equal chunks wherever they stand. Only distinct chunks travel: each task sends a chunk once, and
its digest becomes a verified identifier when all chunks with that digest have the same bytes. If two differ, all
digests are taken anew, twice as long. A document is then the ordered list of its identifiers, and texts are equal exactly when
these recipes are. Long repeated documents are never moved as a whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoicelake.llm.common import byte_rows, give_back, later_copies, same, stored, texts, with_row, without_rows

DIGEST_BYTES = 16
CHUNK_BITS = 11  # a boundary every 2,048 bytes on average
LONGEST_CHUNK = 1 << 14
SENT_DIGESTS = 200_000
SEND_BYTES = 1 << 22
_SPACES = re.compile(rb"[\x20\x09-\x0D]+")
_GEAR = np.random.default_rng(40_961).integers(0, 2**32, 256, dtype=np.uint32)


def boundaries(data: np.ndarray) -> list[int]:
    """Ends of the chunks of some bytes; the hash looks at the last 32 bytes only, so cuts move with the content."""
    ends: list[int] = []
    if len(data) > 1 << CHUNK_BITS >> 2:
        rolling = _GEAR[data]
        for k in (1, 2, 4, 8, 16):
            rolling[k:] += rolling[:-k] << np.uint32(k)
        ends = (np.flatnonzero(rolling >> np.uint32(32 - CHUNK_BITS) == 0) + 1).tolist()
    out, start = [], 0
    for end in [*ends, len(data)]:
        out += range(start + LONGEST_CHUNK, end, LONGEST_CHUNK)
        if end > start:
            out.append(end)
        start = end
    return out


def normalised(text: bytes) -> bytes:
    return _SPACES.sub(b" ", text)


def _chunks(text: bytes, size: int) -> Iterator[tuple[bytes, bytes]]:
    data, start = np.frombuffer(text, np.uint8), 0
    for end in boundaries(data):
        piece = text[start:end]
        yield hashlib.blake2b(piece, digest_size=size).digest(), piece
        start = end


def recipes(docs: DataFrame, size: int = DIGEST_BYTES) -> DataFrame:
    """``doc_id, recipe, text_sha256`` per row; the recipe is the digests of its chunks one behind the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_rows(batch.column("text"))
            found, sums = [], []
            for a, b in zip(offsets, offsets[1:]):
                text = normalised(data[a:b].tobytes())
                found.append(b"".join(digest for digest, _ in _chunks(text, size)))
                sums.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary()), pa.array(sums, pa.string())],
                                             ["doc_id", "recipe", "text_sha256"])
        give_back()
    return docs.mapInArrow(run, "doc_id long, recipe binary, text_sha256 string")


def chunks(docs: DataFrame, size: int = DIGEST_BYTES) -> DataFrame:
    """``digest, content`` of the chunks; a task sends a chunk it remembers only once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[bytes, int] = {}
        out: list[tuple[bytes, bytes]] = []
        waiting = 0
        for batch in batches:
            data, offsets = byte_rows(batch.column("text"))
            for a, b in zip(offsets, offsets[1:]):
                for digest, piece in _chunks(normalised(data[a:b].tobytes()), size):
                    # equal digests with equal bytes are one chunk; Python's hash of the bytes tells different ones apart
                    mark = hash(piece)
                    if sent.get(digest) == mark:
                        continue
                    if len(sent) >= SENT_DIGESTS:
                        sent.clear()
                    sent[digest] = mark
                    out.append((digest, piece))
                    waiting += len(piece)
                    if waiting >= SEND_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], ["digest", "content"])
                        out, waiting = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], ["digest", "content"])
        del out, sent
        give_back()
    return docs.mapInArrow(run, "digest binary, content binary")


def conflicts(parts: DataFrame) -> int:
    """How many digests stand for more than one content."""
    distinct = parts.repartition("digest").groupBy("digest", "content").agg(F.lit(1).alias("one"))
    return distinct.groupBy("digest").count().filter("count > 1").count()


def verified_recipes(docs: DataFrame, size: int = DIGEST_BYTES) -> DataFrame:
    """Recipes whose digests have been checked to stand for one content each; stored in the shared folder."""
    while conflicts(chunks(docs, size)):
        size *= 2
        if size > hashlib.blake2b.MAX_DIGEST_SIZE:
            raise ValueError("chunks of different content share their longest digest")
    return stored(recipes(docs, size), "recipes")


def groups(docs: DataFrame, size: int = DIGEST_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after replacing each run of ``[\\x20\\x09-\\x0D]`` by one space; NULL is empty. The smallest doc_id of a
    group stays (a NULL id only if all are NULL); rows that repeat an id share its fate and count in ``group_size``.
    Groups are summed per task first, so one text may fill any share of the rows.
    """
    rows = verified_recipes(texts(docs), size)
    summed = rows.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    summed = stored(summed, "copies")  # a table of its own, so that Spark can split the rows of a large group in the join
    out = rows.join(summed, "recipe", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      same(F.col("doc_id"), keep).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` without the copies; all columns as they are.

    Every row has its own verdict: of equal texts one row stays, the one with the smallest doc_id (rows without an id last), then the first in the
    table. ``docs`` is a table read from files.
    """
    rows, row = with_row(docs)
    copies = groups(rows.select(F.col(row).alias("doc_id"), "text")).filter("group_size > 1").withColumnRenamed("keep_id", "group")
    return without_rows(rows, row, later_copies(rows, row, stored(copies.select("doc_id", "group"), "members")))
