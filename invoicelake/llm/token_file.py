"""Token ids as Arrow files of equal-length sequences and masks.

A written folder has, for every shard, ``part-NNNNN.tokens.arrow`` (record batches of ``ROWS`` sequences, each a fixed-size list of
``length`` ids and its mask of ``length`` bytes, 1 or 0; the last sequence of a shard is filled with 0 and masked) and
``part-NNNNN.docs.arrow`` (doc_id, first id in the shard, number of ids, in doc_id order). Fixed-size lists lie contiguously, so
the sequence i of a shard is a slice of a memory-mapped file. The masks are an Arrow dictionary: a shard has two at most, that of a full sequence
and that of its last one, so every sequence stores one byte and its mask is a view of the shared values. Ids are unsigned 16-bit where the
vocabulary allows it.

Shards follow each other in doc_id order. A task writes under a name of its own and renames at the end, so a task that is
run again, or twice at once, leaves the same files.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from invoicelake.llm.common import give_back, stored, texts
from invoicelake.llm.tokens import Encoder

LENGTH = 2048
ROWS = 256


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the path in it; local files are memory-mapped."""
    if folder.startswith("file:"):
        folder = "/" + folder[len("file:"):].lstrip("/")
    if "://" in folder:
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(use_mmap=True), folder


class _Writer:
    """Cuts a stream of ids into sequences and writes full batches of them."""

    def __init__(self, sink: pa.NativeFile, length: int, wide: bool):
        self.length, self.type = length, pa.uint32() if wide else pa.uint16()
        self.schema = pa.schema([("ids", pa.list_(self.type, length)), ("mask", pa.dictionary(pa.int8(), pa.list_(pa.uint8(), length)))])
        options = pa.ipc.IpcWriteOptions(emit_dictionary_deltas=True)  # the last mask is known at the end only
        self.file, self.held, self.count = pa.ipc.new_file(sink, self.schema, options=options), [], 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.type.to_pandas_dtype()))
        self.count += len(ids)
        if self.count >= ROWS * self.length:
            rest = np.concatenate(self.held)
            whole = len(rest) // (ROWS * self.length) * ROWS * self.length
            for k in range(0, whole, ROWS * self.length):
                self._batch(rest[k:k + ROWS * self.length], ROWS * self.length)
            self.held, self.count = [rest[whole:]], len(rest) - whole

    def _batch(self, ids: np.ndarray, real: int) -> None:
        kinds, kind = [np.ones(self.length, np.uint8)], np.zeros(len(ids) // self.length, np.int8)
        if real < len(ids):
            kinds.append((np.arange(self.length) < real % self.length).astype(np.uint8))
            kind[-1] = 1
        masks = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(kinds)), self.length)
        self.file.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.DictionaryArray.from_arrays(pa.array(kind), masks)],
            schema=self.schema))

    def close(self) -> None:
        if self.count:
            rest = np.concatenate(self.held)
            self._batch(np.append(rest, np.zeros(-len(rest) % self.length, rest.dtype)), len(rest))
        self.file.close()


def write(docs: DataFrame, folder: str, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Encode all documents into ``folder``, which every executor must reach; returns ``shard, n_docs, n_tokens`` per shard.

    NULL text is empty; documents with equal ids stand in the order of their texts; a NULL id comes first. Ranges
    may also be cut inside an id that many rows share, by the beginning of the text; the sort looks at whole texts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = Encoder.of(tokenizer), TaskContext.get().partitionId()
        wide = encoder.tokenizer.get_vocab_size() > 1 << 16
        target, root = filesystem(folder)
        name, own = f"{root}/part-{shard:05d}", f".{uuid.uuid4().hex}"
        writer, index, total = None, [], 0
        for batch in batches:
            for first, last, ids, counts in encoder.encode(batch.column("text")):
                if writer is None:
                    target.create_dir(root, recursive=True)
                    sink = target.open_output_stream(f"{name}.tokens.arrow{own}")
                    writer = _Writer(sink, length, wide)
                writer.add(ids)
                starts = total + np.cumsum(counts) - counts
                index.append(pa.RecordBatch.from_arrays([batch.column("doc_id")[first:last], pa.array(starts), pa.array(counts)],
                                                        ["doc_id", "first", "n_tokens"]))
                total += int(counts.sum())
        if writer is None:
            return
        writer.close()
        sink.close()
        with target.open_output_stream(f"{name}.docs.arrow{own}") as out, pa.ipc.new_file(out, index[0].schema) as file:
            for part in index:
                file.write_batch(part)
        for kind in ("tokens", "docs"):
            target.move(f"{name}.{kind}.arrow{own}", f"{name}.{kind}.arrow")
        give_back()
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "n_docs": [sum(len(x) for x in index)], "n_tokens": [total]})
    rows = texts(docs).repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    return stored(rows.mapInArrow(run, "shard int, n_docs long, n_tokens long"), "token-shards")


class Shard:
    """Random access to one shard; local files are mapped, not read."""

    def __init__(self, folder: str, shard: int):
        files, root = filesystem(folder)
        self.tokens = pa.ipc.open_file(files.open_input_file(f"{root}/part-{shard:05d}.tokens.arrow"))
        self.docs = pa.ipc.open_file(files.open_input_file(f"{root}/part-{shard:05d}.docs.arrow"))
        self.length = self.tokens.schema.field("ids").type.list_size

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of sequence i, a view of the file, and its mask, a view of the masks that all sequences share."""
        batch, row = self.tokens.get_batch(i // ROWS), i % ROWS
        ids, masks, kind = batch.column(0).flatten().to_numpy(), batch.column(1), batch.column(1).indices[row].as_py()
        mask = masks.dictionary.flatten().to_numpy()[kind * self.length:(kind + 1) * self.length].view(bool)
        return ids[row * self.length:(row + 1) * self.length], mask

    def ids(self, first: int, count: int) -> Iterator[np.ndarray]:
        """The ids from ``first`` on, in views of one batch each."""
        size = ROWS * self.length
        while count > 0:
            flat = self.tokens.get_batch(first // size).column(0).flatten().to_numpy()
            part = flat[first % size:first % size + count]
            yield part
            first, count = first + len(part), count - len(part)


def read(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the files. ``start`` counts the ids of all documents before it."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    placed = shards.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist()):
                file = Shard(folder, shard)
                for k in range(file.docs.num_record_batches):
                    docs = file.docs.get_batch(k)
                    firsts, counts = docs.column("first").to_numpy(), docs.column("n_tokens").to_numpy()
                    sums = np.zeros(len(counts), np.int64)
                    for i, (first, count) in enumerate(zip(firsts.tolist(), counts.tolist())):
                        crc = 0
                        for part in file.ids(first, count):
                            crc = zlib.crc32(part.astype("<u4"), crc)
                        sums[i] = crc
                    yield pa.RecordBatch.from_arrays([docs.column("doc_id"), pa.array(firsts + base), docs.column("n_tokens"), pa.array(sums)],
                                                     ["doc_id", "start", "n_tokens", "ids_crc32"])
    spread = placed.repartition(max(1, shards.count()), "shard")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
