"""Packing documents into sequences: sum-of-squares placement, online, within each task.

A document is cut into full windows of ``capacity`` ids and a rest. A level array counts the partially filled windows by their fill.
The rest goes into the level that leaves the sum of the squared counts smallest (level 0 opens a window), ties to the fullest.
When ``MOST_OPEN`` windows are open, and at the end of a task, the emptiest windows are cut up to fill the fullest ones, so
that memory stays bounded and at most one window of a task is padded.

Documents never leave the task that reads them; nothing is shuffled. Sequence numbers carry the task in their upper bits.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from invoicelake.llm.common import give_back, texts
from invoicelake.llm.tokens import Encoder

CAPACITY = 1024
MOST_OPEN = 4096
OUT_ROWS = 4096
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
Piece = tuple[int | None, int, int, np.ndarray]  # document, ids before it, ids of the document, ids


class Packer:
    """Windows of one task. ``done`` gets a row per piece as soon as its window is closed."""

    def __init__(self, capacity: int = CAPACITY, most_open: int = MOST_OPEN):
        self.capacity, self.most_open = capacity, most_open
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: list[deque[list[Piece]]] = [deque() for _ in range(capacity + 1)]
        self.opened, self.closed = 0, 0
        self.done: list[tuple] = []

    def _close(self, window: list[Piece]) -> None:
        offset = 0
        for doc, start, total, ids in window:
            self.done.append((doc, start, len(ids), total, self.closed, offset, ids.tobytes()))
            offset += len(ids)
        self.closed += 1

    def level(self, size: int) -> int:
        """The fill level that a piece of ``size`` ids goes to."""
        n, top = self.count, self.capacity - size
        change = np.empty(top + 1, np.int64)
        change[0] = 0
        change[1:] = 1 - 2 * n[1:top + 1]  # a window leaves level h
        change[:top] += 2 * n[size:self.capacity] + 1  # and reaches level h + size; a full one counts no more
        allowed = n[:top + 1] > 0
        allowed[0] = True
        change[~allowed] = np.iinfo(np.int64).max
        return top - int(np.argmin(change[::-1]))

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            self._close([(doc, start, len(ids), ids[start:start + self.capacity])])
        size = len(ids) - whole
        if not size:
            return
        at = self.level(size)
        if at:
            window = self.open[at].popleft()
            self.count[at] -= 1
        else:
            window, self.opened = [], self.opened + 1
        window.append((doc, whole, len(ids), ids[whole:].copy()))
        if at + size == self.capacity:
            self._close(window)
            self.opened -= 1
        else:
            self.open[at + size].append(window)
            self.count[at + size] += 1
            if self.opened > self.most_open:
                self.settle()

    def settle(self) -> None:
        """Cut up the emptiest windows to fill the fullest; one partially filled window may stay open."""
        levels = [(h, w) for h in range(1, self.capacity) for w in self.open[h]]
        for h in range(self.capacity):
            self.open[h].clear()
        self.count[:] = 0
        low, high, spare = 0, len(levels) - 1, []
        while high > low or (high == low and spare):
            fill, window = levels[high]
            while fill < self.capacity and (spare or low < high):
                if not spare:
                    spare = levels[low][1][::-1]
                    low += 1
                    continue
                doc, start, total, ids = spare.pop()
                room = self.capacity - fill
                window.append((doc, start, total, ids[:room]))
                if len(ids) > room:
                    spare.append((doc, start + room, total, ids[room:]))
                fill += min(room, len(ids))
            levels[high] = (fill, window)
            if fill < self.capacity:
                break
            self._close(window)
            high -= 1
        left = [levels[k][1] for k in range(low, high + 1)] + ([spare[::-1]] if spare else [])
        self.opened = len(left)
        for window in left:
            fill = sum(len(piece[3]) for piece in window)
            self.open[fill].append(window)
            self.count[fill] += 1

    def finish(self) -> None:
        self.settle()
        for windows in self.open:
            while windows:
                self._close(windows.popleft())

    def rows(self, base: int) -> pa.RecordBatch:
        columns = list(zip(*self.done)) or [()] * 7
        self.done = []
        kinds = [pa.int64()] * 6 + [pa.binary()]
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        arrays[4] = pa.array(np.asarray(columns[4], np.int64) + base)
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` (little-endian unsigned 32-bit).

    NULL and empty texts are the end id alone. Rows that repeat a document are packed once more each. One narrow pass.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, base = Encoder.of(tokenizer), Packer(capacity), TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, last, ids, counts in encoder.encode(batch.column("text")):
                ends = np.cumsum(counts).tolist()
                for doc, start, end in zip(batch.column("doc_id")[first:last].to_pylist(), [0, *ends], ends):
                    packer.add(doc, ids[start:end])
                if len(packer.done) >= OUT_ROWS:
                    yield packer.rows(base)
            give_back()  # what a batch leaves behind would otherwise stand beside the next
        packer.finish()
        yield packer.rows(base)
        give_back()
    return texts(docs).mapInArrow(run, SCHEMA)
