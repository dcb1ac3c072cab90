"""Token ids of texts by a byte-level tokenizer file of the ``tokenizers`` library, inside Python workers.

Pre-tokenisation never joins a character to white space behind it, so a text may be cut before every run of white space and
the parts be encoded on their own. A worker keeps the ids of the parts it has met in sorted arrays (about 20 bytes a part), which
saves most of the work on running text; the result equals encoding the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from invoicelake.llm.common import _BYTE_CODE, _POWER, byte_rows, mixed, row_groups

END_ID = 0
MOST_PARTS = 1_500_000
GROUP_BYTES = 1 << 19  # text whose work arrays (about 60 bytes per byte) are held at a time
CALL_PARTS = 4_096  # new parts handed to the library at a time; it answers with several hundred bytes for each
LONGEST_PART = 64
_SHIFT = 7
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
# UTF-8 forms of the white space outside ASCII (fixed values); texts that have one are encoded whole
_OTHER_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_LOADED: dict[str, Encoder] = {}


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``values`` one behind the other."""
    ends = np.cumsum(lengths)
    places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)
    return values[places]


class Encoder:
    """Names of control tokens in a text are ordinary text."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.place = np.empty(0, np.int64)  # of each key: place of its first id, shifted, and how many ids (LONGEST_PART at most)
        self.pool, self.filled = np.empty(1 << 16, np.uint32), 0

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One encoder per worker and file, kept between tasks."""
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def _append(self, found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(x) for x in found], np.int64)
        total = int(lengths.sum())
        while self.filled + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.filled:self.filled + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        starts = self.filled + np.cumsum(lengths) - lengths
        self.filled += total
        return starts, lengths

    def _known(self, codes: np.ndarray, piece: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of the ids of every part in ``pool``."""
        distinct, first, back = np.unique(codes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        have = place < len(self.keys)
        have[have] = self.keys[place[have]] == distinct[have]
        new = np.flatnonzero(~have)
        at, length = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        kept = self.place[place[have]]
        at[have], length[have] = kept >> _SHIFT, kept & ((1 << _SHIFT) - 1)
        if len(new):
            for some in np.split(new, range(CALL_PARTS, len(new), CALL_PARTS)):
                begin, size = starts[first[some]].tolist(), lengths[first[some]].tolist()
                parts = [piece[a:a + b].decode() for a, b in zip(begin, size)]
                at[some], length[some] = self._append([x.ids for x in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)])
            keep = new[lengths[first[new]] <= LONGEST_PART]
            keys = np.insert(self.keys, place[keep], distinct[keep])
            self.place = np.insert(self.place, place[keep], (at[keep] << _SHIFT) + length[keep])
            self.keys = keys
        return at[back], length[back]

    def _group(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some rows, one behind the other, and how many each row has (the end id included)."""
        if len(self.keys) > MOST_PARTS or self.filled > 8 * MOST_PARTS:
            self._forget()
        rows, piece = len(offsets) - 1, data[offsets[0]:offsets[-1]]
        space, bounds = _ASCII_SPACE[piece], offsets - offsets[0]
        begins = np.zeros(len(piece), bool)
        begins[1:] = space[1:] & ~space[:-1]
        begins[bounds[:-1][bounds[:-1] < len(piece)]] = True
        starts = np.flatnonzero(begins)
        lengths = np.diff(np.append(starts, len(piece)))
        place = np.arange(len(piece)) - np.repeat(starts, lengths)
        total = np.append(np.uint64(0), np.cumsum(_BYTE_CODE[piece] * _POWER[place & 0xFFFF]))
        codes = mixed(total[starts + lengths] - total[starts] + lengths.astype(np.uint64))
        at, length = self._known(codes, piece.tobytes(), starts, lengths)
        row = np.searchsorted(bounds, starts, side="right") - 1
        # the end id of a row stands behind its last part
        order = np.argsort(np.concatenate([row, np.arange(rows)]), kind="stable")
        end, _ = self._append([[END_ID]])
        at, length = np.append(at, np.full(rows, end[0]))[order], np.append(length, np.ones(rows, np.int64))[order]
        of = np.concatenate([row, np.arange(rows)])[order]
        counts = np.bincount(of, weights=length, minlength=rows).astype(np.int64)
        return ragged(self.pool, at, length), counts

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For groups of rows of a string column: first row, last row, their ids and the number of ids of each row."""
        data, offsets = byte_rows(column)
        for first, last in row_groups(offsets, GROUP_BYTES):
            if _OTHER_SPACE.search(data[offsets[first]:offsets[last]]) is None:
                yield first, last, *self._group(data, offsets[first:last + 1])
                continue
            texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[first:last], offsets[first + 1:last + 1])]
            found = [np.array([*x.ids, END_ID], np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            yield first, last, np.concatenate(found), np.array([len(x) for x in found], np.int64)
