"""Words, lines and 64-bit fingerprints of whole texts, over the bytes of Arrow batches.

A word is a longest run of characters other than blank, tab, line feed, vertical
tab, form feed and carriage return. None of these bytes occurs inside a longer
UTF-8 character, so all work is on bytes. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 2 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_STEP, _A, _B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class Texts:
    """The texts of some rows as one run of bytes; ``starts`` has a text more than there are."""

    def __init__(self, column: pa.Array, lower: bool = False):
        column = column.cast(pa.large_string()).fill_null("")
        n, data = len(column), column.buffers()[2]
        ends = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
        size = int(ends[-1] - ends[0])
        self.padded = np.zeros(size + 8, np.uint8)
        if size:
            self.padded[:size] = np.frombuffer(data, np.uint8, size, int(ends[0]))
        if lower:
            self.padded = LOWER[self.padded]
        self.bytes = self.padded[:size]
        self.starts = ends - ends[0]
        self.n = n

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest runs of marked bytes within one text: start, end and row of each."""
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = np.flatnonzero(np.diff(self.starts))
        heads, tails = self.starts[full], self.starts[full + 1] - 1
        first[heads], last[tails] = inside[heads], inside[tails]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return start, end, self.row_of(start)

    def row_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.spans(~BLANK[self.bytes])

    def per_row(self, row: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        found = np.bincount(row, weights, self.n)
        return found if weights is not None and weights.dtype.kind == "f" else found.astype(np.int64)

    def total(self, flags: np.ndarray) -> np.ndarray:
        """How many marked bytes each text has."""
        upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return upto[self.starts[1:]] - upto[self.starts[:-1]]

    def fingerprints(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit fingerprint of each span's bytes, eight bytes at a time."""
        lanes = np.ndarray(len(self.padded) - 7, "<u8", self.padded, strides=(1,))
        left = end - start
        out = mixed(left.astype(np.uint64) * _STEP)
        todo, at = np.arange(len(start)), start
        while len(todo):
            out[todo] = mixed((out[todo] + _STEP) ^ (lanes[at] & _MASKS[np.minimum(left[todo], 8)]))
            left[todo] -= 8
            keep = left[todo] > 0
            todo, at = todo[keep], at[keep] + 8
        return out


def chunks(batch: pa.RecordBatch, text: str, chunk_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``chunk_bytes`` of text, a row at least."""
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + chunk_bytes, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def combined(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Fingerprints of all runs of ``n`` consecutive word fingerprints."""
    size = max(0, len(words) - n + 1)
    out = np.full(size, np.uint64(seed * 2 + n), np.uint64)
    for k in range(n):
        out += words[k : k + size] * np.uint64(((k * 2 + 1) * 0xD6E8FEB86659FD93 + 2 * k) & (2**64 - 1) | 1)
    return mixed(out)
