"""Helpers inside tasks: Arrow batches in bounded slabs, and words of many texts at once as NumPy arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLAB_BYTES = 2 << 20  # text handled at once; temporary arrays are some tens of times as large
WORD_SLAB_BYTES = 512 << 10  # the same where ``Words`` are made, with several 8-byte numbers for each byte

SPACE_BYTES = (0x20, *range(0x09, 0x0E))


def slabs(batches: Iterable[pa.RecordBatch], column: str, size: int = SLAB_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds at most ``size`` bytes, or a single row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the n + 1 offsets of the texts. Null is the empty text."""
    column = pc.fill_null(column.cast(pa.string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table[data]


def space_words() -> np.ndarray:
    """Byte table of the words between ASCII white space."""
    table = np.ones(256, bool)
    table[list(SPACE_BYTES)] = False
    return table


def letter_digit_words() -> np.ndarray:
    """Byte table of words of digits, a-z and all characters beyond ASCII."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x61:0x7B] = table[0x80:] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def odd_constants(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class Words:
    """Words of a slab of texts: byte ``start`` and ``end`` in ``data``, number of the text in ``doc``, 64-bit ``hash``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.data, self.offsets, self.docs = data, offsets, len(offsets) - 1
        flag = table[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = flag[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = flag[1:]
        self.start = np.flatnonzero(flag & (~before | edge[:-1]))
        self.end = np.flatnonzero(flag & (~after | edge[1:])) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=self.docs).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])  # of each text, in the list of words
        self.hash = self._hashes(table)

    def _hashes(self, table: np.ndarray) -> np.ndarray:
        if len(self.start) == 0:
            return np.zeros(0, np.uint64)
        values = np.where(table, odd_constants(256, 7), np.uint64(0))
        lengths = np.diff(np.append(self.start, len(self.data)))
        place = np.arange(self.start[0], len(self.data)) - np.repeat(self.start, lengths)
        longest = int((self.end - self.start).max())
        powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(longest, 0x9E3779B97F4A7C15, np.uint64))])
        terms = values[self.data[self.start[0] :]] * powers[np.minimum(place, longest)]
        sums = np.add.reduceat(terms, self.start - self.start[0])
        return mix(sums + (self.end - self.start).astype(np.uint64))

    def position(self) -> np.ndarray:
        """Number of each word in its text, from 0."""
        return np.arange(len(self.start)) - self.first[self.doc]

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of the first word, hash) of all runs of ``k`` words inside one text."""
        if len(self.hash) < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        n = len(self.hash) - k + 1
        total = np.zeros(n, np.uint64)
        for j, factor in enumerate(odd_constants(k, 11)):
            total += mix(self.hash[j : j + n] * factor + np.uint64(j))
        whole = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return whole, mix(total[whole])

    def texts(self, first: np.ndarray, k: int) -> list[str]:
        """The ``k`` words from each given one on, joined by one space."""
        raw = self.data.tobytes()
        return [b" ".join(raw[self.start[i + j] : self.end[i + j]] for j in range(k)).decode("utf-8", "replace") for i in first.tolist()]


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
