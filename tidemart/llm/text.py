"""Words of many texts at once, as numpy arrays over the bytes of a slice of rows.

A slice holds about SLICE_BYTES of text, or one longer text, so memory follows the longest text and
not the batch. Words are runs of bytes other than white space (space and 0x09 to 0x0D).
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the splitmix64 finaliser); a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def number_hash(x: np.ndarray | int) -> np.ndarray:
    return mix((np.asarray(x).astype(np.uint64) + np.uint64(1)) * _STEP)


_BYTE = number_hash(np.arange(256))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@dataclass
class Texts:
    """Rows of a slice: their bytes behind one another, and where each starts (one more at the end)."""
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, row after the last, texts) for consecutive rows of a column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1)
        yield first, last, Texts(data[ends[first]: ends[last]], ends[first: last + 1] - ends[first])
        first = last


def release() -> None:
    """Give freed memory back to the system when a task is done, as workers stay for the stages that follow."""
    for name in _POWERS:
        _POWERS[name] = _POWERS[name][:1].copy()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def powers(n: int, base: np.uint64) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[str, np.ndarray] = {"up": powers(1, _BASE), "down": powers(1, _BASE)}


def _span_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of codes[start:end] for each span: polynomial in an odd base, from running sums."""
    n = len(codes)
    if len(_POWERS["up"]) < n:
        size = max(n, 2 * SLICE_BYTES)
        _POWERS["up"] = powers(size, _BASE)
        _POWERS["down"] = powers(size, np.uint64(pow(int(_BASE), -1, 1 << 64)))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[codes] * _POWERS["up"][:n], out=sums[1:])
    value = (sums[end] - sums[start]) * _POWERS["down"][np.minimum(start, max(n - 1, 0))]
    return mix(value ^ ((end - start).astype(np.uint64) * _STEP))


@dataclass
class Words:
    """Words of a slice in order: 64-bit hash, row, first byte, byte after the last."""
    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray


def words(texts: Texts, lower: bool = True) -> Words:
    data = _LOWER[texts.data] if lower else texts.data
    n = len(data)
    inside = ~_IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(texts.offsets, start, side="right") - 1
    return Words(_span_hashes(data, start, end), row, start, end)


def shapes(texts: Texts, w: Words) -> np.ndarray:
    """A hash of each word's shape: runs of small letters, capitals and digits count as one sign."""
    kind = texts.data.copy()
    kind[(kind >= 97) & (kind <= 122) | (kind >= 128)] = 97
    kind[(kind >= 65) & (kind <= 90)] = 65
    kind[(kind >= 48) & (kind <= 57)] = 48
    keep = np.ones(len(kind), bool)
    keep[1:] = (kind[1:] != kind[:-1]) | ~((kind[1:] == 97) | (kind[1:] == 65) | (kind[1:] == 48))
    keep[w.start] = True
    place = np.zeros(len(kind) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    return _span_hashes(kind[keep], place[w.start], place[w.end])


def same_as_before(w: Words) -> np.ndarray:
    """Whether a word repeats the one before it in its row."""
    out = np.zeros(len(w.hash), bool)
    out[1:] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    return out


def bounds(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Where each row's entries start in an array ordered by row (one more at the end)."""
    return np.searchsorted(row, np.arange(n_rows + 1))


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def find(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in sorted distinct keys, -1 if it is not there."""
    if not len(keys):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


class Members:
    """A set of 64-bit hashes, looked up by where those with the same first bits begin."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.unique(values.view(np.uint64))
        self.shift = np.uint64(64 - max(1, len(self.values).bit_length()))
        edges = np.arange(1 << int(64 - self.shift), dtype=np.uint64) << self.shift
        self.begin = np.append(np.searchsorted(self.values, edges), len(self.values)).astype(np.int32)
        self.fullest = int(np.diff(self.begin).max())

    def holds(self, x: np.ndarray) -> np.ndarray:
        """Which of some hashes are in the set."""
        x = x.view(np.uint64)
        if not len(self.values):
            return np.zeros(len(x), bool)
        first = (x >> self.shift).astype(np.int64)
        at, end = self.begin[first], self.begin[first + 1]
        out = self.values[np.minimum(at, len(self.values) - 1)] == x
        left = np.flatnonzero(~out & (at + 1 < end))
        for j in range(1, self.fullest):
            hit = self.values[at[left] + j] == x[left]
            out[left[hit]] = True
            left = left[~hit]
            left = left[at[left] + j + 1 < end[left]]
        return out


class Counter:
    """Counts of 64-bit values, merged whenever the pending ones outgrow the distinct ones."""

    def __init__(self) -> None:
        self.values, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pending: list[np.ndarray] = []
        self.size = 0

    def add(self, values: np.ndarray) -> None:
        self.pending.append(values)
        self.size += len(values)
        if self.size > max(2_000_000, len(self.values)):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if self.pending:
            new, n = np.unique(np.concatenate(self.pending), return_counts=True)
            both, where = np.unique(np.concatenate([self.values, new]), return_inverse=True)
            counts = np.zeros(len(both), np.int64)
            np.add.at(counts, where[: len(self.values)], self.counts)
            np.add.at(counts, where[len(self.values):], n)
            self.values, self.counts, self.pending, self.size = both, counts, [], 0
        return self.values, self.counts
