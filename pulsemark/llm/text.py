"""Whole texts as byte arrays: slices of Arrow batches, words, hashes and shingles.

Everything works on the UTF-8 buffer of a slice of rows, without a Python object per row or word. Null texts are empty
texts. Words never cross rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS: dict[str, np.ndarray] = {}

# white space is \x20 and \x09-\x0D; everything else belongs to a word
WORD = np.ones(256, dtype=bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False
# letters, digits and bytes of other scripts; punctuation separates
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Slice(NamedTuple):
    rows: pa.RecordBatch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than rows


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # per row the number of its first word; one more than rows

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Rows in groups of about ``limit`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        data, offsets = buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield Slice(batch.slice(at, to - at), data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
            at = to
        del batch, data
        pa.default_memory_pool().release_unused()  # workers live on after their task


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to ``n``."""
    if len(_POWERS.get("base", ())) < n + 1:
        size = 1 << max(19, int(n + 1).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, value in (("base", _BASE), ("inverse", inverse)):
            table = np.full(size, value, np.uint64)
            table[0] = 1
            _POWERS[name] = np.multiply.accumulate(table)
    return _POWERS["base"], _POWERS["inverse"]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums that give the hash of any substring; see ``substring_hashes``."""
    base, _ = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * base[:len(data)], out=sums[1:])
    return sums


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal bytes have equal hashes wherever they lie."""
    _, inverse = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD) -> Words:
    """The maximal runs of ``inside`` bytes of each row."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(offsets), np.int64))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    mask = inside[data]
    starts, ends = mask.copy(), mask.copy()
    starts[1:] &= ~mask[:-1] | edge[1:-1]
    ends[:-1] &= ~mask[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, found: Words) -> np.ndarray:
    return substring_hashes(prefix_sums(data), found.starts, found.ends)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words of each row, and per row where its shingles begin (one more than rows).

    A row of fewer words has one shingle, its whole sequence; a row without words has none.
    """
    counts = np.diff(first)
    last = np.repeat(first[1:], counts)
    at = np.arange(len(hashes))
    out = np.zeros(len(hashes), np.uint64)
    factor = np.uint64(1)
    for j in range(k):
        factor = np.uint64(int(factor) * int(_BASE) % (1 << 64))
        there = hashes[np.minimum(at + j, max(len(hashes) - 1, 0))] if len(hashes) else hashes
        out += np.where(at + j < last, there, np.uint64(0)) * factor
    short = (counts < k) & (counts > 0)
    keep = at + k <= last
    keep[first[:-1][short]] = True
    made = np.where(counts >= k, counts - k + 1, np.where(counts > 0, 1, 0))
    return mix(out[keep]), np.concatenate([[0], np.cumsum(made)]).astype(np.int64)


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the int64 of the same bits, as Spark has no unsigned long."""
    return x.view(np.int64)


def fixed_binary(rows: np.ndarray) -> pa.Array:
    """A binary column out of a two-dimensional array, one value per row."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)]).cast(pa.binary())


def binaries(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A binary column of the runs values[first[i]:first[i + 1]]."""
    values = np.ascontiguousarray(values)
    offsets = (first * values.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary())
