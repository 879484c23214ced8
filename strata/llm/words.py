"""Words and word shingles of Arrow text columns as 64-bit hashes, in numpy.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D``; A-Z are
lower-cased first. Whole texts are read; null texts are empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21  # text handled at once; a longer document is a slice of its own

SPAN_BYTES = 1 << 18   # bytes whose spans are hashed at once; a longer span is hashed by itself

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SHINGLE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                     0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def as_binary(column: pa.Array) -> pa.Array:
    """Text as large binary without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def bounds_and_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of each text in one byte buffer, and the buffer."""
    column = as_binary(column)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bounds - bounds[0], data[bounds[0]:bounds[-1]]


def release() -> None:
    """Give memory that is free in this worker process, after earlier texts and tasks, back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries keep freed memory and can give it back
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, text: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` text bytes; what the one before left free is given back first."""
    if not batch.num_rows:
        return
    release()
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        base = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def word_spans(bounds: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in ``data``, and the words' offsets per text."""
    word = ~_SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = word
    before[bounds] = False
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = word
    after[bounds] = False
    starts = np.flatnonzero(word & ~before[:-1])
    ends = np.flatnonzero(word & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of 64-bit values, from running sums of one polynomial."""
    power, inverse = _power_tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[:len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes; spans are in order, and hashed some at a time to bound memory."""
    out, i = np.zeros(len(starts), np.uint64), 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + SPAN_BYTES, "right")))
        out[i:j] = run_hashes(data[base:ends[j - 1]].astype(np.uint64) + np.uint64(1), starts[i:j] - base, ends[i:j] - base)
        i = j
    return out


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased word, and the words' offsets per text."""
    bounds, data = bounds_and_bytes(column)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    starts, ends, offsets = word_spans(bounds, data)
    return span_hashes(_LOWER[data], starts, ends), offsets


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the five-word shingles of each text.

    A text of one to four words is one shingle; a text without words has none."""
    h, offsets = word_hashes(column)
    width = len(_SHINGLE)
    if len(h) >= width:
        n = len(h) - width + 1
        s = h[:n] * _SHINGLE[0]
        for k in range(1, width):
            s += h[k:k + n] * _SHINGLE[k]
        s = mix(s)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= width:
            own = np.sort(s[a:b - width + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            yield own[keep]
        elif b > a:
            yield mix(np.sum(h[a:b] * _SHINGLE[:b - a], keepdims=True, dtype=np.uint64)
                      + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


__all__ = ["mix", "as_binary", "bounds_and_bytes", "release", "slices", "word_spans", "run_hashes", "span_hashes", "word_hashes",
           "shingle_sets", "SLICE_BYTES"]
