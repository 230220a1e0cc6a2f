"""Helpers on columns of text inside Arrow batches.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D``; in UTF-8 no
byte of a longer character lies among them, so bytes and characters agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
_WORD = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    x = x ^ (x >> _WORD(30))
    x = x * _WORD(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _WORD(27))
    x = x * _WORD(0x94D049BB133111EB)
    return x ^ (x >> _WORD(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64))
_STEP = 4096
_POWERS = np.cumprod(np.r_[_WORD(1), np.full(_STEP - 1, 0x9E3779B97F4A7C15, np.uint64)])
_STRIDE = _POWERS[-1:] * _WORD(0x9E3779B97F4A7C15)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator:
    """Parts of a batch with about ``limit`` bytes of text, one row at least."""
    _, offsets = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column, and where each row's begin and the last ends.

    A null is an empty text.
    """
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end. No word spans two rows."""
    space = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    if len(data):
        before[0], before[1:] = True, space[:-1]
        after[-1], after[:-1] = True, space[1:]
    return (
        np.flatnonzero(~space & (before | edge[:-1])),
        np.flatnonzero(~space & (after | edge[1:])) + 1,
    )


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(lengths.sum()) - np.repeat(first, lengths)
    letters = LOWER[data[within + np.repeat(starts, lengths)]]
    terms = _BYTES[letters] * _POWERS[within & (_STEP - 1)]
    if len(lengths) and lengths.max() > _STEP:
        strides = np.cumprod(np.r_[_WORD(1), np.repeat(_STRIDE, lengths.max() // _STEP)])
        terms *= strides[within >> 12]
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64)) if len(first) else terms


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, A-Z as a-z, and where each row's words begin.

    Words are hashed a few megabytes at a time, so a very long row needs
    little more memory than its bytes.
    """
    starts, ends = word_bounds(data, offsets)
    cuts = np.searchsorted(starts, np.arange(0, len(data), SLICE_BYTES))
    cuts = np.unique(np.r_[cuts, len(starts)])
    parts = [
        _hash_spans(data, starts[a:b], ends[a:b]) for a, b in zip(cuts[:-1], cuts[1:])
    ]
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return hashes, np.searchsorted(starts, offsets)
