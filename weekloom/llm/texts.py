"""Whole texts as bytes in numpy arrays, inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text makes a block of its own.
BLOCK_BYTES = 1 << 21

#: True for the six ASCII white-space bytes.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Odd multiplier of the rolling word hash.
RADIX = np.uint64(0x9E3779B97F4A7C15)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, one after another, and n + 1 offsets; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(
    batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES, column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows with at most ``limit`` bytes of text, or a single row."""
    for batch in batches:
        data, offsets = utf8(batch.column(column))
        start, rows = 0, batch.num_rows
        while start < rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            stop = min(rows, max(stop, start + 1))
            part = offsets[start : stop + 1]
            yield batch.slice(start, stop - start), data[part[0] : part[-1]], part - part[0]
            start = stop


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes within rows: starts, lengths, and the row of each run."""
    padded = np.zeros(len(inside) + 1, bool)
    padded[:-1] = inside
    before = np.zeros(len(inside) + 1, bool)
    before[1:] = inside
    edge = offsets[1:-1][offsets[1:-1] < len(inside)]
    cut = np.zeros(len(inside) + 1, bool)
    cut[edge] = True
    starts = np.flatnonzero(padded & (~before | cut))
    ends = np.flatnonzero(before & (~padded | cut))
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends - starts, rows


@lru_cache(maxsize=4)
def _powers(n: int) -> np.ndarray:
    factors = np.full(n, RADIX, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all members of spans, and the position of each within its span."""
    first = np.cumsum(lengths) - lengths
    inner = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    return np.repeat(starts, lengths) + inner, inner


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all bits."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each (non-empty) span."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    where, inner = ragged(starts, lengths)
    table = _powers(1 << int(lengths.max()).bit_length())
    values = (data[where].astype(np.uint64) + np.uint64(1)) * table[inner]
    sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    return mix(sums + lengths.astype(np.uint64))
