"""Texts of an Arrow column as one byte array, and vectorised views of it.

Tasks walk through Arrow batches in slices of a few megabytes of text, so that the temporaries of
numpy stay small however long the documents are; a slice holds one document at least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once. Temporaries take about twenty times as much.
SLICE_BYTES = 2 << 20
#: Multiplier of the polynomial hashes; odd, so that it has an inverse modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of consecutive rows whose texts have about ``limit`` bytes together."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + column.offset + 1)[column.offset :]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the text it stands in. Words never cross texts.

    ``between`` tells of each byte value whether it separates words.
    """
    inside = ~between[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of byte * BASE^position modulo 2^64, and the inverse powers of BASE."""
    n = len(data)
    powers = np.full(n, BASE, dtype=np.uint64)
    inverse = np.full(n + 1, BASE_INVERSE, dtype=np.uint64)
    inverse[0] = 1
    with np.errstate(over="ignore"):
        if n:
            powers[0] = 1
        np.cumprod(powers, out=powers)
        np.cumprod(inverse, out=inverse)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
    return sums, inverse


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def span_hashes(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of every span; equal bytes give equal hashes wherever they stand."""
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(*prefix_hashes(data), starts, ends)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words that begin at every word, in order; the last ones run past the end."""
    out = np.zeros(len(words), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            part = np.zeros(len(words), dtype=np.uint64)
            part[: max(len(words) - k, 0)] = words[k:]
            out = mix(out * np.uint64(3) + part)
    return out
