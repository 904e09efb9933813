"""Word and byte hashes of whole Arrow batches in numpy.

A batch of texts is one byte buffer with offsets; it is worked through in slices, cut at word ends, so that
temporary arrays stay small however long a text is. Hashes are polynomials modulo 2**64 over random byte values,
mixed afterwards. Two texts that differ have the same 64-bit hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

#: Word separators: space and the bytes 9 to 13. Nothing else ends a word.
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _parts(seed: int) -> tuple[np.ndarray, np.uint64, np.uint64]:
    """Values of the bytes, the base (odd) and its inverse modulo 2**64."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = int(rng.integers(2**61, 2**62)) * 2 + 1
    return values, np.uint64(base), np.uint64(pow(base, -1, 2**64))


@lru_cache(maxsize=8)
def _powers(seed: int, length: int, inverse: bool) -> np.ndarray:
    _, base, inv = _parts(seed)
    steps = np.full(length, inv if inverse else base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def powers(seed: int, length: int, inverse: bool = False) -> np.ndarray:
    """The first ``length`` powers; kept for lengths rounded up to a power of two."""
    return _powers(seed, 1 << max(10, (length - 1).bit_length()), inverse)[:length]


def prefix_sums(buf: np.ndarray, seed: int) -> np.ndarray:
    """``c`` with ``(c[e] - c[s]) * powers(-s)`` as the hash of ``buf[s:e]``."""
    values, _, _ = _parts(seed)
    sums = np.empty(len(buf) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values[buf] * powers(seed, len(buf)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Mixed hashes of the spans of the buffer that ``sums`` came from; equal bytes give equal hashes."""
    inv = powers(seed, len(sums), inverse=True)
    return mix((sums[ends] - sums[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without a copy; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offs, data = column.buffers()
    kind = np.int64 if wide else np.int32
    n = len(column)
    if n == 0 or offs is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    offsets = np.frombuffer(offs, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(buf: np.ndarray, offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Cuts of the buffer, each at a text's end or after a separator, about ``size`` bytes apart."""
    at, total = 0, len(buf)
    while at < total:
        end = min(total, at + size)
        if end < total:
            edge = offsets[np.searchsorted(offsets, end, side="right") - 1]
            if edge > at:
                end = int(edge)
            else:
                found = np.flatnonzero(SPACES[buf[at:end]])
                while not len(found) and end < total:  # one very long word
                    far = min(total, end + size)
                    text_end = int(offsets[np.searchsorted(offsets, end, side="left")])
                    found = np.flatnonzero(SPACES[buf[end : min(far, text_end)]])
                    if len(found):
                        found = found[:1] + (end - at)
                    elif text_end <= far:
                        found = np.array([text_end - at - 1])
                    else:
                        end = far
                end = at + int(found[-1]) + 1 if len(found) else total
        yield at, end
        at = end


def words(buf: np.ndarray, offsets: np.ndarray, seed: int = 1, size: int = SLICE_BYTES, between: np.ndarray = SPACES) -> Iterator[tuple]:
    """For each slice (its lowered bytes, word starts, word ends, hashes, row of each word); starts count from the slice.

    ``between`` marks the bytes that end a word; it must hold all separators.
    """
    for a, b in slices(buf, offsets, size):
        low = LOWER[buf[a:b]]
        inside = ~between[low]
        edges = offsets[np.searchsorted(offsets, a, side="left") : np.searchsorted(offsets, b, side="right")] - a
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        heads = edges[edges < b - a]
        first[heads] = inside[heads]
        starts = np.flatnonzero(first)
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        tails = edges[edges > 0] - 1
        last[tails] = inside[tails]
        ends = np.flatnonzero(last) + 1
        if len(starts):
            sums = prefix_sums(low, seed)
            hashes = span_hashes(sums, starts, ends, seed)
        else:
            hashes = np.zeros(0, dtype=np.uint64)
        row = int(np.searchsorted(offsets, a, side="right")) - 1
        inner = edges[(edges > 0) & (edges < b - a)]
        counts = np.diff(np.searchsorted(starts, np.concatenate(([0], inner, [b - a]))))
        rows = np.repeat(np.arange(row, row + len(counts)), counts)
        yield low, starts, ends, hashes, rows
