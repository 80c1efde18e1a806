"""Vectorised text kernels for Arrow string columns (numpy, no Python loop per word).

A batch of texts is one byte buffer plus document offsets. ``words`` finds
word boundaries, ``word_hashes`` gives a 64-bit hash per word and
``shingle_hashes`` a 64-bit hash per run of ``k`` words, each in a handful of
numpy passes over the buffer. Nulls are texts without words.

Hashes are sums ``T[b_0]*B^0 + T[b_1]*B^1 + ...`` modulo 2^64 over a fixed
random table ``T``, finished by a bijective mixer, so they are the same in every
process.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SEED = 20_240_229

ASCII_SPACE = bytes([0x20, *range(0x09, 0x0E)])
"""The six separators of white-space words: space and 0x09-0x0D."""


def _tables() -> tuple[np.ndarray, int, int]:
    rng = np.random.default_rng(_SEED)
    table = rng.integers(0, 2**64, 256, dtype=U64)
    base = int(rng.integers(0, 2**63)) * 2 + 1
    return table, base, pow(base, -1, 2**64)


_TABLE, _BASE, _INVERSE = _tables()


HASHED = 1 << 18
"""Bytes whose words are hashed at a time."""


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to 0..n-1 modulo 2^64; tables of up to ``HASHED`` are kept, longer ones are made for the call."""
    return (_powers(base, HASHED) if n <= HASHED else _powers.__wrapped__(base, n))[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift, multiply)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(30))
        x = x * U64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> U64(27))
        x = x * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def lower_table() -> np.ndarray:
    """Byte map that lower-cases A-Z and nothing else."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


_LOWER = lower_table()


def space_mask() -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(ASCII_SPACE)] = True
    return mask


def alnum_break_mask() -> np.ndarray:
    """Separators of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` over lower-cased text."""
    mask = np.ones(256, bool)
    mask[0x30:0x3A] = False
    mask[0x61:0x7B] = False
    mask[0x80:] = False
    return mask


SPACE = space_mask()
ALNUM_BREAK = alnum_break_mask()


def buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte span of each word; document d has words first[d]..first[d+1]-1."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~breaks[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True  # a word never crosses documents
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | cut[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | cut[1:n]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes; spans ascend and do not overlap.

    Words are hashed in runs of about ``HASHED`` bytes, so the memory taken is
    that of one run (or of the longest word), however long the buffer is.
    """
    value = np.empty(len(start), U64)
    a = 0
    while a < len(start):
        low = int(start[a])
        b = max(a + 1, int(np.searchsorted(end, low + HASHED, "right")))
        n = int(end[b - 1]) - low
        with np.errstate(over="ignore"):
            total = np.empty(n + 1, U64)
            total[0] = 0
            np.cumsum(_TABLE[data[low : low + n]] * powers(_BASE, n), out=total[1:])
            begin = start[a:b] - low
            value[a:b] = (total[end[a:b] - low] - total[begin]) * powers(_INVERSE, n + 1)[begin]
        a = b
    return mix(value)


def run_hashes(data: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the runs of ``size`` bytes at ``begin``; equal to ``word_hashes`` of them."""
    value = np.zeros(len(begin), U64)
    with np.errstate(over="ignore"):
        for k in range(size):
            value += _TABLE[data[begin + k]] * U64(pow(_BASE, k, 2**64))
    return mix(value)


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, first): hash of every run of ``k`` words inside a document.

    A document of fewer than ``k`` words, but not none, has one shingle: its
    whole word sequence.
    """
    n = len(hashes)
    counts = np.diff(first)
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_first = np.concatenate([[0], np.cumsum(sizes)])
    total = int(out_first[-1])
    if total == 0:
        return np.zeros(0, U64), out_first
    with np.errstate(over="ignore"):
        rolled = np.zeros(n, U64)
        for j in range(min(k, n)):
            rolled[: n - j] += hashes[j:] * U64(pow(_BASE, j + 1, 2**64))
        doc = np.repeat(np.arange(len(counts)), sizes)
        at = first[:-1][doc] + (np.arange(total) - out_first[:-1][doc])
        values = rolled[at]
        for d in np.flatnonzero((counts > 0) & (counts < k)):
            short = hashes[first[d] : first[d + 1]]
            weights = np.array([pow(_BASE, j + 1, 2**64) for j in range(len(short))], U64)
            values[out_first[d]] = (short * weights).sum() + U64(len(short))
    return mix(values), out_first


def distinct_per_row(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row; returns (values, first)."""
    parts = [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    sizes = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    merged = np.concatenate(parts) if parts else np.zeros(0, values.dtype)
    return merged, np.concatenate([[0], np.cumsum(sizes)])


def slices(offsets: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer text stands alone), covering all rows."""
    out, begin = [], 0
    rows = len(offsets) - 1
    while begin < rows:
        stop = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        stop = min(rows, max(begin + 1, stop))
        out.append((begin, stop))
        begin = stop
    return out
