"""Hashed word n-grams of whole texts, as flat index arrays.

Tokens are runs of letters and digits (any non-ASCII byte counts as a letter)
and runs of other signs, of the text with A-Z lower-cased. Features: each token,
each pair of neighbours, and one feature for a token that repeats its
predecessor. A feature's value is its count over the root of the text's number
of features, so long texts weigh no more than short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from cohortcraft.llm import kernels as K

SLICE = 2 << 20
_REPEAT = K.U64(0x5EED)


def _classes() -> np.ndarray:
    kind = np.full(256, 2, np.uint8)
    kind[~K.ALNUM_BREAK] = 1
    kind[K.SPACE] = 0
    return kind


_KIND = _classes()


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the tokens of lower-cased bytes."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    change = np.ones(n + 1, bool)
    change[1:n] = kind[1:] != kind[:-1]
    change[offsets] = True
    edges = np.flatnonzero(change)
    start, end = edges[:-1], edges[1:]
    keep = kind[start] > 0
    start, end = start[keep], end[keep]
    return start, end, np.searchsorted(start, offsets)


def features(column: pa.Array, bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row from, row to, feature indices, first) slice by slice over a text column."""
    data, offsets = K.buffer(column)
    mask = K.U64((1 << bits) - 1)
    for i, j in K.slices(offsets, SLICE):
        chunk = K.lower(data[offsets[i] : offsets[j]])
        start, end, first = tokens(chunk, offsets[i : j + 1] - offsets[i])
        h = K.word_hashes(chunk, start, end)
        n = len(h)
        # three columns per token: itself, with its successor, repeat mark; -1 where there is none
        table = np.full((n, 3), -1, np.int64)
        if n:
            table[:, 0] = (h & mask).astype(np.int64)
            last = np.zeros(n, bool)
            last[first[1:][first[1:] > 0] - 1] = True
            pair = np.flatnonzero(~last)
            with np.errstate(over="ignore"):
                table[pair, 1] = (K.mix(h[pair] * K.U64(3) + h[pair + 1] * K.U64(5)) & mask).astype(np.int64)
            same = pair[h[pair] == h[pair + 1]]
            table[same, 2] = int(K.mix(np.array([_REPEAT]))[0] & mask)
        flat = table.reshape(-1)
        keep = flat >= 0
        total = np.concatenate([[0], np.cumsum(keep)])
        yield i, j, flat[keep].astype(np.int32), total[3 * first]


def linear(indices: np.ndarray, first: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(texts, classes): sparse dot products of every text with ``weights`` (features, classes)."""
    sizes = np.diff(first)
    out = np.zeros((len(sizes), weights.shape[1]))
    full = np.flatnonzero(sizes)
    for c in range(weights.shape[1]):
        if len(full):
            out[full, c] = np.add.reduceat(weights[:, c][indices], first[full], dtype=np.float64) / np.sqrt(sizes[full])
    return out


def counted(indices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct indices, values) of one text."""
    own, counts = np.unique(indices, return_counts=True)
    return own, counts / np.sqrt(max(1, len(indices)))
