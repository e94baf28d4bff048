"""Word tables of Arrow text batches, hashed with NumPy.

A batch is worked through in slices of rows of about a megabyte, so memory does
not depend on the batch size; only a single longer text makes a larger slice.
Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_HASHED_AT_ONCE = 1 << 14
_random = np.random.default_rng(20240607)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_GRAM = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Everything but space, tab, line feed, vertical tab, form feed, return.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False
#: Digits, letters, and every byte of a non-ASCII character.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def plain(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array without nulls."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts, "") if texts.null_count else texts


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and each text's offset in them."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Runs of rows that hold at most `limit` bytes, or one longer row."""
    _, offsets = flat(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield texts.slice(first, last - first)
        first = last


@dataclass
class Words:
    """Words of a slice; those of row i are rows[i]:rows[i + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def words(texts: pa.Array, kind: np.ndarray) -> Words:
    """Maximal runs of bytes of `kind`, after lower-casing A-Z, with 64-bit hashes."""
    data, offsets = flat(texts)
    data = LOWER[data]
    inside = kind[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    finish[:-1] &= ~inside[1:]
    begin[edges] = inside[edges]
    finish[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return Words(data, starts, ends, _hashes(data, starts, ends), np.searchsorted(starts, offsets))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    powers = np.cumprod(np.full(int((ends - starts).max()), _BASE, np.uint64))
    for a in range(0, len(starts), _HASHED_AT_ONCE):
        s, e = starts[a : a + _HASHED_AT_ONCE], ends[a : a + _HASHED_AT_ONCE]
        size = e - s
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        values = _BYTE[data[np.repeat(s, size) + place]] * powers[place]
        out[a : a + len(s)] = mix(np.add.reduceat(values, first) ^ size.astype(np.uint64))
    return out


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive words; row edges are the caller's."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for j in range(n):
        total += hashes[j : j + count] * _GRAM[j]
    return mix(total + np.uint64(n))
