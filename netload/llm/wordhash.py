"""Words of Arrow text columns as byte ranges and 64-bit hashes, by numpy alone.

Works on slices of a batch, so memory follows the slice (``SLICE_BYTES``, or one
longer text) and not the batch. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX_1, _MIX_2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _MIX_1
    x = (x ^ (x >> _U(27))) * _MIX_2
    return x ^ (x >> _U(31))


@lru_cache(maxsize=2)
def _powers(n: int, inverse: bool) -> np.ndarray:
    base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n, or its inverses."""
    room = max(SLICE_BYTES, 1 << max(n - 1, 1).bit_length())
    return _powers(room, inverse)[:n] if room == SLICE_BYTES else _powers.__wrapped__(room, inverse)[:n]


def byte_codes(data: np.ndarray) -> np.ndarray:
    """What ``range_hashes`` takes for bytes."""
    return _BYTE_CODE[data]


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hashes of the ranges ``codes[start:end]``, from prefix sums modulo 2**64."""
    n = len(codes)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * powers(n), out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * powers(n, True)[starts]) if n else np.zeros(0, np.uint64)


@dataclass
class Words:
    """Words of the texts of one slice; ``first[i]:first[i + 1]`` are those of text i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return range_hashes(byte_codes(self.data), self.starts, self.ends)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the column, and where each text starts in them (one more offset than texts)."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()[-3:]
    where = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    where = where.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[where[0] : where[-1]], where - where[0]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts fill up to ``max_bytes``; a longer text comes alone."""
    _, where = text_bytes(batch.column(column))
    row = 0
    while row < batch.num_rows:
        stop = int(np.searchsorted(where, where[row] + max_bytes, "right")) - 1
        stop = min(max(stop, row + 1), batch.num_rows)
        yield batch.slice(row, stop - row)
        row = stop


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, with A-Z in lower case if asked for."""
    data, where = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    inside = ~SPACE[data]
    edge = where[(where > 0) & (where < len(data))]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[edge] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[edge - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, where, "left"))


def gram_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and first word of every run of ``size`` words that lies within one text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return text, first[:-1][text] + within
