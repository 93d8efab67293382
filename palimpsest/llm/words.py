"""Words of whole texts and their fingerprints, vectorised over the bytes of an Arrow column.

A word is a run of bytes of a given class. All separators used here are ASCII, so cutting UTF-8
bytes gives the same words as cutting characters. Lower-casing changes A-Z only.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes handled at once; a longer text is handled alone, whole.
SLICE_BYTES = 2 << 20
BLOCK = 1 << 18

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~_SPACES
# 0-9, a-z and every byte beyond ASCII; capitals only as they stand before lower-casing.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_MUL_A, _MUL_B, _MUL_C = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))
_BASE = 0x5851F42D4C957F2D


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MUL_C
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Fingerprint of two sequences, one after the other."""
    x = left * _MUL_A + (right ^ (right >> np.uint64(32))) * _MUL_B
    x = (x ^ (x >> np.uint64(29))) * _MUL_C
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _MUL_A)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers, step = np.ones(1, np.uint64), base
        while len(powers) < size:
            powers = np.concatenate([powers, powers * np.uint64(step)])
            step = step * step % (1 << 64)
        out.append(powers)
    return out[0], out[1]


@dataclass
class Words:
    """Words of some texts: byte ranges, 64-bit fingerprints, and where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """For each word, the text it stands in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def text(self, at: int) -> bytes:
        return self.data[self.starts[at]:self.ends[at]].tobytes()

    def joined_text(self, low: int, high: int) -> bytes:
        """Words low to high - 1, joined by one space."""
        return b" ".join(self.text(at) for at in range(low, high))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins; a null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    begin = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[begin[0]:begin[-1]], begin - begin[0]


@lru_cache(maxsize=1)
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it


def release_memory() -> None:
    """Give back what earlier batches used: workers that wait share the executor's memory."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about so many text bytes."""
    release_memory()
    _, begin = bytes_of(batch.column(column))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(begin, begin[low] + size, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def cut(texts: pa.Array, inside: np.ndarray, lower: bool) -> Words:
    data, begin = bytes_of(texts)
    if lower:
        data = _LOWER[data]
    word = inside[data]
    before, after = np.zeros(len(word), bool), np.zeros(len(word), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    edges = begin[(begin > 0) & (begin < len(word))]
    before[edges], after[edges - 1] = False, False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, begin), _hashes(data, starts, ends))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial of each word's bytes, by differences of running sums, block by block."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    values = _byte_values()
    block = starts // BLOCK
    bounds = [*np.flatnonzero(np.r_[True, block[1:] != block[:-1]]), len(starts)]
    for low, high in zip(bounds[:-1], bounds[1:]):
        begin, end = starts[low], ends[high - 1]
        size = int(end - begin)
        up, down = _powers(1 << max(size, 2 * BLOCK).bit_length())
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values[data[begin:end]] * up[:size], out=sums[1:])
        at = starts[low:high] - begin
        out[low:high] = (sums[ends[low:high] - begin] - sums[at]) * down[at]
    return mix(out + (ends - starts).astype(np.uint64) * _MUL_B)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of ``size`` consecutive words, one for each position that has so many after it."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    out, length, level, step = None, 0, hashes, 1
    rest = size
    while True:
        if rest & 1:
            out = level if out is None else joined(level[:len(hashes) - length - step + 1], out[step:])
            length += step
        rest >>= 1
        if not rest:
            return mix(out[:len(hashes) - size + 1] + np.uint64(size * int(_MUL_A) % (1 << 64)))
        level, step = joined(level[:-step], level[step:]), 2 * step


def gram_starts(words: Words, size: int) -> np.ndarray:
    """Positions at which ``size`` words of the same text begin."""
    total = int(words.first[-1])
    end = np.repeat(words.first[1:], words.counts)
    at = np.arange(total)
    return at[at + size <= end]


def runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
