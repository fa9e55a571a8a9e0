"""Array-at-a-time word splitting and hashing over Arrow string columns.

Texts are handled as one byte buffer per slice of rows. A word is a maximal run of bytes that a separator table does not
mark, so no Python object is made per word. Hashes are polynomials modulo 2**64 over random byte values, finished by a
bijective mixer; a window's hash comes from two prefix sums.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_BASE, WORD_BASE, WORD_BASE_2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[:128] = [not chr(b).isalnum() for b in range(128)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of a slice: with the place after the last, tables of powers have 2 ** 20 entries.
SLICE_BYTES = (1 << 20) - 1

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def release() -> None:
    """Give memory that nothing holds any more back to the machine, as Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def frugal(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """``run``, releasing what it held when its task ends."""

    @wraps(run)
    def wrapper(*arguments) -> Iterator[pa.RecordBatch]:
        yield from run(*arguments)
        release()

    return wrapper


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n at least."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            table = np.full(size, b, dtype=np.uint64)
            table[0] = 1
            both.append(np.multiply.accumulate(table))
        have = _POWERS[base] = (both[0], both[1])
    return have


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    """Sums of ``values[j] * base**j`` over j < i, for i from 0 to n."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of the value ranges [start, end); equal ranges at different places have equal hashes."""
    raw = (sums[ends] - sums[starts]) * powers(base, len(sums))[1][starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of some texts: byte ranges in ``data``, and for text i the words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return range_hashes(prefix_sums(BYTE_VALUES[self.data], BYTE_BASE), self.starts, self.ends, BYTE_BASE)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def flat(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array without nulls; a null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.cast(pa.large_string()).combine_chunks()
    return texts.fill_null("") if texts.null_count else texts


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, where, held = texts.buffers()
    offsets = np.frombuffer(where, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges with at most ``limit`` bytes of text, or of one text if that is longer."""
    _, offsets = buffers(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def split(texts: pa.Array, separators: np.ndarray = SPACES, lower: bool = False) -> Words:
    """Words of each text; words never span two texts."""
    data, offsets = buffers(texts)
    if lower:
        data = LOWER[data]
    inside = ~separators[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    before[begins] = False
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def windows(first: np.ndarray, size: int) -> np.ndarray:
    """Positions at which a window of ``size`` words of one text begins."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    total = int(counts.sum())
    skip = np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts)
    return np.arange(total) + skip


def covered(positions: np.ndarray, size: int, n: int) -> np.ndarray:
    """A mask of the n words that lie in a window of ``size`` words beginning at one of ``positions``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, positions, 1)
    np.add.at(edge, positions + size, -1)
    return np.cumsum(edge[:-1]) > 0


def member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(sorted_set):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(sorted_set, values)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == values


def repeated(values: np.ndarray) -> np.ndarray:
    """The values that occur twice or more, sorted."""
    ordered = np.sort(values)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return twice[np.concatenate(([True], twice[1:] != twice[:-1]))] if len(twice) else twice
