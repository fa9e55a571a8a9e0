"""Elias-Fano sequences and a two-level n-gram trie over them, in one memory-mapped file."""

from __future__ import annotations

import tempfile

import numpy as np

_ONE = np.uint64(1)


class EliasFano:
    """A non-decreasing sequence of n values below ``universe``: low bits packed, high bits in unary.

    ``arrays`` are what has to be stored: low bits, high bits, and the number of ones before each 64-bit word.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @staticmethod
    def arrays(values: np.ndarray, universe: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        n = len(values)
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        bits = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & _ONE).astype(np.uint8)
        low = np.concatenate((np.packbits(bits.ravel(), bitorder="little"), np.zeros(16, dtype=np.uint8)))
        tops = (values >> np.uint64(low_bits)).astype(np.int64)
        size = n + (universe >> low_bits) + 2
        flags = np.zeros((size + 63) // 64 * 64, dtype=np.uint8)
        flags[tops + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high).astype(np.int64))))[:-1]
        return low_bits, low, high, ones

    @staticmethod
    def _nth(words: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Position of the k-th set bit, from 0, in each word."""
        at = np.zeros(len(words), dtype=np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            below = np.bitwise_count(words & np.uint64((1 << width) - 1)).astype(np.int64)
            up = k >= below
            k = np.where(up, k - below, k)
            words = np.where(up, words >> np.uint64(width), words)
            at += np.where(up, width, 0)
        return at

    def _select(self, k: np.ndarray, counts: np.ndarray, ones: bool) -> np.ndarray:
        word = np.searchsorted(counts, k, "right") - 1
        held = np.asarray(self.high[word])
        return word * 64 + self._nth(held if ones else ~held, k - counts[word])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.uint64)
        at = i * self.low_bits
        words = np.ndarray(shape=(len(self.low) - 8,), dtype="<u8", buffer=self.low, strides=(1,))
        return (words[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at positions i."""
        top = self._select(i, self.ones, True) - i
        return (top.astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The first position whose value is at least each of ``values``, which are below the universe (successor search)."""
        values = values.astype(np.uint64)
        top = (values >> np.uint64(self.low_bits)).astype(np.int64)
        end = self._select(top, self.zeros, False) - top
        before = self._select(np.maximum(top - 1, 0), self.zeros, False) - top + 1
        lo = np.where(top > 0, before, 0)
        want = values & np.uint64((1 << self.low_bits) - 1)
        while True:
            open_ = np.flatnonzero(lo < end)
            if not len(open_):
                return lo
            mid = (lo[open_] + end[open_]) // 2
            less = self._low(mid) < want[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            end[open_] = np.where(less, end[open_], mid)


class Trie:
    """Bigrams under their contexts, in Elias-Fano levels of one memory-mapped temporary file.

    A context's successors are sorted ids; to make the whole level non-decreasing, each range is shifted by its context's
    rank times the size of the id space, so a search within a context is a search for one shifted value. Pointers to
    ranges are a level of their own, and each successor has a one-byte code.
    """

    def __init__(self, contexts: np.ndarray, pointers: np.ndarray, successors: np.ndarray, codes: np.ndarray, n_ids: int) -> None:
        """``contexts``: distinct sorted numbers; range i of the successors is from ``pointers[i]`` to ``pointers[i + 1]``."""
        self.n_ids, self.n_contexts = n_ids, len(contexts)
        self.n_numbers = int(contexts[-1]) + 1 if len(contexts) else 1
        ranks = np.repeat(np.arange(len(contexts), dtype=np.uint64), np.diff(pointers))
        levels = [(contexts, self.n_numbers), (pointers, int(pointers[-1]) + 1), (successors.astype(np.uint64) + ranks * np.uint64(n_ids), max(1, len(contexts)) * n_ids)]
        self.file = tempfile.TemporaryFile(prefix="trie-")
        self.levels = []
        for values, universe in levels:
            low_bits, *arrays = EliasFano.arrays(values, universe)
            self.levels.append(EliasFano(len(values), low_bits, *map(self._mapped, arrays)))
        self.codes = self._mapped(codes)

    def _mapped(self, values: np.ndarray) -> np.ndarray:
        if not len(values):
            return values
        self.file.seek(0, 2)
        at = -(-self.file.tell() // 64) * 64
        self.file.truncate(at)
        self.file.seek(at)
        self.file.write(values.tobytes())
        self.file.flush()
        return np.memmap(self.file, dtype=values.dtype, mode="r", offset=at, shape=values.shape)

    def close(self) -> None:
        self.levels, self.codes = [], None
        self.file.close()

    def rank(self, contexts: np.ndarray) -> np.ndarray:
        """The rank of each context, -1 for one that the trie does not have."""
        level = self.levels[0]
        out = np.full(len(contexts), -1, dtype=np.int64)
        inside = np.flatnonzero(contexts < self.n_numbers)
        if self.n_contexts and len(inside):
            at = level.find(contexts[inside])
            have = at < self.n_contexts
            have[have] = level.get(at[have]) == contexts[inside][have]
            out[inside[have]] = at[have]
        return out

    def lookup(self, ranks: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """The code of each successor in the range of the context with each rank; 0 where there is none."""
        out = np.zeros(len(ranks), dtype=np.uint8)
        known = np.flatnonzero((ranks >= 0) & (successors < self.n_ids))
        if not len(known):
            return out
        _, pointers, level = self.levels
        wanted = successors[known].astype(np.uint64) + ranks[known].astype(np.uint64) * np.uint64(self.n_ids)
        at = level.find(wanted)
        have = at < pointers.get(ranks[known] + 1).astype(np.int64)
        have[have] = level.get(at[have]) == wanted[have]
        out[known[have]] = self.codes[at[have]]
        return out
