"""Elias-Fano sequences and the n-gram trie level built from them.

A sorted sequence of n integers below u keeps log2(u / n) low bits of each value
in a packed array and the rest as unary gaps in a bit vector: close to the least
space possible, with access and search in place.  All operations take and give
numpy arrays, and all structures read from any buffer, a memory map included.
"""

from __future__ import annotations

import numpy as np

_BIT_AT = np.full((256, 8), 8, dtype=np.int64)                # position of the r-th set bit of a byte
for _b in range(256):
    for _r, _p in enumerate([p for p in range(8) if _b >> p & 1]):
        _BIT_AT[_b, _r] = _p


_EACH, _TOP = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)      # one, and the top bit, of every byte


def _select(words: np.ndarray, before: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the set bit of each rank; ``before`` counts the set bits before every word."""
    at = np.searchsorted(before, rank, side="right") - 1
    rest, word = (rank - before[at]).astype(np.uint64), words[at]
    # set bits of each byte, then of each byte and those below it
    x = word - (word >> np.uint64(1) & np.uint64(0x5555555555555555))
    x = (x & np.uint64(0x3333333333333333)) + (x >> np.uint64(2) & np.uint64(0x3333333333333333))
    upto = (x + (x >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _EACH
    # a byte's top bit stays where no more than ``rest`` bits are set up to it: the byte sought lies past those
    shift = np.bitwise_count((rest * _EACH | _TOP) - upto & _TOP).astype(np.uint64) * np.uint64(8)
    rest -= (upto << np.uint64(8)) >> shift & np.uint64(255)
    return at * 64 + shift.astype(np.int64) + _BIT_AT[(word >> shift & np.uint64(255)).astype(np.int64), rest.astype(np.int64)]


class EliasFano:
    def __init__(self, buffer, offset: int = 0):
        """Read from ``buffer`` what to_bytes() wrote."""
        self.n, self.low_bits, n_low, n_high = np.frombuffer(buffer, np.int64, 4, offset).tolist()
        self.low = np.frombuffer(buffer, np.uint64, n_low, offset + 32)
        self.high = np.frombuffer(buffer, np.uint64, n_high, offset + 32 + 8 * n_low)
        self.size = 32 + 8 * (n_low + n_high)
        self.ones = np.r_[0, np.cumsum(np.bitwise_count(self.high), dtype=np.int64)]
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    @staticmethod
    def to_bytes(values: np.ndarray) -> bytes:
        """Encode a non-descending sequence of uint64 values."""
        v = values.astype(np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        high_part = (v >> np.uint64(bits)).astype(np.int64)
        marks = np.zeros((-(-(n + (top >> bits) + 1) // 64)) * 64, dtype=np.uint8)
        marks[high_part + np.arange(n)] = 1
        high = np.packbits(marks, bitorder="little").view(np.uint64)
        low = np.zeros(-(-n * bits // 64) + 1, dtype=np.uint64)
        if bits and n:
            part = v & np.uint64((1 << bits) - 1)
            at = np.arange(n, dtype=np.int64) * bits
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, part << shift)
            over = (at & 63) + bits > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        return np.array([n, bits, len(low), len(high)], dtype=np.int64).tobytes() + low.tobytes() + high.tobytes()

    def _lows(self, i: np.ndarray) -> np.ndarray:
        bits = self.low_bits
        if not bits:
            return np.zeros(len(i), dtype=np.uint64)
        at = i * bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        over = (at & 63) + bits > 64
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at positions."""
        high = _select(self.high, self.ones, i) - i
        return high.astype(np.uint64) << np.uint64(self.low_bits) | self._lows(i)

    def values(self) -> np.ndarray:
        """The whole sequence."""
        high = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little").view(bool))[:self.n]
        at = np.arange(self.n)
        high -= at
        return high.astype(np.uint64) << np.uint64(self.low_bits) | self._lows(at)

    def find_ascending(self, values: np.ndarray) -> np.ndarray:
        """find() for non-descending values that are many beside the sequence: one pass over both."""
        v, mine = values.astype(np.uint64), self.values()
        at = np.searchsorted(mine, v)
        at[at == self.n] = 0
        if self.n:
            at[mine[at] != v] = -1
        else:
            at -= 1
        return at

    def find(self, values: np.ndarray, first: np.ndarray | None = None, past: np.ndarray | None = None) -> np.ndarray:
        """Position of each value, or -1; searched within [first, past) where given.

        The successor search: the high part names a short stretch between two
        zeros of the bit vector, the low parts there are searched by halving.
        """
        v = values.astype(np.uint64)
        if not self.n:
            return np.full(len(v), -1, dtype=np.int64)
        high = (v >> np.uint64(self.low_bits)).astype(np.int64)
        known = high < self.zeros[-1]
        h = np.where(known, high, 0)
        inverse = ~self.high
        end = _select(inverse, self.zeros, h) - h
        lo = np.where(h > 0, _select(inverse, self.zeros, np.maximum(h - 1, 0)) + 1 - h, 0)
        hi = end
        if first is not None:
            lo, hi = np.maximum(lo, first), np.minimum(hi, past)
        want = v & np.uint64((1 << self.low_bits) - 1)
        lo, hi = lo.copy(), np.maximum(hi, lo)
        stop = hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            middle = (lo[open_] + hi[open_]) >> 1
            less = self._lows(middle) < want[open_]
            lo[open_[less]] = middle[less] + 1
            hi[open_[~less]] = middle[~less]
        found = np.flatnonzero(known & (lo < stop))
        out = np.full(len(v), -1, dtype=np.int64)
        out[found[self._lows(lo[found]) == want[found]]] = 0
        hit = out == 0
        out[hit] = lo[hit]
        return out


MANY = 16                                                     # one question in so many values: read them all in order


class TrieLevel:
    """Successors of contexts: contexts, monotone pointers to their ranges of successors, the
    successors themselves and a quantised value and a count for each."""

    def __init__(self, buffer):
        self.width, n, n_counts = np.frombuffer(buffer, np.int64, 3).tolist()
        at = 24
        self.contexts = EliasFano(buffer, at)
        self.pointers = EliasFano(buffer, at := at + self.contexts.size)
        self.successors = EliasFano(buffer, at := at + self.pointers.size)
        self.codes = np.frombuffer(buffer, np.uint16, n, at := at + self.successors.size)
        self.counts = np.frombuffer(buffer, np.uint32, n_counts, at + 2 * n)

    @staticmethod
    def to_bytes(contexts: np.ndarray, words: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> bytes:
        """From n-grams sorted by context and word.  A successor is kept as its word plus its context's
        place times the vocabulary width, which makes one ascending sequence of all ranges.  The last
        level of a model needs no counts and gives none."""
        names, starts = np.unique(contexts, return_index=True)
        width = int(words.max()) + 1 if len(words) else 1
        place = np.repeat(np.arange(len(names)), np.diff(np.r_[starts, len(words)]))
        chain = place.astype(np.uint64) * np.uint64(width) + words.astype(np.uint64)
        return b"".join([np.array([width, len(words), len(counts)], dtype=np.int64).tobytes(), EliasFano.to_bytes(names),
                         EliasFano.to_bytes(np.r_[starts, len(words)]), EliasFano.to_bytes(chain),
                         codes.astype(np.uint16).tobytes(), np.minimum(counts, 2**32 - 1).astype(np.uint32).tobytes()])

    def find(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Position of each n-gram, or -1: the word is sought among its context's successors only."""
        return self.find_in(self.contexts.find(contexts), words)

    def find_contexts(self, ascending: np.ndarray) -> np.ndarray:
        """Places of contexts given in order, or -1."""
        many = MANY * len(ascending) > self.contexts.n
        return self.contexts.find_ascending(ascending) if many else self.contexts.find(ascending)

    def find_in(self, place: np.ndarray, words: np.ndarray) -> np.ndarray:
        """find() from the places of the contexts (-1: none)."""
        out = np.full(len(place), -1, dtype=np.int64)
        seen = np.flatnonzero((place >= 0) & (words < self.width))
        if len(seen):
            i = place[seen]
            chain = i.astype(np.uint64) * np.uint64(self.width) + words[seen].astype(np.uint64)
            if MANY * len(seen) > self.successors.n and (chain[1:] >= chain[:-1]).all():
                out[seen] = self.successors.find_ascending(chain)      # a successor's value tells its context
                return out
            out[seen] = self.successors.find(chain, self.pointers.get(i).astype(np.int64),
                                             self.pointers.get(i + 1).astype(np.int64))
        return out
