"""Elias-Fano sequences and a two-level trie on them, as flat buffers that can be mapped.

A non-decreasing sequence of n integers below u keeps the low ``l = log2(u / n)`` bits of each
value packed, and the high parts in unary in a bit vector of about 2n bits. Counts of ones
per 64-bit word let single values be read, and a directory of the zeros, built when a sequence
is first searched, leads to the few values that share a given value's high part. All look-ups are vectorised over many queries.
"""

from __future__ import annotations

import mmap

import numpy as np

U64 = np.uint64


def _select_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the rank-th (from 0) one bit of each word."""
    at, rank, words = np.zeros(len(words), np.int64), rank.astype(np.int64), words.copy()
    for half in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(words & U64((1 << half) - 1)).astype(np.int64)
        up = rank >= low
        rank -= np.where(up, low, 0)
        at += np.where(up, half, 0)
        words = np.where(up, words >> U64(half), words)
    return at


class EliasFano:
    """A non-decreasing sequence of integers below 2**63."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones
        self._starts: np.ndarray | None = None

    @staticmethod
    def of(values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(U64)
        n = len(values)
        l = min(62, max(0, int(universe // max(1, n)).bit_length() - 1))
        low = np.zeros((n * l + 63) // 64 + 1, U64)
        if l and n:
            part = values & U64((1 << l) - 1)
            bit = np.arange(n, dtype=np.int64) * l
            word, shift = bit >> 6, (bit & 63).astype(U64)
            np.bitwise_or.at(low, word, part << shift)
            over = np.flatnonzero((bit & 63) + l > 64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (U64(64) - shift[over]))
        top = (values >> U64(l)).astype(np.int64)
        size = n + (universe >> l) + 2
        bits = np.zeros(-(-size // 64) * 64, np.uint8)
        bits[top + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(U64)
        ones = np.zeros(len(high) + 1, np.int64)
        np.cumsum(np.bitwise_count(high), out=ones[1:])
        return EliasFano(n, l, low, high, ones)

    def __len__(self) -> int:
        return self.n

    def _low(self, i: np.ndarray) -> np.ndarray:
        l = self.low_bits
        if not l:
            return np.zeros(len(i), U64)
        bit = i * l
        word, shift = bit >> 6, (bit & 63).astype(U64)
        out = self.low[word] >> shift
        over = np.flatnonzero((bit & 63) + l > 64)
        out[over] |= self.low[word[over] + 1] << (U64(64) - shift[over])
        return out & U64((1 << l) - 1)

    def _one(self, i: np.ndarray) -> np.ndarray:
        """Place of the i-th one bit."""
        word = np.searchsorted(self.ones, i, "right") - 1
        return word * 64 + _select_in_word(self.high[word], i - self.ones[word])

    def _directory(self) -> np.ndarray:
        """Index of the first value of each high part, read once from the zeros of the bit vector."""
        if self._starts is None:
            zeros = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little") == 0)
            starts = np.zeros(len(zeros) + 1, np.int32 if self.n < 1 << 31 else np.int64)
            starts[1:] = zeros - np.arange(len(zeros))
            self._starts = starts
        return self._starts

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        i = np.asarray(i, np.int64)
        return ((self._one(i) - i).astype(U64) << U64(self.low_bits)) | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value equal to each x, or -1."""
        x = np.asarray(x, U64)
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        starts = self._directory()
        top = (x >> U64(self.low_bits)).astype(np.int64)
        q = np.flatnonzero(top < len(starts) - 1)
        i, end = starts[top[q]].astype(np.int64), starts[top[q] + 1]
        want = x[q] & U64((1 << self.low_bits) - 1)
        some = i < end
        q, i, end, want = q[some], i[some], end[some].astype(np.int64), want[some]
        last = end.copy()
        live = np.arange(len(q))
        while len(live):  # halve the range until it starts at the first value not below
            middle = (i[live] + end[live]) >> 1
            less = self._low(middle) < want[live]
            i[live[less]] = middle[less] + 1
            end[live[~less]] = middle[~less]
            live = live[i[live] < end[live]]
        there = np.flatnonzero(i < last)
        hit = there[self._low(i[there]) == want[there]]
        out[q[hit]] = i[hit]
        return out

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits, len(self.low), len(self.high)], np.int64), self.low, self.high, self.ones]


class Trie:
    """Contexts, monotone pointers to their successors, and the successors' quantised values.

    Level 1 has the sorted contexts and, for each, its total and back-off mass, a whole number of
    ``1 / UNIT``: sums of them don't depend on their order. Level 2 has the
    successors of all contexts in turn; each is stored relative to its context, as
    ``context's place * 2**32 + successor``, which makes the level one monotone sequence.
    """

    #: Steps of a factor of ten in a stored value, and the code of the value 1.
    STEPS, ONE = 4096, 16384
    UNIT = 1 << 16

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray, totals: np.ndarray, masses: np.ndarray):
        self.contexts, self.pointers, self.successors = contexts, pointers, successors
        self.codes, self.totals, self.masses = codes, totals, masses

    @staticmethod
    def build(keys: np.ndarray, values: np.ndarray, totals: np.ndarray, masses: np.ndarray) -> Trie:
        """keys: sorted ``context << 32 | successor``; totals and masses by context in order."""
        context = keys >> U64(32)
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(keys) else np.zeros(0, np.int64)
        place = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(keys)]))
        relative = (place.astype(U64) << U64(32)) | (keys & U64(0xFFFFFFFF))
        return Trie(
            EliasFano.of(context[first], 1 << 32),
            EliasFano.of(np.r_[first, len(keys)].astype(U64), len(keys) + 1),
            EliasFano.of(relative, max(1, len(first)) << 32),
            Trie.quantised(values),
            totals.astype("<i8"),
            masses.astype("<i8"),
        )

    @staticmethod
    def quantised(values: np.ndarray) -> np.ndarray:
        """Codes of positive values on a logarithmic scale; 0 is kept for what is absent."""
        with np.errstate(divide="ignore"):
            x = np.rint(np.log10(np.maximum(values, 1e-3)) * Trie.STEPS) + Trie.ONE
        return np.clip(x, 1, 65535).astype("<u2")

    @staticmethod
    def units(codes: np.ndarray) -> np.ndarray:
        """The values of codes in units."""
        return np.where(codes == 0, 0, np.rint(Trie.UNIT * 10.0 ** ((codes.astype(np.float64) - Trie.ONE) / Trie.STEPS))).astype(np.int64)

    @staticmethod
    def value(codes: np.ndarray) -> np.ndarray:
        return Trie.units(codes) / Trie.UNIT

    def context(self, v: np.ndarray) -> np.ndarray:
        """Place of each context, or -1."""
        return self.contexts.find(v)

    def lookup(self, place: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Codes of the successors of contexts by their places; 0 where absent."""
        out = np.zeros(len(place), "<u2")
        q = np.flatnonzero(place >= 0)
        at = self.successors.find((place[q].astype(U64) << U64(32)) | successor[q].astype(U64))
        found = at >= 0
        out[q[found]] = self.codes[at[found]]
        return out

    def degree(self, place: np.ndarray) -> np.ndarray:
        """Number of successors of the contexts at these places."""
        return (self.pointers.get(place + 1) - self.pointers.get(place)).astype(np.int64)

    def tobytes(self) -> bytes:
        """All levels in one flat buffer, each array at a multiple of 8 bytes."""
        out = []
        for a in (*self.contexts.arrays(), *self.pointers.arrays(), *self.successors.arrays(), np.array([len(self.codes), len(self.totals)], np.int64), self.codes, self.totals, self.masses):
            raw = a.tobytes()
            out.append(raw + b"\0" * (-len(raw) % 8))
        return b"".join(out)

    @staticmethod
    def view(buffer: bytes | mmap.mmap | memoryview) -> Trie:
        """A trie whose levels are views into a buffer, such as a mapped file; nothing is copied."""
        at = 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            a = np.frombuffer(buffer, kind, n, at)
            at += -(-a.nbytes // 8) * 8
            return a

        levels = []
        for _ in range(3):
            n, bits, low, high = take("<i8", 4).tolist()
            levels.append(EliasFano(n, bits, take("<u8", low), take("<u8", high), take("<i8", high + 1)))
        n, contexts = take("<i8", 2).tolist()
        return Trie(*levels, take("<u2", n), take("<i8", contexts), take("<i8", contexts))

    def mapped(self) -> Trie:
        """The same trie in a memory map of its own, so that its pages are shared and can be dropped at once."""
        raw = self.tobytes()
        held = mmap.mmap(-1, max(8, len(raw)))
        held.write(raw)
        return Trie.view(held)
