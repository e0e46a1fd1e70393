"""Elias-Fano sequences and an n-gram trie over them, as bytes that can be memory-mapped.

A sorted sequence of n integers below u keeps the lower log2(u / n) bits of each value
packed, and the upper bits as a bit vector with a one per value and a zero per upper
value. All look-ups take arrays of queries.
"""

from __future__ import annotations

import struct
import tempfile

import numpy as np

AT_ONCE = 1 << 16  # queries whose bits are unpacked at a time


def nth_one(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the rank-th (from 0) one of each 64-bit word, by halving the bits it can be among."""
    word, rank, at = word.astype("uint64"), rank.astype("u1"), np.zeros(len(word), "u1")
    for width in (32, 16, 8, 4, 2, 1):
        ones = np.bitwise_count(word & np.uint64((1 << width) - 1))
        later = rank >= ones
        rank = rank - ones * later
        step = later * np.uint8(width)
        word = word >> step
        at += step
    return at.astype("int64")


class Bits:
    """A bit vector with select, by the counts of ones before each 64-bit word."""

    def __init__(self, words: np.ndarray):
        self.words = words
        ones = np.bitwise_count(words).astype("int64")
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    def select(self, rank: np.ndarray, bit: int) -> np.ndarray:
        """Position of the rank-th (from 0) one or zero."""
        before = self.ones if bit else self.zeros
        out = np.empty(len(rank), "int64")
        for s in range(0, len(rank), AT_ONCE):
            r = rank[s : s + AT_ONCE]
            w = np.searchsorted(before, r, "right") - 1
            word = self.words[w] if bit else ~self.words[w]
            out[s : s + AT_ONCE] = w * 64 + nth_one(word, r - before[w])
        return out


class Sequence:
    """A sorted sequence; ``data`` is what ``pack`` returned, or a memory map of it."""

    def __init__(self, data: np.ndarray):
        self.n, self.low_bits, low_size, high_words = struct.unpack("<QQQQ", data[:32].tobytes())
        self.low = data[32 : 32 + low_size]
        self.high = Bits(data[32 + low_size : 32 + low_size + 8 * high_words].view("<u8"))
        self.size = 32 + low_size + 8 * high_words

    @staticmethod
    def pack(values: np.ndarray) -> bytes:
        values = values.astype("uint64")
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(1, n)).bit_length() - 1)
        low = values & np.uint64((1 << bits) - 1)
        every = np.arange(bits, dtype="uint64")
        slices = (low[i : i + AT_ONCE, None] >> every & np.uint64(1) for i in range(0, n, AT_ONCE))  # whole bytes each
        packed = b"".join(np.packbits(x.astype("u1").ravel(), bitorder="little").tobytes() for x in slices)
        packed += bytes(8 + -(len(packed) + 8) % 8)  # room for reading 8 bytes at any value
        high = (values >> np.uint64(bits)).astype("int64")
        length = (int(high[-1]) if n else 0) + n + 2
        vector = np.zeros(-(-length // 64) * 64, "u1")
        vector[high + np.arange(n)] = 1
        words = np.packbits(vector, bitorder="little").tobytes()
        return struct.pack("<QQQQ", n, bits, len(packed), len(words) // 8) + packed + words

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), "uint64")
        at = i * self.low_bits
        eight = np.ndarray(len(self.low) - 7, "<u8", self.low, strides=(1,))  # the 8 bytes from any byte on
        return (eight[at >> 3] >> (at & 7).astype("uint64")) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.high.select(i, 1) - i).astype("uint64") << np.uint64(self.low_bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first value of at least x among those with its upper bits, whether it equals x)."""
        x = x.astype("uint64")
        h = (x >> np.uint64(self.low_bits)).astype("int64")
        most = len(self.high.words) * 64 - self.n - 1  # zeros that there are
        inside = h <= most
        h = np.minimum(h, most)
        end = self.high.select(h, 0) - h
        low = np.where(h > 0, self.high.select(np.maximum(h - 1, 0), 0) - h + 1, 0)
        last, want = end.copy(), x & np.uint64((1 << self.low_bits) - 1)
        while (open_ := low < last).any():
            at = np.flatnonzero(open_)
            mid = (low[at] + last[at]) // 2
            less = self._low(mid) < want[at]
            low[at] = np.where(less, mid + 1, low[at])
            last[at] = np.where(less, last[at], mid)
        hit = inside & (low < end)
        hit[hit] = self._low(low[hit]) == want[hit]
        return low, hit


class Trie:
    """Bigrams under their last word: word level, pointers, and first words relative to their node.

    First words are numbered by a level of their own. In the second level, a node's
    numbers are raised by the previous node's last entry plus one, so that the whole level
    is one increasing sequence; a query does the same with its own number and looks for
    its successor. Each bigram has a one-byte code of its quantised value.
    """

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as f:  # has no name, and goes with its last map
            f.write(data)
            f.flush()
            raw = np.memmap(f, "u1", "r")
        at, levels = 0, []
        for _ in range(4):
            levels.append(Sequence(raw[at:]))
            at += levels[-1].size
        self.first, self.words, self.pointers, self.pairs = levels
        self.book = raw[at : at + 1024].view("<f4")
        self.codes = raw[at + 1024 : at + 1024 + self.pairs.n]

    @staticmethod
    def pack(words: np.ndarray, first: np.ndarray, values: np.ndarray) -> bytes:
        """Distinct bigrams, sorted by word, then first word."""
        names, number = np.unique(first, return_inverse=True)
        nodes, begin = np.unique(words, return_index=True)
        end = np.append(begin[1:], len(words))
        number = number.astype("int64")
        last = number[end - 1] + 1 if len(words) else np.zeros(0, "int64")
        base = np.concatenate([[0], np.cumsum(last)[:-1]]) if len(words) else np.zeros(0, "int64")
        level = number + np.repeat(base, end - begin)
        book = np.quantile(values, np.linspace(0, 1, 256)) if len(values) else np.zeros(256)
        code = np.clip(np.searchsorted(book, values, "right") - 1, 0, 255).astype("u1")  # never above the value
        parts = [Sequence.pack(x) for x in (names, nodes, np.append(begin, len(words)), level)]
        return b"".join(parts) + book.astype("<f4").tobytes() + code.tobytes()

    def find(self, words: np.ndarray, runs: np.ndarray, first: np.ndarray, unseen: float) -> np.ndarray:
        """Values of bigrams: ``words`` with ``runs`` first words each, in ``first``; ``unseen`` for those that aren't there."""
        out = np.full(len(first), unseen)
        if not self.pairs.n or not len(first):
            return out
        node, there = self.words.successor(words)
        names, back = np.unique(first, return_inverse=True)
        number, named = self.first.successor(names)
        ask = np.flatnonzero(np.repeat(there, runs) & named[back])
        if not len(ask):
            return out
        node = np.repeat(np.where(there, node, 0), runs)[ask]
        begin = self.pointers.get(node).astype("int64")
        base = np.zeros(len(ask), "uint64")
        later = begin > 0
        base[later] = self._raise(node[later])
        place, hit = self.pairs.successor(base + number[back][ask].astype("uint64"))
        hit &= (place >= begin) & (place < self.pointers.get(node + 1).astype("int64"))
        out[ask[hit]] = self.book[self.codes[place[hit]]]
        return out

    def _raise(self, node: np.ndarray) -> np.ndarray:
        """One more than the last entry of the node before."""
        nodes, back = np.unique(node, return_inverse=True)
        return (self.pairs.get(self.pointers.get(nodes).astype("int64") - 1) + np.uint64(1))[back]
