"""Elias-Fano sequences and the two-level n-gram trie made of them, over bytes that may be memory-mapped."""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

_ONE = np.uint64(1)
#: Lookups made at once.
CHUNK = 1 << 16


def _words(bits: np.ndarray) -> np.ndarray:
    packed = np.packbits(bits, bitorder="little")
    return np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]).view("<u8")


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Integers of ``width`` bits one after the other, in 64-bit words."""
    if width == 0 or not len(values):
        return np.zeros(1, np.uint64)
    at = np.arange(len(values), dtype=np.int64) * width
    words = np.zeros((len(values) * width + 63) // 64 + 1, np.uint64)
    shift = (at & 63).astype(np.uint64)
    np.bitwise_or.at(words, at >> 6, values << shift)
    over = np.flatnonzero(shift.astype(np.int64) + width > 64)
    np.bitwise_or.at(words, (at[over] >> 6) + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


class Sequence:
    """A sorted sequence of non-negative integers: low bits packed, high bits in unary, about 2 + log(universe / n) bits each."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        # Ones and zeros before each word; all that is kept besides the bits.
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(high) + 1, dtype=np.int64) * 64 - self.ones

    @classmethod
    def of(cls, values: np.ndarray) -> Sequence:
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(width)).astype(np.int64)
        bits = np.zeros(n + (int(high[-1]) if n else 0) + 1, np.uint8)
        bits[high + np.arange(n)] = 1
        return cls(n, width, _packed(values & np.uint64((1 << width) - 1), width), _words(bits))

    def to_bytes(self) -> bytes:
        return struct.pack("<4q", self.n, self.width, len(self.low), len(self.high)) + self.low.astype("<u8").tobytes() + self.high.astype("<u8").tobytes()

    @classmethod
    def read(cls, data, at: int) -> tuple[Sequence, int]:
        """From a buffer, without a copy; and where it ends."""
        n, width, low, high = struct.unpack_from("<4q", data, at)
        at += 32
        words = np.frombuffer(data, "<u8", low + high, at)
        return cls(n, width, words[:low], words[low:]), at + 8 * (low + high)

    def _select(self, bit: int, rank: np.ndarray) -> np.ndarray:
        """Where the ``rank``-th (from 0) one or zero of the high bits is."""
        before = self.ones if bit else self.zeros
        result = np.empty(len(rank), np.int64)
        for start in range(0, len(rank), CHUNK):
            part = rank[start : start + CHUNK]
            word = np.searchsorted(before, part, side="right") - 1
            left = part - before[word]
            bits = self.high[word] if bit else ~self.high[word]
            at = np.zeros(len(part), np.uint64)
            # Halve the word six times, towards the half that holds the bit.
            for half in (32, 16, 8, 4, 2, 1):
                inside = np.bitwise_count(bits & np.uint64((1 << half) - 1)).astype(np.int64)
                beyond = left >= inside
                left = left - inside * beyond
                step = beyond * np.uint64(half)
                bits = bits >> step
                at += step
            result[start : start + CHUNK] = word * 64 + at.astype(np.int64)
        return result

    def _low(self, i: np.ndarray) -> np.ndarray:
        if self.width == 0:
            return np.zeros(len(i), np.uint64)
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        over = self.low[np.minimum(word + 1, len(self.low) - 1)]
        # A shift by 64 is none in numpy, hence the two steps.
        value = (self.low[word] >> shift) | ((over << (np.uint64(63) - shift)) << _ONE)
        return value & np.uint64((1 << self.width) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        high = (self._select(1, i) - i).astype(np.uint64)
        return (high << np.uint64(self.width)) | self._low(i)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of the first element that is not less than each value; ``n`` if there is none."""
        values = np.asarray(values, np.uint64)
        if self.n == 0:
            return np.zeros(len(values), np.int64)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        most = int(self.zeros[-1])
        last = len(self.high) * 64 - self.n
        # Elements with smaller high bits, and those up to the same: a bucket in which the low bits are sorted.
        inside = high < min(most, last)
        lo, hi = np.full(len(values), self.n, np.int64), np.full(len(values), self.n, np.int64)
        at = high[inside]
        first = np.zeros(len(at), np.int64)
        some = at > 0
        first[some] = self._select(0, at[some] - 1) - (at[some] - 1)
        lo[inside], hi[inside] = first, np.minimum(self._select(0, at) - at, self.n)
        want = values & np.uint64((1 << self.width) - 1)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            middle = (lo[open_] + hi[open_]) >> 1
            less = self._low(middle) < want[open_]
            lo[open_[less]] = middle[less] + 1
            hi[open_[~less]] = middle[~less]


def quantised(values: np.ndarray, bits: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Codes of ``bits`` bits and the value that each stands for: the mean of its equally many values."""
    names, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    if len(names) > 1 << bits:
        cell = ((np.cumsum(counts) - 1) * (1 << bits) // max(len(values), 1)).astype(np.int64)
        _, cell = np.unique(cell, return_inverse=True)
    else:
        cell = np.arange(len(names))
    sums = np.bincount(cell, names * counts)
    return cell[inverse].astype(np.uint8), sums / np.maximum(np.bincount(cell, counts), 1)


@dataclass
class Trie:
    """Contexts and their successors, with quantised log10 probabilities.

    Level 1: the words of this shard, sorted, each with the code of its own probability, the code of the weight that it leaves to
    unseen successors as a context, and a pointer to its successors. Level 2: all successors, context by context. A
    successor is stored as its id above the last element of the context before, so that the level is one sorted sequence
    and a search in it stays within the context.
    """

    words: Sequence
    pointers: Sequence
    successors: Sequence
    codes: tuple[np.ndarray, np.ndarray, np.ndarray]
    books: tuple[np.ndarray, np.ndarray, np.ndarray]

    @classmethod
    def build(cls, words, own, left, first, second, seen) -> Trie:
        """From sorted ``words`` with log10 ``own`` and ``left``; pairs ``first, second`` (sorted) with log10 ``seen``."""
        words = np.asarray(words, np.uint64)
        place = np.searchsorted(words, first)
        pointers = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(words)))])
        second = np.asarray(second, np.uint64) + _ONE
        ends = pointers[1:][np.diff(pointers) > 0]
        steps = np.zeros(len(words) + 1, np.uint64)
        steps[1:][np.diff(pointers) > 0] = second[ends - 1]
        base = np.cumsum(steps, dtype=np.uint64)
        codes, books = zip(*(quantised(np.asarray(x, float)) for x in (own, left, seen)), strict=True)
        return cls(Sequence.of(words), Sequence.of(pointers), Sequence.of(base[place] + second), codes, books)

    def to_bytes(self) -> bytes:
        parts = [s.to_bytes() for s in (self.words, self.pointers, self.successors)]
        for codes, book in zip(self.codes, self.books, strict=True):
            pad = -len(codes) % 8
            parts.append(struct.pack("<2q", len(codes), len(book)) + book.astype("<f8").tobytes() + codes.tobytes() + bytes(pad))
        return b"".join(parts)

    @classmethod
    def open(cls, data) -> Trie:
        """Over a buffer, such as a memory map; its bytes are not copied."""
        at, sequences, codes, books = 0, [], [], []
        for _ in range(3):
            sequence, at = Sequence.read(data, at)
            sequences.append(sequence)
        for _ in range(3):
            n, size = struct.unpack_from("<2q", data, at)
            books.append(np.frombuffer(data, "<f8", size, at + 16))
            codes.append(np.frombuffer(data, np.uint8, n, at + 16 + 8 * size))
            at += 16 + 8 * size + n + -n % 8
        return cls(*sequences, tuple(codes), tuple(books))

    def _word(self, ids: np.ndarray) -> np.ndarray:
        """Places in level 1, -1 for ids that are not in it."""
        at = self.words.find(ids)
        found = np.flatnonzero(at < self.words.n)
        wrong = self.words.get(at[found]) != np.asarray(ids, np.uint64)[found]
        result = np.full(len(at), -1, np.int64)
        result[found[~wrong]] = at[found[~wrong]]
        return result

    def score(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """log10 of the probability of ``second`` after ``first``, both in level 1: the pair's own, or else what the context
        leaves to unseen words, times the word's own."""
        contexts, of_context = np.unique(np.asarray(first, np.uint64), return_inverse=True)
        names, of_word = np.unique(np.asarray(second, np.uint64), return_inverse=True)
        context, word = self._word(contexts), self._word(names)
        start = self.pointers.get(context).astype(np.int64)
        end = self.pointers.get(context + 1).astype(np.int64)
        base = np.zeros(len(context), np.uint64)
        after = np.flatnonzero((start > 0) & (start < end))
        base[after] = self.successors.get(start[after] - 1)
        want = base[of_context] + names[of_word] + _ONE
        at = self.successors.find(want)
        near = np.flatnonzero((at >= start[of_context]) & (at < end[of_context]))
        hit = near[self.successors.get(at[near]) == want[near]]
        left, own = self.books[1][self.codes[1][context]], self.books[0][self.codes[0][word]]
        result = left[of_context] + own[of_word]
        result[hit] = self.books[2][self.codes[2][at[hit]]]
        return result
