"""An FM-index of numbered words: backward search by wavelet ranks, places by sampled suffix positions."""

from __future__ import annotations

import numpy as np

from quayside.llm.arrays import ranges

U64 = np.uint64

#: A place is kept for one suffix in so many, and for the first word of every text.
SAMPLED = 16


class Bits:
    """A bit vector that counts the ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        held = np.packbits(bits, bitorder="little")
        packed[: len(held)] = held
        self._words = packed.view(U64)
        self._before = np.zeros(len(self._words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self._words), out=self._before[1:])
        self.ones = int(self._before[-1])

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return (self._words[at >> 6] >> (at & 63).astype(U64) & U64(1)).astype(bool)

    def rank(self, at: np.ndarray) -> np.ndarray:
        below = (U64(1) << (at & 63).astype(U64)) - U64(1)
        return self._before[at >> 6] + np.bitwise_count(self._words[at >> 6] & below)


class Wavelet:
    """A wavelet matrix: the places of a symbol before any place, and the symbol at it."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in reversed(range(max(1, (n_symbols - 1).bit_length()))):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), len(symbols) - int(ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        # Where each symbol's places begin below the last level.
        self._start = np.zeros(n_symbols, np.int64)
        if len(symbols):
            first = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
            self._start[symbols[first]] = first

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is before each place."""
        for bit, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where(symbol >> bit & 1, zeros + ones, at - ones)
        return at - self._start[symbol]

    def symbol(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it is before it."""
        found = np.zeros(len(at), np.int64)
        for bit, bits, zeros in self.levels:
            one = bits[at]
            ones = bits.rank(at)
            at = np.where(one, zeros + ones, at - ones)
            found |= one.astype(np.int64) << bit
        return found, at - self._start[found]


def suffix_order(symbols: np.ndarray, n_symbols: int) -> np.ndarray:
    """Suffixes in order, by prefix doubling; the first round takes as many symbols as fit 62 bits."""
    n = len(symbols)
    width = max(1, n_symbols.bit_length())
    known = max(1, 62 // width)
    keys = np.zeros(n, np.int64)
    for k in range(min(known, n)):
        # Past the end is smaller than any symbol.
        keys[: n - k] |= (symbols[k:] + 1) << (width * (known - 1 - k))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.append(True, keys[1:] != keys[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while True:
        slots = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(slots):
            return order
        open_ = order[slots]
        beyond = open_ + known
        second = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        keys = rank[open_] * (n + 1) + second
        by_key = np.argsort(keys, kind="stable")
        order[slots] = open_[by_key]
        keys = keys[by_key]
        new[slots] = np.append(True, keys[1:] != keys[:-1])
        # A suffix's rank is the slot its group begins at.
        rank[order[slots]] = np.maximum.accumulate(np.where(new, np.arange(n), 0))[slots]
        known *= 2


class FMIndex:
    """Texts of numbered words, ``words[i]`` in ``[0, n_words)``, of text ``of[i]``; a text may have none.

    Each text is closed by an end of its own, so that no match crosses texts.
    """

    def __init__(self, words: np.ndarray, of: np.ndarray, texts: int, n_words: int):
        n = len(words) + texts
        at = np.arange(len(words)) + of
        ends = np.ones(n, bool)
        ends[at] = False
        closed = np.empty(n, np.int64)
        closed[ends] = np.arange(texts)
        closed[at] = words + texts
        order = suffix_order(closed, n_words + texts)
        # From here on all ends are one symbol, 0, and words count from 1.
        symbols = np.zeros(n, np.int64)
        symbols[at] = words + 1
        self._before = np.zeros(n_words + 2, np.int64)
        np.cumsum(np.bincount(symbols, minlength=n_words + 1), out=self._before[1:])
        self._transform = Wavelet(symbols[order - 1], n_words + 1)
        first = np.append(True, ends[:-1])
        kept = (order % SAMPLED == 0) | first[order]
        self._kept = Bits(kept)
        self._places = order[kept]
        self.size = n
        #: The number among words of every place that is no end.
        self.word = np.cumsum(~ends) - 1

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of the suffixes that begin with each pattern, a row of words of equal length."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        open_ = np.arange(len(patterns))
        for column in patterns.T[::-1] + 1:
            symbol = column[open_]
            low[open_] = self._before[symbol] + self._transform.rank(symbol, low[open_])
            high[open_] = self._before[symbol] + self._transform.rank(symbol, high[open_])
            open_ = open_[low[open_] < high[open_]]
        high = np.maximum(low, high)
        return low, high

    def places(self, rows: np.ndarray) -> np.ndarray:
        """The word at which each row's suffix begins: steps back to a kept place."""
        out = np.empty(len(rows), np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            kept = self._kept[rows]
            out[todo[kept]] = self._places[self._kept.rank(rows[kept])] + steps
            todo, rows = todo[~kept], rows[~kept]
            symbol, rank = self._transform.symbol(rows)
            rows = self._before[symbol] + rank
            steps += 1
        return self.word[out]

    def locate(self, low: np.ndarray, high: np.ndarray, at_once: int = 1 << 18):
        """``word, pattern`` of all rows of the intervals, so many at a time."""
        total = np.cumsum(high - low)
        begin = 0
        while begin < len(low):
            before = total[begin - 1] if begin else 0
            # A long interval by itself is cut.
            if total[begin] - before > at_once:
                for a in range(int(low[begin]), int(high[begin]), at_once):
                    rows = np.arange(a, min(a + at_once, int(high[begin])))
                    yield self.places(rows), np.full(len(rows), begin)
                begin += 1
                continue
            to = int(np.searchsorted(total, before + at_once, "right"))
            sizes = high[begin:to] - low[begin:to]
            yield self.places(ranges(low[begin:to], sizes)), np.repeat(np.arange(begin, to), sizes)
            begin = to
