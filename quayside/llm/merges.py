"""Byte-pair merging of many words at once.

A word's symbols are merged pair by pair: the pair of lowest rank first, of
equal ones the leftmost, until no pair is in the table.  Words do not touch each
other, so one step is taken in all of them together.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np

from quayside.llm.arrays import U64

NONE = np.int32(2**31 - 1)

#: Longer words are merged one by one, with an agenda.
LONG_WORD = 64

#: ``skip(left start, right start, right end)``: which candidate merges do not happen.
Skip = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


class MergeTable:
    """Rank and result of every pair of symbols that can be merged."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray, rank: np.ndarray):
        keys = left.astype(U64) << U64(32) | right.astype(U64)
        order = np.argsort(keys)
        self._keys = keys[order]
        self._merged = np.append(merged[order], 0).astype(np.int32)
        self._rank = np.append(rank[order], NONE).astype(np.int32)
        self._slots = None

    def __getstate__(self):
        return self.__dict__ | {"_slots": None}

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of each pair, the last number for pairs that are not there."""
        if self._slots is None:
            self._slots = np.full(1 << 20, len(self._keys), np.int32)
            self._slots[self._slot(self._keys)] = np.arange(len(self._keys))
        keys = left.astype(U64) << U64(32) | right.astype(U64)
        at = self._slots[self._slot(keys)]
        other = np.flatnonzero((at < len(self._keys)) & (self._keys[np.minimum(at, len(self._keys) - 1)] != keys))
        if len(other):
            searched = np.minimum(np.searchsorted(self._keys, keys[other]), len(self._keys) - 1)
            at[other] = np.where(self._keys[searched] == keys[other], searched, len(self._keys))
        return at

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * U64(0x9E3779B97F4A7C15)) >> U64(44)

    def apply(self, symbols: np.ndarray, lengths: np.ndarray, skip: Skip | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of consecutive words, and where each begins in ``symbols``.

        Symbols below 0 are never merged.  ``skip`` gets places in ``symbols``.
        Words of one length are merged together, a symbol to a row; a merge
        makes them one shorter, so that the longest come first.
        """
        result, alive = symbols.astype(np.int32).copy(), np.ones(len(symbols), bool)
        begin = np.cumsum(lengths) - lengths
        for word in np.flatnonzero(lengths > LONG_WORD):
            self._agenda(result, alive, int(begin[word]), int(lengths[word]), skip)
        by_length = np.argsort(lengths, kind="stable")
        bounds = np.searchsorted(lengths[by_length], np.arange(LONG_WORD + 2))
        symbol = place = rank = np.zeros((0, 0), np.int32)
        for size in range(min(LONG_WORD, int(lengths.max(initial=0))), 1, -1):
            fresh = begin[by_length[bounds[size] : bounds[size + 1]]]
            if len(fresh):
                own = (fresh + np.arange(size + 1)[:, None]).astype(np.int32)
                held = result[own[:-1]]
                ranks = self._ranks(
                    *(x.ravel() for x in (held[:-1], held[1:], own[:-2], own[1:-1], own[2:])), skip
                ).reshape(size - 1, -1)
                if symbol.shape[1]:
                    symbol, place, rank = (
                        np.concatenate(x, axis=1) for x in ((symbol, held), (place, own), (rank, ranks))
                    )
                else:
                    symbol, place, rank = held, own, ranks
            if not symbol.shape[1]:
                continue
            best, least = np.zeros(symbol.shape[1], np.int32), rank[0].copy()
            for k in range(1, size - 1):
                np.copyto(best, k, where=rank[k] < least)
                np.minimum(least, rank[k], out=least)
            going = least < NONE
            if not going.all():
                over, left = np.flatnonzero(~going), np.flatnonzero(going)
                result[place[:-1].take(over, axis=1)] = symbol.take(over, axis=1)
                symbol, place, rank, best = (x.take(left, axis=-1) for x in (symbol, place, rank, best))
            if not len(best):
                symbol = place = rank = np.zeros((0, 0), np.int32)
                continue
            column = np.arange(len(best))
            alive[place[best + 1, column]] = False
            merged = self._merged[self.find(symbol[best, column], symbol[best + 1, column])]
            later = best < np.arange(size, dtype=np.int32)[:, None]
            symbol = np.where(later[:-1], symbol[1:], symbol[:-1])
            symbol[best, column] = merged
            place = np.where(later, place[1:], place[:-1])
            rank = np.where(later[:-2], rank[1:], rank[:-1])
            for at, of in ((best - 1, best > 0), (best, best < size - 2)):
                at, of = at[of], column[of]
                rank[at, of] = self._ranks(
                    symbol[at, of], symbol[at + 1, of], place[at, of], place[at + 1, of], place[at + 2, of], skip
                )
            if size == 2:
                result[place[0]] = symbol[0]
        return result[alive], np.flatnonzero(alive)

    def _ranks(self, left, right, start, middle, end, skip) -> np.ndarray:
        found = self.find(np.maximum(left, 0), np.maximum(right, 0))
        rank = self._rank[found]
        rank[(left < 0) | (right < 0)] = NONE
        if skip is not None:
            there = np.flatnonzero(rank < NONE)
            rank[there[skip(start[there], middle[there], end[there])]] = NONE
        return rank

    def _agenda(self, result, alive, begin, length, skip) -> None:
        """One long word, by a priority queue of candidate merges."""
        symbol = result[begin : begin + length].tolist()
        after = [*range(1, length), -1]
        before = [*range(-1, length - 1)]
        end = [*range(1, length + 1)]
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(lefts: list[int]) -> None:
            at = np.array(lefts)
            rights = np.array([after[k] for k in lefts])
            left, right = np.array([symbol[k] for k in lefts]), np.array([symbol[k] for k in rights])
            found = self.find(np.maximum(left, 0), np.maximum(right, 0))
            found[(left < 0) | (right < 0)] = len(self._keys)
            if skip is not None:
                ends = np.array([end[k] for k in rights])
                found[skip(at + begin, rights + begin, ends + begin)] = len(self._keys)
            for k, f in zip(lefts, found.tolist(), strict=True):
                if f < len(self._keys):
                    heapq.heappush(agenda, (int(self._rank[f]), k, symbol[k], symbol[after[k]], int(self._merged[f])))

        offer([*range(length - 1)])
        gone = [False] * length
        while agenda:
            _, at, left, right, merged = heapq.heappop(agenda)
            to = after[at]
            if gone[at] or to < 0 or symbol[at] != left or symbol[to] != right:
                continue
            symbol[at], end[at], gone[to] = merged, end[to], True
            after[at] = after[to]
            if after[to] >= 0:
                before[after[to]] = at
            near = [k for k in (before[at], at) if k >= 0 and after[k] >= 0]
            if near:
                offer(near)
        result[begin : begin + length] = symbol
        alive[begin : begin + length] = ~np.array(gone)
