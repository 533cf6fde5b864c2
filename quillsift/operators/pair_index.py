"""Words as linked symbols, with an index from each pair of neighbours to its places.

A merge looks up the places of its pair, changes them in place and tells how the counts of the pairs around
them move; words without the pair are not touched. Symbols are code points, so a pair is one integer and
pairs compare by their left, then their right symbol.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

SHIFT = 32
BORDER, GONE = 0, -1
NOTHING = np.zeros(0, dtype=np.int64)


def pair_key(left: int, right: int) -> int:
    return left << SHIFT | right


def _summed(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with their summed amounts, those of 0 left out."""
    if not len(keys):
        return keys, amounts
    order = np.argsort(keys, kind="stable")
    keys, amounts = keys[order], amounts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    totals = np.add.reduceat(amounts, starts)
    return keys[starts][totals != 0], totals[totals != 0]


class Merge(NamedTuple):
    """What undoes a merge: its places, their right halves, both symbols."""

    at: np.ndarray
    halves: np.ndarray
    left: int
    right: int


class PairIndex:
    def __init__(self, words: list[str], counts: np.ndarray):
        codes = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), dtype=np.uint32).astype(np.int32)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        # Places fit in 32 bits: an index holds a bounded number of symbols.
        self.symbols = codes
        self.after = np.arange(1, len(codes) + 1, dtype=np.int32)
        self.before = np.arange(-1, len(codes) - 1, dtype=np.int32)
        self.weights = np.concatenate(([0], np.repeat(np.asarray(counts, dtype=np.int64), lengths)))[: len(codes)]
        self.first: tuple[np.ndarray, np.ndarray] | None = None
        self.later: dict[int, list[np.ndarray]] = {}

    def _sort(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs in order with their places, made for the first merge."""
        slots = self._slots()
        keys = self._keys(slots)
        order = np.argsort(keys, kind="stable")
        return keys[order], slots[order]

    def _slots(self) -> np.ndarray:
        """Places of all symbols that have a neighbour behind them."""
        alive = np.flatnonzero(self.symbols > 0).astype(np.int32)
        return alive[self.symbols[self.after[alive]] > 0]

    def _keys(self, slots: np.ndarray) -> np.ndarray:
        return self.symbols[slots].astype(np.int64) << SHIFT | self.symbols[self.after[slots]]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Every pair with the summed counts of its words."""
        slots = self._slots()
        return _summed(self._keys(slots), self.weights[slots])

    def places(self, key: int) -> np.ndarray:
        """Where the pair stands now, in order."""
        if self.first is None:
            self.first = self._sort()
        first_keys, first_slots = self.first
        low, high = np.searchsorted(first_keys, [key, key + 1])
        found = np.concatenate([first_slots[low:high], *self.later.get(key, ())])
        found = found[self.symbols[found] == key >> SHIFT]
        found = found[self.symbols[self.after[found]] == key & ((1 << SHIFT) - 1)]
        return np.unique(found)

    def merge(self, left: int, right: int, merged: int) -> tuple[np.ndarray, np.ndarray, Merge]:
        """Replaces the pair from left to right; (pairs, how their counts move, what undoes it)."""
        symbols, after, before = self.symbols, self.after, self.before
        at = self.places(pair_key(left, right))
        if left == right and len(at) > 1:
            # In a run of equal symbols every other place merges.
            number = np.arange(len(at))
            breaks = np.concatenate(([True], at[1:] != after[at[:-1]]))
            at = at[(number - np.maximum.accumulate(np.where(breaks, number, 0))) % 2 == 0]
        if not len(at):
            return NOTHING, NOTHING, Merge(at, at, left, right)
        halves = after[at]
        ahead, behind = before[at], after[halves]
        old = np.unique(np.concatenate((ahead[symbols[ahead] > 0], at, halves[symbols[behind] > 0])))
        old_keys = self._keys(old)
        symbols[at], symbols[halves] = merged, GONE
        after[at], before[behind] = behind, at
        ahead = before[at]
        new = np.unique(np.concatenate((ahead[symbols[ahead] > 0], at[symbols[after[at]] > 0])))
        new_keys = self._keys(new)
        if len(new):
            order = np.argsort(new_keys, kind="stable")
            sorted_keys, sorted_slots = new_keys[order], new[order]
            starts = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
            for key, part in zip(sorted_keys[starts].tolist(), np.split(sorted_slots, starts[1:])):
                self.later.setdefault(key, []).append(part)
        weights = np.concatenate((-self.weights[old], self.weights[new]))
        return *_summed(np.concatenate((old_keys, new_keys)), weights), Merge(at, halves, left, right)

    def undo(self, done: Merge) -> None:
        """Takes back the latest merge; places found for its pairs stay in the index and no longer match."""
        behind = self.after[done.at]
        self.symbols[done.at], self.symbols[done.halves] = done.left, done.right
        self.before[behind] = done.halves
        self.after[done.at] = done.halves

    def words(self) -> list[str]:
        """The words as they are now."""
        left = self.symbols[self.symbols != GONE].astype(np.uint32)
        return left.tobytes().decode("utf-32-le")[1:-1].split("\0")

    def parts(self, frequent: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The words cut inside every pair that is not among the sorted keys, and what each part counts for; lone symbols go."""
        slots = self._slots()
        rare = slots[~np.isin(self._keys(slots), frequent)] + 1
        symbols, weights = np.insert(self.symbols, rare, BORDER), np.insert(self.weights, rare, 0)
        symbols, weights = symbols[symbols != GONE], weights[symbols != GONE]
        starts = np.flatnonzero(symbols[:-1] == BORDER) + 1
        lines = symbols.astype(np.uint32).tobytes().decode("utf-32-le")[1:-1].split("\0")
        keep = [i for i, line in enumerate(lines) if len(line) > 1]
        return [lines[i] for i in keep], weights[starts[keep]]
