"""Hashes of all words of many texts at once, and a table to look such hashes up."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: ASCII white space: tab, line feed, vertical tab, form feed, carriage return, space.
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

EMPTY = np.uint64(2**64 - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit of ``x`` over the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd pseudo-random numbers; the first ones of a seed are always the same."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(steps + np.uint64(seed)) | np.uint64(1)


def lowered(text: str | None) -> bytes:
    """A text's UTF-8 with A-Z lower-cased; NULL is empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and where the words of each text begin (with the end last).

    Words are runs of anything but ASCII white space.
    """
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    ends_of_texts = np.cumsum([len(r) + 1 for r in raw])
    space = SPACES[data]
    starts = np.flatnonzero(~space & np.r_[True, space[:-1]])
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(raw) + 1, np.int64)
    lengths = np.flatnonzero(space & np.r_[False, ~space[:-1]]) - starts
    letters = data[~space].astype(np.uint64) + np.uint64(1)
    first = np.r_[0, np.cumsum(lengths)[:-1]]
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    factors = constants(int(lengths.max()), 17)
    hashes = mixed(np.add.reduceat(letters * factors[place], first) + lengths.astype(np.uint64))
    hashes[hashes == EMPTY] = np.uint64(0)
    return hashes, np.r_[0, np.searchsorted(starts, ends_of_texts)]


@dataclass(frozen=True)
class HashTable:
    """An open-addressing table from 64-bit keys to positions, looked up for many keys at once."""

    keys: np.ndarray
    positions: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray) -> HashTable:
        """A table of distinct keys (none of them all ones) to their index."""
        size = 1 << max(4, int(1.5 * len(keys) + 1).bit_length())
        table, positions = np.full(size, EMPTY), np.full(size, -1, dtype=np.int32)
        waiting = np.arange(len(keys))
        slots = _slots(keys, size)
        while len(waiting):
            free = table[slots] == EMPTY
            # Of several keys for a free slot the last one written has it.
            positions[slots[free]] = waiting[free]
            placed = free & (positions[slots] == waiting)
            table[slots[placed]] = keys[waiting[placed]]
            waiting, slots = waiting[~placed], (slots[~placed] + 1) & (size - 1)
        return cls(table, positions)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 for one that isn't in the table."""
        slots = _slots(keys, len(self.keys))
        there = self.keys[slots]
        found = np.where(there == keys, self.positions[slots], -1)
        open_at = np.flatnonzero((there != keys) & (there != EMPTY))
        slots = slots[open_at]
        while len(open_at):
            slots = (slots + 1) & (len(self.keys) - 1)
            there = self.keys[slots]
            same = there == keys[open_at]
            found[open_at[same]] = self.positions[slots[same]]
            more = ~same & (there != EMPTY)
            open_at, slots = open_at[more], slots[more]
        return found


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    shift = np.uint64(64 - (size.bit_length() - 1))
    return ((keys ^ (keys >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)
