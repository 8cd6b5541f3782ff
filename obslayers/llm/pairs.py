"""A hashed table of symbol pairs, looked up for whole arrays at once."""

from __future__ import annotations

import numpy as np

NO_PAIR = np.int32(2**31 - 1)
_EMPTY = np.uint64(2**64 - 1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open addressing over (left, right); at most half of the slots are taken.

    ``rank`` gives the pair's place in the order of merges, ``NO_PAIR`` where there is
    none, and ``merged`` the symbol that the pair becomes. Symbols are non-negative;
    a negative symbol (padding) belongs to no pair.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        bits = max(4, int(2 * len(left)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self._keys = np.full(1 << bits, _EMPTY)
        self._ranks = np.full(1 << bits, NO_PAIR, np.int32)
        self._merged = np.full(1 << bits, -1, np.int32)
        keys = self._key(left, right)
        slots, waiting = self._slot(keys), np.arange(len(keys))
        while len(waiting):
            at, first = np.unique(slots[waiting], return_index=True)
            free = self._keys[at] == _EMPTY
            placed = waiting[first[free]]
            self._keys[slots[placed]] = keys[placed]
            self._ranks[slots[placed]] = rank[placed]
            self._merged[slots[placed]] = merged[placed]
            waiting = np.setdiff1d(waiting, placed, assume_unique=True)
            slots[waiting] = (slots[waiting] + 1) & self._mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint32).astype(np.uint64) << np.uint64(32) | right.astype(np.uint32).astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _FACTOR) >> self._shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and merged symbols of the pairs, in the arrays' shape."""
        keys = self._key(left, right)
        slots = self._slot(keys)
        there = self._keys[slots]
        open_ = np.flatnonzero((there != keys) & (there != _EMPTY))
        flat, wanted = slots.reshape(-1), keys.reshape(-1)
        while len(open_):
            flat[open_] = (flat[open_] + 1) & self._mask
            there = self._keys[flat[open_]]
            open_ = open_[(there != wanted[open_]) & (there != _EMPTY)]
        found = self._keys[slots] == keys
        return np.where(found, self._ranks[slots], NO_PAIR), np.where(found, self._merged[slots], -1)
