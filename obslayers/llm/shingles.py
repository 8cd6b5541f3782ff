"""Word shingles of whole blocks of texts as numpy arrays."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np

WORDS = 5
# Shingles are hashed to so many bits, the rest of 64 holds the text's place in its block.
HASH_BITS = 48
MOST_TEXTS = 1 << (64 - HASH_BITS)
# Places for which powers are kept at least: those of a usual block.
USUAL_BITS = 21
_BASE = 0x9E3779B97F4A7C15 | 1
_LOW = np.uint64((1 << HASH_BITS) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _byte_values() -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    values[list(b" \t\n\x0b\x0c\r")] = 0
    return values


@functools.cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse, for 2**bits places."""
    n = 1 << bits
    base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    ahead, back = (np.cumprod(np.r_[np.uint64(1), np.full(n - 1, x, np.uint64)]) for x in (base, inverse))
    return ahead, back


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word and the place of its text, in order.

    Words are runs between ASCII white space. A word's hash is a polynomial in its bytes;
    sums of all the bytes before a place give the polynomials of all words at once.
    """
    raw = [text.encode("utf-8") for text in texts]
    data = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
    values = _byte_values()[data]
    inside = values != 0
    begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    ahead, back = _powers(max(USUAL_BITS, int(len(data)).bit_length()))
    sums = np.cumsum(values * ahead[: len(data)], dtype=np.uint64)
    hashes = (sums[ends - 1] - sums[begins - 1]) * back[begins]
    stops = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    return mixed(hashes), np.searchsorted(stops, begins, side="left")


@dataclass(frozen=True)
class Shingles:
    """Distinct shingles of a block of texts, sorted by text and hash.

    ``text`` is the place of the text in the block, ``hash`` the shingle's hash of
    ``HASH_BITS`` bits, ``count`` how often the text has it.
    """

    text: np.ndarray
    hash: np.ndarray
    count: np.ndarray


def shingles(texts: list[str]) -> Shingles:
    """Shingles of ``WORDS`` words; a shorter text with a word is one shingle of its own."""
    if len(texts) > MOST_TEXTS:
        raise ValueError(f"at most {MOST_TEXTS} texts at a time")
    words, owner = word_hashes(texts)
    n = len(words)
    padded = np.r_[words, np.zeros(WORDS, np.uint64)]
    owners = np.r_[owner, np.full(WORDS, -1)]
    combined = np.zeros(n, np.uint64)
    for k in range(WORDS):
        part = np.where(owners[k : k + n] == owner, padded[k : k + n], np.uint64(0))
        combined = combined * np.uint64(_BASE) + part
    full = owners[WORDS - 1 : WORDS - 1 + n] == owner
    first = np.r_[True, owner[1:] != owner[:-1]] if n else np.zeros(0, bool)
    taken = full | first  # a first word without enough behind it stands for a short text
    keys = owner[taken].astype(np.uint64) << np.uint64(HASH_BITS) | mixed(combined[taken]) & _LOW
    keys.sort()
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[new, len(keys)])
    keys = keys[new]
    return Shingles((keys >> np.uint64(HASH_BITS)).astype(np.int64), keys & _LOW, counts)
