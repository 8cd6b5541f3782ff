"""Token counts by rank-synchronous merging of ragged arrays (operator 4).

The distinct pre-tokens of a block of texts lie one behind the other in a flat array of
symbols. Each round finds every sequence's lowest-ranked pair, applies all its
occurrences in that sequence at once, and drops the symbols that were merged away; a
sequence without a pair is finished. Applying all occurrences of one pair together equals
applying them one by one, since a merge only makes symbols whose own merges rank later.

There is no shuffle: each row is counted where it is read.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame

from obslayers.llm.batches import map_texts
from obslayers.llm.pairs import NO_PAIR, PairTable
from obslayers.llm.pieces import PieceMemory, Splitter

FIELDS = "n_bytes bigint, n_tokens bigint, over_limit boolean"


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


def surviving(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> np.ndarray:
    """How many symbols of each sequence are left once no pair can be merged.

    ``symbols`` holds the sequences one behind the other, ``lengths`` their lengths.
    """
    counts = lengths.astype(np.int64).copy()
    rows = np.repeat(np.arange(len(lengths)), lengths)
    symbols = symbols.astype(np.int32)
    while len(symbols) > 1:
        ranks, merged = table.find(symbols[:-1], symbols[1:])
        ranks[rows[1:] != rows[:-1]] = NO_PAIR
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        best = np.minimum.reduceat(np.r_[ranks, NO_PAIR], starts)
        at = np.repeat(best, np.diff(np.r_[starts, len(rows)]))
        hits = np.flatnonzero((ranks == at[:-1]) & (ranks != NO_PAIR))
        if not len(hits):
            break
        hits = _apart(hits)
        symbols[hits] = merged[hits]
        counts -= np.bincount(rows[hits], minlength=len(counts))
        keep = at != NO_PAIR  # a finished sequence leaves the arrays
        keep[hits + 1] = False
        symbols, rows = symbols[keep], rows[keep]
    return counts


def _apart(hits: np.ndarray) -> np.ndarray:
    """Of each run of overlapping places every second one, from the left."""
    new_run = np.r_[True, np.diff(hits) != 1]
    if new_run.all():
        return hits
    place = np.arange(len(hits))
    return hits[(place - np.maximum.accumulate(np.where(new_run, place, 0))) % 2 == 0]


class WordCounter:
    """Counts tokens as the tokenizer file says: lower-cased words with an end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        kinds = [step["type"] for step in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: a word-level BPE with NFC and lower case is expected")
        self._special = [t["content"] for t in spec["added_tokens"]]
        self._at_special = regex.compile("|".join(map(regex.escape, self._special)) or "(?!)")
        words = Splitter(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        vocabulary = dict(model["vocab"])
        letters = byte_characters()
        self._inner = np.array([vocabulary[c] for c in letters], np.int32)
        self._last = np.array([vocabulary[c + suffix] for c in letters], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, both = (
            np.array([vocabulary[x] for x in column], np.int32)
            for column in ([a for a, _ in merges], [b for _, b in merges], [a + b for a, b in merges])
        )
        self._table = PairTable(left, right, np.arange(len(merges), dtype=np.int32), both)
        self._memory = PieceMemory(words, self._encode)

    def _encode(self, words: list[str]) -> list[int]:
        if not words:
            return []
        raw = [word.encode("utf-8") for word in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self._inner[data]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self._last[data[ends]]
        return surviving(symbols, lengths, self._table).tolist()

    def _normal(self, text: str) -> str:
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        # One character at a time, as the library does it: no special form at a word's end.
        return text.replace("Σ", "σ").lower()

    def counts(self, texts: list[str]) -> Iterator[int]:
        """Tokens of each whole text; a special token's string in a text is one token."""
        marks = [0] * len(texts)
        normal = []
        for i, text in enumerate(texts):
            if any(s in text for s in self._special):
                parts = self._at_special.split(text)
                marks[i] = len(parts) - 1
                normal.append("\n".join(map(self._normal, parts)))
            else:
                normal.append(self._normal(text))
        for mark, values in zip(marks, self._memory.values(normal)):
            yield mark + sum(values)


@functools.cache
def counter(path: str) -> WordCounter:
    return WordCounter(path)


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = 2048, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    A null text counts as empty: no bytes, no tokens. Repeated rows and null ids are
    kept; other columns are left out, whatever their names. ``tokenizer`` is the path of
    the tokenizer's file, which every executor must have.
    """

    def make():
        own = counter(tokenizer)

        def work(texts):
            for text, n in zip(texts, own.counts(texts)):
                yield [(len(text.encode("utf-8")), n, n > limit)]

        return work

    return map_texts(docs, [id_column], text_column, FIELDS, make)
