"""Byte-level BPE encoding and decoding in padded matrices (operator 6).

The distinct new pre-tokens of a block of texts are put into numpy matrices by length,
one row each, padded to a power of two. In every round each row merges its leftmost pair
of minimum rank: two hashed look-ups per row bring the ranks beside the merge up to date,
the row moves left by one place, and rows without a pair leave the matrix.

There is no shuffle: each row is encoded where it is read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from obslayers.llm.batches import map_texts
from obslayers.llm.pairs import NO_PAIR, PairTable
from obslayers.llm.pieces import PieceMemory, Splitter

FIELDS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
# Pre-tokens of more bytes are merged alone, in the same order, by a heap: a matrix row
# costs its width in every round.
WIDEST = 256
# Cells of a matrix.
MOST_CELLS = 1 << 20


class ByteBpe:
    """The ranks of a ``.tiktoken`` file: a token's rank is its id."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            lines = [line.split() for line in file.read().splitlines() if line.strip()]
        self._ids = {base64.b64decode(token): int(rank) for token, rank in lines}
        self._tokens = {rank: token for token, rank in self._ids.items()}
        self._byte = np.array([self._ids[bytes([b])] for b in range(256)], np.int32)
        ids, left, right, merged = self._ids, [], [], []
        for token, rank in ids.items():
            for cut in range(1, len(token)):
                a, b = ids.get(token[:cut]), ids.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        columns = [np.array(x, np.int32) for x in (left, right, merged, merged)]
        self._table = PairTable(*columns)
        self._memory = PieceMemory(Splitter(pattern), self._encode)

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of each pre-token as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        wide: dict[int, list[int]] = {}
        raw = [piece.encode("utf-8") for piece in pieces]
        for i, data in enumerate(raw):
            whole = self._ids.get(data)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(data) > WIDEST:
                out[i] = self._alone(data)
            else:
                wide.setdefault(1 << (len(data) - 1).bit_length(), []).append(i)
        for width, members in wide.items():
            for begin in range(0, len(members), MOST_CELLS // width):
                part = members[begin : begin + MOST_CELLS // width]
                for i, ids in zip(part, self._merge([raw[i] for i in part], width)):
                    out[i] = ids
        return out

    def _merge(self, raw: list[bytes], width: int) -> list[bytes]:
        out: list[bytes] = [b""] * len(raw)
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        cells = np.full((len(raw), width + 1), -1, np.int32)
        cells[np.arange(width + 1) < lengths[:, None]] = self._byte[np.frombuffer(b"".join(raw), np.uint8)]
        ranks, merged = self._table.find(cells[:, :-1], cells[:, 1:])
        rows, columns = np.arange(len(raw)), np.arange(width)
        while len(rows):
            at = ranks.argmin(1)
            line = np.arange(len(rows))
            done = ranks[line, at] == NO_PAIR
            for k in np.flatnonzero(done):
                out[rows[k]] = cells[k, : lengths[k]].astype("<u4").tobytes()
            if done.any():
                keep = ~done
                rows, cells, ranks, merged, lengths, at = (
                    x[keep] for x in (rows, cells, ranks, merged, lengths, at)
                )
                if not len(rows):
                    break
                line = np.arange(len(rows))
            cells[line, at] = merged[line, at]
            # The place behind the merge goes: its symbol, and the pair that began there.
            shift = columns + (columns > at[:, None])
            cells[:, :-1] = np.take_along_axis(cells, shift, 1)
            np.minimum(shift, width - 1, out=shift)
            ranks, merged = np.take_along_axis(ranks, shift, 1), np.take_along_axis(merged, shift, 1)
            cells[:, -1], ranks[:, -1] = -1, NO_PAIR
            lengths = lengths - 1
            ranks[line, at], merged[line, at] = self._table.find(cells[line, at], cells[line, at + 1])
            inner = at > 0
            where, before = line[inner], at[inner] - 1
            ranks[where, before], merged[where, before] = self._table.find(
                cells[where, before], cells[where, before + 1]
            )
        return out

    def _alone(self, data: bytes) -> bytes:
        """One long pre-token: the leftmost pair of minimum rank, from a heap of places."""
        symbols = self._byte[np.frombuffer(data, np.uint8)]
        ranks, merged = self._table.find(symbols[:-1], symbols[1:])
        ids, n = symbols.tolist(), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, m, ids[i], ids[i + 1]) for i, (r, m) in enumerate(zip(ranks.tolist(), merged.tolist())) if r != NO_PAIR]
        heapq.heapify(heap)
        while heap:
            _, i, m, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = m, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n:
                    token = self._tokens[ids[left]] + self._tokens[ids[right]]
                    if (rank := self._ids.get(token)) is not None:
                        heapq.heappush(heap, (rank, left, rank, ids[left], ids[right]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each whole text as little-endian 32-bit integers, without special tokens."""
        return map(b"".join, self._memory.values(texts))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.cache
def encoder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_documents(
    docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its id, ``ids`` (array of int) and ``decoded`` (string).

    A null text counts as empty: no ids. Repeated rows and null ids are kept.
    """

    def make():
        own = encoder(ranks, pattern)

        def work(texts):
            for ids in own.encode(texts):
                yield [(np.frombuffer(ids, "<u4").astype(np.int32), own.decode(ids).decode("utf-8"))]

        return work

    return map_texts(docs, [id_column], text_column, "ids array<int>, decoded string", make)


def encoding_digests(
    docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """As ``encode_documents``, with the number of ids and digests in place of ids and text."""

    def make():
        own = encoder(ranks, pattern)

        def work(texts):
            for ids in own.encode(texts):
                decoded = hashlib.sha256(own.decode(ids)).hexdigest()
                yield [(len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded)]

        return work

    return map_texts(docs, [id_column], text_column, FIELDS, make)
