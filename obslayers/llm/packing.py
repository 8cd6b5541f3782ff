"""Best-fit packing by minimum bin slack (operator 2).

Only the number of pieces of each length matters to the packing, and there are at most
``capacity`` lengths. The plan is therefore made over that histogram: the longest
length left opens a bin, a subset-sum dynamic program over the other lengths left, kept as
a bitset, finds the fullest combination for the rest of the bin, and the combination is
removed as often as the counts allow. A combination uses up at least one length, so the
plan has some thousand combinations at most, for any number of documents.

The pieces find their places without meeting: each is numbered among those of its length
(shards of a length are numbered apart and then offset), and the plan says which bin and
offset each number of a length has.
"""

from __future__ import annotations

import functools
import json
import zlib
from dataclasses import dataclass

import numpy as np
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslayers.llm.batches import map_texts
from obslayers.llm.token_counts import byte_characters
from obslayers.storage import materialize

FIELDS = "piece int, start bigint, length bigint, ids_crc32 bigint"
# Pieces of one length that are numbered in one group, on average over all lengths.
SHARD_PIECES = 8192
# Rows of a plan up to which every executor gets a copy (some 50 bytes a row).
BROADCAST_ROWS = 200_000
# Fixed value: the split of byte-level vocabularies. Possessive where that changes nothing.
BYTE_LEVEL_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


class VocabularyIds:
    """Ids of whole texts by a tokenizers file with a byte-level BPE, as that library gives them.

    Such a file with its tokens numbered in the order of its merges is what the tiktoken
    engine calls ranks, and that engine is six times as fast. A special token's string
    in a text is that token, as the library has it by default.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
        numbers = [vocabulary[token] for token in merges]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = {c: b for b, c in enumerate(byte_characters())}
        if spec["normalizer"] or numbers != sorted(numbers) or max(vocabulary[c] for c in byte) > numbers[0]:
            raise ValueError(f"{path}: not a plain byte-level BPE numbered by its merges")
        ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        self._engine = tiktoken.Encoding(
            path, pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=special
        )

    def ids(self, text: str) -> np.ndarray:
        return self._engine.encode_to_numpy(text, allowed_special="all")


@functools.cache
def vocabulary_ids(path: str) -> VocabularyIds:
    return VocabularyIds(path)


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """Begin and end of the pieces of a document: full ones, behind one shorter at most."""
    first = length % capacity or min(length, capacity)
    bounds = [0, *range(first, length + 1, capacity)]
    return list(zip(bounds, bounds[1:]))


def document_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: a document is its ids and then ``end_id``.

    A null text counts as empty and is the one token ``end_id``. Documents of more than
    ``capacity`` tokens are cut; all pieces but the first are full. Columns: the id,
    ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.
    """
    end = np.array([end_id], "<u4").tobytes()

    def make():
        own = vocabulary_ids(tokenizer)

        def work(texts):
            for text in texts:
                data = own.ids(text).astype("<u4").tobytes() + end
                rows = []
                for k, (a, b) in enumerate(cuts(len(data) // 4, capacity)):
                    ids = data[4 * a : 4 * b]
                    row = (k, a, b - a, zlib.crc32(ids))
                    rows.append((*row, np.frombuffer(ids, "<u4").astype(np.int32)) if with_ids else row)
                yield rows

        return work

    fields = FIELDS + (", ids array<int>" if with_ids else "")
    return map_texts(docs, [id_column], text_column, fields, make)


@dataclass(frozen=True)
class Combination:
    """Lengths with how often each is in the bin, and the number of such bins."""

    uses: tuple[tuple[int, int], ...]
    bins: int


def fullest(room: int, available: list[tuple[int, int]]) -> dict[int, int]:
    """The lengths whose sum comes nearest to ``room`` from below, as uses by length.

    ``available`` has lengths and counts. Bit s of the state is set if some lengths taken
    so far sum to s. Of equal sums the one with the longer lengths, which are harder to
    place later, is taken.
    """
    mask, reach = (1 << (room + 1)) - 1, 1
    states: list[tuple[int, int, int]] = []
    for length, count in sorted(available, reverse=True):
        if length > room:
            continue
        states.append((length, min(count, room // length), reach))
        left, step = states[-1][1], 1
        while left:  # any number up to the count, by sums of growing blocks
            step = min(step, left)
            reach |= reach << (step * length) & mask
            left, step = left - step, step * 2
        if reach >> room & 1:
            break
    total, uses = reach.bit_length() - 1, {}
    for length, count, before in reversed(states):
        n = next(k for k in range(count + 1) if total >= k * length and before >> (total - k * length) & 1)
        if n:
            uses[length] = n
            total -= n * length
    return uses


def plan(counts: dict[int, int], capacity: int) -> list[Combination]:
    """Combinations that use up ``counts``, the number of pieces by length."""
    left = {length: n for length, n in counts.items() if n}
    found = []
    while left:
        longest = max(left)
        left[longest] -= 1
        uses = fullest(capacity - longest, [x for x in left.items() if x[1]])
        left[longest] += 1
        uses[longest] = uses.get(longest, 0) + 1
        bins = min(left[length] // n for length, n in uses.items())
        found.append(Combination(tuple(sorted(uses.items(), reverse=True)), bins))
        for length, n in uses.items():
            left[length] -= n * bins
            if not left[length]:
                del left[length]
    return found


def places(combinations: list[Combination]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first number, number after the last, first bin, uses, offset)."""
    rows, numbered, bin_ = [], {}, 0
    for c in combinations:
        offset = 0
        for length, n in c.uses:
            first = numbered.get(length, 0)
            numbered[length] = first + n * c.bins
            rows.append((length, first, numbered[length], bin_, n, offset))
            offset += n * length
        bin_ += c.bins
    return rows


def _numbered(pieces: DataFrame, shards: int, order: list[Column]) -> DataFrame:
    """``pieces`` with a ``number`` from 0 among those of their length."""
    sharded = pieces.withColumn("shard", F.pmod(F.xxhash64(*order), F.lit(shards)))
    sizes = sharded.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"))
    within = F.row_number().over(Window.partitionBy("length", "shard").orderBy(*order)) - 1
    numbered = sharded.withColumn("within", within).join(starts, ["length", "shard"])
    return numbered.withColumn("number", F.col("begin") + F.col("within")).drop("shard", "within", "begin")


def pack(pieces: DataFrame, capacity: int = 1024, id_column: str = "doc_id") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: every piece whole, in some sequence.

    ``pieces`` is a written table with the columns of ``document_pieces``; it is read
    three times. Equal rows are pieces of their own.
    """
    spark = pieces.sparkSession
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = places(plan(counts, capacity))
    fields = "length bigint, first bigint, last bigint, bin bigint, uses bigint, at bigint"
    wanted = spark.createDataFrame(rows, fields)
    if len(rows) <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    shards = 1 + sum(counts.values()) // SHARD_PIECES
    numbered = _numbered(pieces, shards, [F.col(id_column), F.col("piece")])
    inside = (F.col("number") >= F.col("first")) & (F.col("number") < F.col("last"))
    found = numbered.join(wanted, "length").where(inside)
    place = F.col("number") - F.col("first")
    return found.select(
        *pieces.columns,
        (F.col("bin") + F.floor(place / F.col("uses"))).cast("bigint").alias("sequence_id"),
        (F.col("at") + place % F.col("uses") * F.col("length")).cast("bigint").alias("offset"),
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """All documents in as few sequences of at most ``capacity`` tokens as the plan finds.

    One row per piece, with its sequence and its place there. Tokenizing happens once:
    the pieces are written to the shared folder and read from there.
    """
    pieces = document_pieces(docs, tokenizer, capacity, end_id, id_column, text_column, with_ids)
    return pack(materialize(pieces, "pieces"), capacity, id_column)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from pieces packed ``with_ids``.

    A sequence has at most ``capacity`` pieces, so no group is large.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.flatten(F.transform(parts, lambda p: p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
