"""Near duplicates by consistent weighted sampling of weighted shingles (operator 8).

1. *Weights.* A shingle's weight in a text grows with the logarithms of its count there
   and, mildly, of its rarity. Document frequencies of all documents go into a sketch of
   fixed size, hashed counters; its 2**22 one-byte weights are all that is broadcast.
2. *Samples.* Improved consistent weighted sampling draws 48 samples of each text: two
   texts draw the same one with the probability of their weighted Jaccard similarity.
3. *Bands.* Four samples are a band, and its value is the key of a bucket.
4. *Candidates.* Of equal texts one stands for all. All members of a bucket meet each
   other: large buckets are dealt into blocks of so many members and characters as a task can
   hold, and every two blocks are a tile. A pair that draws too few equal samples is put
   aside, each other one is a candidate of the first bucket that it shares.
5. *Verification.* Texts go to the tiles in which they are candidates, where a pair is a link
   if its exact weighted Jaccard similarity, from the whole texts, reaches the threshold.
   Classes are the connected components of links.

Pairs are never written: a tile draws its candidates a stretch at a time, verifies them and gives of
its links only their number for each text and a tree that joins the same texts. Rows grow in
proportion to a bucket up to a block, and beyond that by a copy of each member for every further block.
"""

from __future__ import annotations

import functools
import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslayers.llm.batches import blocks, map_texts
from obslayers.llm.quality_classifier import free_name
from obslayers.llm.shingles import HASH_BITS, MOST_TEXTS, Shingles, mixed, shingles
from obslayers.storage import Scratch, materialize

THRESHOLD = 0.8
# The sketch of document frequencies: counters, and the parts it travels in.
SKETCH_BITS, PART_BITS = 22, 14
# Weight of the rarest shingle against one that every document has. With more than this,
# the few words by which near copies differ would outweigh all that a large group of them
# shares, and the group would fall apart.
RARITY = 0.15
# Bands, and samples in each: texts of similarity 0.8 meet with probability 0.998.
BANDS, BAND_ROWS = 12, 4
# Members of a bucket that are a block, and characters of their texts: what a task holds of them is some 200
# bytes a member and 24 a word. Every two blocks meet in a tile.
BLOCK_MEMBERS, BLOCK_CHARS = 1 << 12, 1 << 24
# Two texts of the threshold's similarity that share a band draw fewer equal samples than are
# asked of a candidate with this probability at most.
UNDRAWN = 1e-6
# Characters and texts of small tiles that are verified together.
VERIFIED_CHARS, VERIFIED_TEXTS = 1 << 22, 1 << 12
# Pairs that are drawn at a time, and shingles that are compared at a time.
DRAWN_PAIRS, COMPARED_SHINGLES = 1 << 17, 1 << 17
# Partners from which on a text's weights are laid out by shingle, instead of looked up pair by pair.
LAID_OUT = 16
# Digests (some 40 bytes each) up to which every executor gets a copy to pick the texts by; more
# are dealt out with the texts.
BROADCAST_NODES = 1_000_000
# Shingles whose samples are drawn at a time.
SAMPLED_AT_ONCE = 1 << 16


# -- document frequencies ----------------------------------------------------------


def _sketch_parts(docs: DataFrame, text_column: str) -> DataFrame:
    """Per task and part of the sketch its counters, packed; part -1 counts documents."""
    given = docs.select(F.coalesce(docs[text_column], F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << SKETCH_BITS, np.uint32)
        documents = 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, end in _text_blocks(texts):
                found = shingles(texts[begin:end])
                np.add.at(counters, _counter(found.hash), 1)
                documents += len(np.unique(found.text))
        parts = counters.reshape(-1, 1 << PART_BITS)
        numbers = [i for i in range(len(parts)) if parts[i].any()]
        packed = [zlib.compress(parts[i].tobytes(), 1) for i in numbers]
        rows = [[-1, *numbers], [zlib.compress(np.array([documents], np.uint32).tobytes()), *packed]]
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary())], ["part", "packed"])

    return given.mapInArrow(run, "part int, packed binary")


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(HASH_BITS - SKETCH_BITS)).astype(np.int64)


def _text_blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    for begin, end in blocks(texts, 1 << 20):
        for at in range(begin, end, MOST_TEXTS):
            yield at, min(at + MOST_TEXTS, end)


def shingle_weights(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """One byte of weight for every counter of the sketch, over all ``docs``.

    The tasks' parts are added up where they meet, part by part, so no task holds more
    than the sketch. Its size does not depend on the documents; sharing a counter can
    only make a shingle look more frequent.
    """
    parts = _sketch_parts(docs, text_column)
    spread = parts.repartition(64, "part")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("packed").to_pylist()):
                own = np.frombuffer(zlib.decompress(packed), np.uint32).astype(np.int64)
                sums[part] = sums[part] + own if part in sums else own
        if sums:
            values = [zlib.compress(x.tobytes(), 1) for x in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(values, pa.binary())], ["part", "packed"])

    counts = np.zeros((1 << (SKETCH_BITS - PART_BITS), 1 << PART_BITS), np.int64)
    documents = 0
    for row in spread.mapInArrow(add, "part int, packed binary").collect():
        values = np.frombuffer(zlib.decompress(row.packed), np.int64)
        if row.part < 0:
            documents = int(values[0])
        else:
            counts[row.part] = values
    frequency = np.minimum(counts.reshape(-1), documents)
    rarity = np.log((1 + documents) / (1 + frequency)) / np.log(2 + documents)
    return np.round(255 * np.clip(rarity, 0, 1)).astype(np.uint8)


def weighted(found: Shingles, weights: np.ndarray) -> np.ndarray:
    """The weight of each shingle: (1 + ln count) (1 + RARITY times its rarity)."""
    rarity = weights[_counter(found.hash)].astype(np.float64) / 255
    return (1 + np.log(found.count)) * (1 + RARITY * rarity)


# -- samples -----------------------------------------------------------------------


@functools.cache
def _factors(samples: int) -> np.ndarray:
    """Odd 32-bit factors, six for each sample."""
    seeds = mixed(np.arange(1, 6 * samples + 1, dtype=np.uint64))
    return (seeds >> np.uint64(32)).astype(np.uint32).reshape(samples, 6) | np.uint32(1)


def _bits(low: np.ndarray, high: np.ndarray, a: np.uint32, b: np.uint32, c: np.uint32) -> np.ndarray:
    x = low * a + high * b + c
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def consistent_samples(found: Shingles, weights: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have a shingle, and the ``samples`` of each as a matrix of 32-bit values.

    For each shingle and sample three variates follow from the shingle's hash: r and c
    from the gamma distribution of shape 2, b uniform. With t = floor(ln w / r + b) and
    ln a = ln c - r (t - b + 1), the shingle of least a is drawn, and is known by itself and t.
    """
    owners, starts = np.unique(found.text, return_index=True)
    out = np.empty((len(owners), samples), np.uint32)
    spread = mixed(found.hash)
    low, high = spread.astype(np.uint32), (spread >> np.uint64(32)).astype(np.uint32)
    log_w = np.log(weights).astype(np.float32)
    # Whole texts at a time, of about so many shingles that the arrays stay in the cache.
    cuts = np.searchsorted(starts, np.arange(0, len(low), SAMPLED_AT_ONCE))
    cuts = np.unique(np.r_[0, cuts, len(starts)])
    ends = np.r_[starts, len(low)]
    for p, q in zip(cuts, cuts[1:]):
        a, b = ends[p], ends[q]
        lo, hi, lw, at = low[a:b], high[a:b], log_w[a:b], starts[p:q] - a
        for k, f in enumerate(_factors(samples)):
            x, y = _bits(lo, hi, f[0], f[1], f[2]), _bits(lo, hi, f[3], f[4], f[5])
            r = -np.log(_uniform(x, 0) * _uniform(x, 16))
            c = -np.log(_uniform(y, 0) * _uniform(y, 16))
            shift = _uniform(x ^ (y >> np.uint32(5)), 8)
            t = np.floor(lw / r + shift)
            value = np.log(c) - r * (t - shift + np.float32(1))
            order = value.view(np.uint32)
            order = np.where(order >> np.uint32(31), ~order, order | np.uint32(1 << 31))
            known = _bits(x, t.astype(np.int32).view(np.uint32), f[1], f[3], f[5])
            both = order.astype(np.uint64) << np.uint64(32) | known
            out[p:q, k] = np.minimum.reduceat(both, at).astype(np.uint32)
    return owners, out


def _uniform(x: np.ndarray, shift: int) -> np.ndarray:
    """Sixteen of the bits as a number between 0 and 1, both excluded."""
    return ((x >> np.uint32(shift) & np.uint32(0xFFFF)).astype(np.float32) + np.float32(0.5)) / np.float32(65536)


def bucket_keys(samples: np.ndarray) -> np.ndarray:
    """A key of 64 bits for each band of each text."""
    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(samples), 1))
    for k in range(BAND_ROWS):
        keys = mixed(keys + samples[:, k::BAND_ROWS].astype(np.uint64) + np.uint64(BANDS))
    return keys.view(np.int64)


def signed(docs: DataFrame, weights, id_column: str, text_column: str) -> DataFrame:
    """Per row its id, the digest and length of its text, its bucket keys and samples; none for wordless texts."""

    def make():
        def work(texts):
            for begin, end in _text_blocks(texts):
                part = texts[begin:end]
                found = shingles(part)
                owners, samples = consistent_samples(found, weighted(found, weights.value), BANDS * BAND_ROWS)
                drawn = dict(zip(owners.tolist(), zip(bucket_keys(samples), map(np.ndarray.tobytes, samples))))
                for i, text in enumerate(part):
                    yield [(_digest(text), len(text), *drawn[i]) if i in drawn else (None, None, None, None)]

        return work

    return map_texts(docs, [id_column], text_column, "node bigint, chars int, keys array<bigint>, samples binary", make)


def _digest(text: str) -> int:
    """The same as Spark's xxhash64. Of ten billion texts some three pairs share one by chance."""
    n = xxhash.xxh64_intdigest(text.encode("utf-8"), 42)
    return n - (1 << 64) if n >= 1 << 63 else n


# -- verification ------------------------------------------------------------------


def similarities(left: list[str], right: list[str], weights: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of each text on the left with that on the right."""
    a, b = shingles(left), shingles(right)
    wa, wb = weighted(a, weights), weighted(b, weights)
    shift = np.uint64(HASH_BITS)
    ka, kb = (s.text.astype(np.uint64) << shift | s.hash for s in (a, b))
    at = np.searchsorted(ka, kb)
    at[at == len(ka)] = 0
    common = ka[at] == kb if len(ka) else np.zeros(len(kb), bool)
    least = np.bincount(b.text[common], np.minimum(wa[at[common]], wb[common]), len(left))
    total = np.bincount(a.text, wa, len(left)) + np.bincount(b.text, wb, len(left))
    return least / np.maximum(total - least, 1e-300)


class Held:
    """The shingles of texts, one text behind the other: ``hash`` and ``weight`` from ``starts`` of each."""

    def __init__(self, weights: np.ndarray):
        self._weights = weights
        self._waiting: list[str] = []
        self._chars = 0
        self._parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, text: str) -> None:
        self._waiting.append(text)
        self._chars += len(text)
        if self._chars >= 1 << 20 or len(self._waiting) == MOST_TEXTS:
            self._take()

    def _take(self) -> None:
        found = shingles(self._waiting)
        self._parts.append((np.bincount(found.text, minlength=len(self._waiting)), found.hash, weighted(found, self._weights)))
        self._waiting, self._chars = [], 0

    def close(self) -> None:
        """All texts are there."""
        self._take()
        self.lengths, self.hash, self.weight = (np.concatenate(x) for x in zip(*self._parts))
        self._parts = []
        self.starts = np.r_[0, np.cumsum(self.lengths)]
        self.total = np.bincount(self._owner(0, len(self.lengths)), self.weight, len(self.lengths))
        self._names: np.ndarray | None = None

    def _owner(self, begin: int, end: int) -> np.ndarray:
        return np.repeat(np.arange(end - begin), self.lengths[begin:end])

    def similarities(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarity of each text of ``left``, ascending, with that of ``right``, ascending within it."""
        least = np.empty(len(left))
        begins = np.flatnonzero(np.r_[True, left[1:] != left[:-1]]) if len(left) else np.zeros(0, np.int64)
        ends = np.r_[begins[1:], len(left)]
        many = ends - begins >= LAID_OUT
        alone = np.repeat(~many, ends - begins)
        least[alone] = self._looked_up(left[alone], right[alone])
        if many.any():
            if self._names is None:
                known, self._names = np.unique(self.hash, return_inverse=True)
                self._laid = np.zeros(len(known))
            for p, q in zip(begins[many], ends[many]):
                least[p:q] = self._laid_out(left[p], right[p:q])
        return least / np.maximum(self.total[left] + self.total[right] - least, 1e-300)

    def _laid_out(self, one: int, others: np.ndarray) -> np.ndarray:
        """The common weight of ``one`` with each of ``others``, read in stretches of the texts."""
        own = slice(self.starts[one], self.starts[one + 1])
        self._laid[self._names[own]] = self.weight[own]
        out = np.empty(len(others))
        p = 0
        while p < len(others):
            first = others[p]
            last = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + COMPARED_SHINGLES, "right")) - 1)
            q = int(np.searchsorted(others, last))
            if 4 * (q - p) >= last - first:
                begin, end = first, others[q - 1] + 1
                at = slice(self.starts[begin], self.starts[end])
                owner, place = self._owner(begin, end), others[p:q] - begin
                n = end - begin
            else:
                owner, at = self._places(others[p:q])
                place, n = slice(None), q - p
            out[p:q] = np.bincount(owner, np.minimum(self._laid[self._names[at]], self.weight[at]), n)[place]
            p = q
        self._laid[self._names[own]] = 0
        return out

    def _places(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For all shingles of the texts ``which`` the place in ``which`` and their own."""
        lengths = self.lengths[which]
        owner = np.repeat(np.arange(len(which)), lengths)
        return owner, np.arange(len(owner)) + (self.starts[which] - np.cumsum(lengths) + lengths)[owner]

    def _looked_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The common weight of each pair."""
        sizes = np.cumsum(self.lengths[left] + self.lengths[right])
        out = np.empty(len(left))
        shift = np.uint64(HASH_BITS)
        p = 0
        while p < len(left):
            done = sizes[p - 1] if p else 0
            q = min(max(p + 1, int(np.searchsorted(sizes, done + (1 << 20)))), p + MOST_TEXTS, len(left))
            (pa_, ia), (pb, ib) = self._places(left[p:q]), self._places(right[p:q])
            ka, kb = (pair.astype(np.uint64) << shift | self.hash[i] for pair, i in ((pa_, ia), (pb, ib)))
            at = np.searchsorted(ka, kb)
            at[at == len(ka)] = 0
            common = ka[at] == kb if len(ka) else np.zeros(len(kb), bool)
            out[p:q] = np.bincount(pb[common], np.minimum(self.weight[ia[at[common]]], self.weight[ib[common]]), q - p)
            p = q
        return out


def pair_similarities(texts: list[str], left: np.ndarray, right: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """As ``similarities`` of pairs among ``texts``, by their places in ascending order; each text is read once."""
    held = Held(weights)
    for text in texts:
        held.add(text)
    held.close()
    return held.similarities(left, right)


@functools.cache
def least_equal(threshold: float) -> int:
    """Most equal samples that can be asked of two texts which share a band; see ``UNDRAWN``."""
    n = (BANDS - 1) * BAND_ROWS
    missed, k = 0.0, 0
    while k < n and (missed := missed + math.comb(n, k) * threshold**k * (1 - threshold) ** (n - k)) <= UNDRAWN:
        k += 1
    return BAND_ROWS + k


TILE = ["bucket", "low", "high"]


def drawn_pairs(samples: np.ndarray, block: np.ndarray, low: int, high: int, band: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The candidates of a tile by the places of their texts, ascending, a stretch at a time.

    ``samples`` and ``block`` are those of its texts; ``band`` is that of its bucket.
    """
    by_sample = np.ascontiguousarray(samples.T)
    first, second = np.flatnonzero(block == low), np.flatnonzero(block == high)
    theirs = by_sample[:, second]
    step = max(1, DRAWN_PAIRS // max(1, len(second)))
    for p in range(0, len(first), step):
        rows = first[p : p + step]
        # Within a block a text meets those behind it.
        begin = p if low == high else 0
        mine, others = by_sample[:, rows, None], theirs[:, None, begin:]
        # It has been a candidate of an earlier band's bucket if it shares one.
        equal = mine == others
        shape = equal.shape[1:]
        open_ = ~equal[: band * BAND_ROWS].reshape(band, BAND_ROWS, *shape).all(1).any(0)
        open_ &= equal.view(np.uint8).sum(0, dtype=np.uint8) >= least
        if low == high:
            open_ &= rows[:, None] < second[None, begin:]
        i, j = np.nonzero(open_)
        if len(i):
            yield rows[i], second[begin + j]


def _tiles(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """The rows of each tile; those of one tile stand one behind the other, its names first in ``columns``."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns)))
    return itertools.groupby(rows, lambda r: r[: len(TILE)])


def _matrix(samples: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(samples), np.uint32).reshape(len(samples), BANDS * BAND_ROWS)


def candidates(members: DataFrame, threshold: float) -> DataFrame:
    """The rows of ``members`` whose text is in a candidate of its tile.

    ``members`` has ``bucket``, ``low`` and ``high`` (the tile's blocks), ``band``, ``block``, ``node`` and ``samples``.
    """
    least = least_equal(threshold)
    columns = [*TILE, "band", "block", "node", "samples"]
    own = members.select(*columns)
    # Tiles are whole in a task and stand one behind the other.
    sorted_ = own.repartition(*TILE).sortWithinPartitions(*TILE, "node")
    schema = pa.schema([(c, pa.int32() if c in ("low", "high", "band", "block") else pa.binary() if c == "samples" else pa.int64()) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (_, low, high), group in _tiles(batches, columns):
            rows = list(group)
            block = np.array([r[4] for r in rows], np.int64)
            wanted = np.zeros(len(rows), bool)
            for left, right in drawn_pairs(_matrix([r[6] for r in rows]), block, low, high, rows[0][3], least):
                wanted[left] = wanted[right] = True
            out.extend(rows[i] for i in np.flatnonzero(wanted))
            if len(out) >= VERIFIED_TEXTS:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    return sorted_.mapInArrow(run, "bucket bigint, low int, high int, band int, block int, node bigint, samples binary")


def joined(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``root``, the least place joined to each place, after the pairs have joined theirs as well."""
    while True:
        a, b = root[left], root[right]
        apart = a != b
        if not apart.any():
            return root
        left, right = left[apart], right[apart]
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root != root[root]).any():
            root = root[root]


def links(found: DataFrame, texts: DataFrame, weights, threshold: float) -> DataFrame:
    """What the links among the candidates of each tile say of each of its nodes.

    ``found`` is what ``candidates`` gives. ``n`` is the number of a node's links, and the edges from ``leader`` to
    ``node`` join the same nodes as the links do.
    """
    least = least_equal(threshold)
    columns = [*TILE, "band", "block", "node", "samples", "text"]
    sorted_ = found.join(texts, "node").select(*columns).repartition(*TILE).sortWithinPartitions(*TILE, "node")

    def linked(held: Held, tiles: list[tuple], nodes: list[int]) -> pa.RecordBatch:
        held.close()
        n, root = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        for begin, block, samples, low, high, band in tiles:
            for left, right in drawn_pairs(samples, block, low, high, band, least):
                left, right = left + begin, right + begin
                good = held.similarities(left, right) >= threshold
                left, right = left[good], right[good]
                n += np.bincount(left, minlength=len(nodes)) + np.bincount(right, minlength=len(nodes))
                root = joined(root, left, right)
        names, has = np.array(nodes, np.int64), n > 0
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (names[root[has]], names[has], n[has])], ["leader", "node", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tiles, nodes = Held(weights.value), [], []
        chars = 0
        for (_, low, high), group in _tiles(batches, columns):
            begin, block, samples = len(nodes), [], []
            for *_, band, of, node, drawn, text in group:
                held.add(text)
                chars += len(text)
                block.append(of)
                nodes.append(node)
                samples.append(drawn)
            tiles.append((begin, np.array(block, np.int64), _matrix(samples), low, high, band))
            if chars >= VERIFIED_CHARS or len(nodes) >= VERIFIED_TEXTS:
                yield linked(held, tiles, nodes)
                held, tiles, nodes = Held(weights.value), [], []
                chars = 0
        if nodes:
            yield linked(held, tiles, nodes)

    return sorted_.mapInArrow(run, "leader bigint, node bigint, n bigint")


# -- classes -----------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (leader, node): one root per component.

    Every node moves to the least node beside it or itself, and edges move with their
    ends, until none is left between different nodes. Nodes are digests, in no order along
    any path, so a path shrinks by a constant share in each step.
    """
    both = edges.select(F.col("leader").alias("a"), F.col("node").alias("b"))
    found = None
    while True:
        ways = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
        least = materialize(least, "roots")
        if found is None:
            found = least.select(F.col("a").alias("node"), "root")
        else:
            step = least.select(F.col("a").alias("root"), F.col("root").alias("next"))
            found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            found = materialize(found, "found")
        ends = both
        for end in ("a", "b"):
            step = least.select(F.col("a").alias(end), F.col("root").alias(f"root_{end}"))
            ends = ends.join(step, end)
        moved = ends.where("root_a <> root_b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        both = materialize(moved.distinct(), "edges")
        if both.isEmpty():
            return found


def _node(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def verified_links(rows: DataFrame, docs: DataFrame, weights, text_column: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``links`` of all candidates, and (node, root) of the nodes that have one.

    ``rows`` is the table of ``signed``.
    """
    one = rows.where("node IS NOT NULL").groupBy("node").agg(*[F.first(c).alias(c) for c in ("chars", "keys", "samples")])
    one = materialize(one, "one")
    exploded = one.select("node", "chars", F.posexplode("keys").alias("band", "bucket"))
    sizes = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.sum("chars").alias("chars")).where("size > 1")
    blocks_ = F.greatest(F.ceil(F.col("size") / BLOCK_MEMBERS), F.ceil(F.col("chars") / BLOCK_CHARS)).cast("int")
    members = exploded.drop("chars").join(sizes.select("bucket", blocks_.alias("blocks")), "bucket").join(one.select("node", "samples"), "node")
    members = members.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int"))
    others = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = others.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    found = materialize(candidates(tiles, threshold), "candidates")
    wanted = materialize(found.select("node").distinct(), "wanted")
    few = wanted.count() <= BROADCAST_NODES
    own = docs.select(_node(docs[text_column]).alias("node"), docs[text_column].alias("text"))
    if few:
        own = own.join(F.broadcast(wanted), "node", "left_semi")
    # Of equal texts each task keeps one before they are dealt out.
    once = own.groupBy("node").agg(F.first("text").alias("text"))
    if not few:
        once = once.join(wanted, "node", "left_semi")
    texts = materialize(once, "texts")
    found = materialize(links(found, texts, weights, threshold), "links")
    return found, components(found.select("leader", "node"))


def _placed(docs: DataFrame, id_column: str, text_column: str, threshold: float) -> DataFrame:
    """Per row of ``docs`` its id, ``node``, ``n_links`` (null for none) and the ``root`` of its class (null: wordless)."""
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        weights = spark.sparkContext.broadcast(shingle_weights(docs, text_column))
        rows = materialize(signed(docs, weights, id_column, text_column), "signed")
        found, roots = verified_links(rows, docs, weights, text_column, threshold)
        degrees = found.groupBy("node").agg(F.sum("n").alias("n_links"))
        # Written first: a join of plain tables may be split where many rows share a text or a class.
        classes = materialize(roots.join(degrees, "node"), "classes")
        own = rows.select(F.col(id_column), "node").join(classes, "node", "left")
    placed = materialize(own.withColumn("root", F.coalesce("root", "node")), "placed")
    scratch.clear()
    return placed


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``docs``: its id, ``class_id``, ``n_links`` and the text's digest ``node``.

    ``class_id`` is the least id of all rows whose texts are joined by equality or by
    links. ``n_links`` counts the different texts to which the row's text was found
    linked. A null text, or one without a word, is in no class with any other: its
    ``class_id`` is its own id and its ``node`` is null. Null ids are never a ``class_id``
    unless a class has no other.
    """
    placed = _placed(docs, id_column, text_column, threshold)
    least = placed.where("root IS NOT NULL").groupBy("root").agg(F.min(id_column).alias("class_id"))
    out = placed.join(materialize(least, "least"), "root", "left")
    return out.select(
        id_column,
        F.when(F.col("root").isNull(), F.col(id_column)).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        "node",
    )


def _row_key(digest: Column, id_: Column) -> Column:
    return F.concat_ws(":", digest.cast("string"), id_.cast("string"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Of every class the row with the least id, a null one last, with its columns as they are.

    Of several texts beside that id the one of the least digest stays. Rows that repeat id and text count as one. Wordless texts are all kept.
    """
    placed = _placed(docs, id_column, text_column, THRESHOLD).where("root IS NOT NULL")
    # Ids are not unique to a class, roots are: an id may be null or stand beside several texts.
    row = F.struct(F.col(id_column).isNull(), F.col(id_column).alias("id"), "node")
    heads = placed.groupBy("root").agg(F.min(row).alias("head")).select("head.id", "head.node")
    key, copy = free_name(docs, "key"), free_name(docs, "copy")
    text = F.coalesce(docs[text_column], F.lit(""))
    # The id is in the key, so the copies of one text are spread.
    own = docs.withColumn(key, F.when(text.rlike(r"[^ \t\n\x0B\f\r]"), _row_key(_node(docs[text_column]), docs[id_column])))
    heads = heads.select(_row_key(F.col("node"), F.col("id")).alias(key))
    order = Window.partitionBy(key).orderBy(F.lit(1))
    kept = own.join(heads, key)
    first = kept.withColumn(copy, F.row_number().over(order)).where(F.col(copy) == 1)
    wordless = own.where(F.col(key).isNull())
    return first.select(*docs.columns).unionByName(wordless.select(*docs.columns))
