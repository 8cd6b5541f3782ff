"""Merkle manifest of a dataset (operator 11): leaf places by ranks in bitmaps, then slot arrays by level.

A row's place among the leaves of its group is its rank by id. Ids are held as bitmaps: one
row per group and run of 64 ids that occur, in slices (bit i of slice j says that id i has
bit j of its number of rows set), so that repeated ids count as often as they occur. A
directory of counts, summed up a tree of 4096-fold runs, says how many rows come before
each word; the rank of a row is that and the weighted popcounts below its bit. No leaves
are sorted.

Places cut every group into blocks of 8**4 slots. A task fills the slots of a block by
place, takes its levels, and gives its top node, which is a leaf of the next round. The
way down hands every block its path to the root, from which the proofs of its leaves
follow. A digest is the SHA-256 of the lower-case hexadecimal text of its parts.

Rows that share an id come in the order of their leaves, equal rows next to each other; rows
without an id come before all others of their group; a null group comes first.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslayers.llm.sql import crc32
from obslayers.storage import Scratch, materialize

# Nodes of a run, levels that a block spans.
RUN, LEVELS = 8, 4
BLOCK = RUN**LEVELS
# A directory run spans so many bits of the key below it.
DIRECTORY_BITS = 12
# Rows of one bitmap word up to which a task takes them as a whole.
CROWDED = 1 << 16
# Crowded words up to which every executor gets a copy (some 50 bytes each).
BROADCAST_ROWS = 200_000
# Leading hexadecimal digits of a leaf that order rows of one id.
PREFIX = 15
# The document columns of a leaf, in its order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# -- leaves ------------------------------------------------------------------------


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row: every value by its length in bytes and as text, ``-`` for null."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def group_name(value: Column) -> Column:
    """A text per group, null included, in the order of groups: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


# -- places ------------------------------------------------------------------------


def _begins(counted: DataFrame, keys: list[str], key: str, low: int, high: int) -> DataFrame:
    """``counted``, unique by ``keys`` and ``key``, with the sum of ``n`` over lower keys as ``begin``.

    A run of keys is summed in one window; runs are placed by the directory above them.
    """

    def before(*within: str) -> Column:
        window = Window.partitionBy(*within).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    if high - low < 1 << DIRECTORY_BITS:
        return counted.withColumn("begin", before(*keys))
    up = f"{key}_"
    runs = counted.withColumn(up, F.shiftright(key, DIRECTORY_BITS))
    sums = runs.groupBy(*keys, up).agg(F.sum("n").alias("n"))
    placed = _begins(sums, keys, up, low >> DIRECTORY_BITS, high >> DIRECTORY_BITS)
    placed = placed.select(*keys, up, F.col("begin").alias("base"))
    joined = runs.withColumn("within", before(*keys, up)).join(placed, [*keys, up])
    return joined.withColumn("begin", F.col("base") + F.col("within")).drop(up, "base", "within")


def _bitmaps(rows: DataFrame) -> DataFrame:
    """Per group and word of 64 ids the slices of its bitmap, and its number of rows ``n``."""
    counts = rows.groupBy("g", "word", "bit").agg(F.count(F.lit(1)).alias("rows"))
    set_bits = F.expr("filter(sequence(0, 62), j -> (shiftright(rows, j) & 1L) = 1L)")
    slices = counts.select("g", "word", "bit", F.explode(set_bits).alias("slice"))
    merged = slices.groupBy("g", "word", "slice").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    entry = F.struct("slice", "bits")
    weight = F.expr("shiftleft(cast(bit_count(bits) as bigint), slice)")
    return merged.groupBy("g", "word").agg(F.sum(weight).alias("n"), F.collect_list(entry).alias("slices"))


def _ranked(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``rows`` with the ``place`` of the first row of their id, and how many rows have it (``equal``)."""
    crowded = index.where(F.col("n") > CROWDED).select("g", "word", F.floor(F.col("n") / CROWDED).cast("int").alias("shards"))
    n_crowded = crowded.count()
    keys = ["g", "word"]
    if n_crowded:
        # Rows of a crowded word go to several tasks, its bitmap to each of them.
        crowded = F.broadcast(crowded) if n_crowded <= BROADCAST_ROWS else crowded
        shards = F.coalesce("shards", F.lit(0))
        # By position in the written table, so that copies of one row are dealt out, too.
        dealt = F.pmod(F.monotonically_increasing_id(), shards + 1).cast("int")
        rows = rows.join(crowded, keys, "left").withColumn("shard", dealt).drop("shards")
        index = index.join(crowded, keys, "left").withColumn("shard", F.explode(F.sequence(F.lit(0), shards))).drop("shards")
        keys = [*keys, "shard"]
    rank = F.expr("aggregate(slices, 0L, (a, s) -> a + shiftleft(cast(bit_count(s.bits & ~shiftleft(-1L, bit)) as bigint), s.slice))")
    equal = F.expr("aggregate(slices, 0L, (a, s) -> a + shiftleft(shiftright(s.bits, bit) & 1L, s.slice))")
    found = rows.join(index.select(*keys, "slices", "begin"), keys)
    return found.withColumn("place", F.col("begin") + rank).withColumn("equal", equal).drop("slices", "begin", "shard")


def _spread(rows: DataFrame) -> DataFrame:
    """Places of rows whose id others have as well: by leaf, copies next to each other.

    Copies are counted first and expanded last, in pieces, so no task holds a group of them.
    """
    own = ["g", "word", "bit"]
    copies = rows.groupBy(*own, "doc_id", "leaf", "changed", "place").agg(F.count(F.lit(1)).alias("n"))
    copies = copies.withColumn("key", F.conv(F.substring(F.hex("leaf"), 1, PREFIX), 16, 10).cast("bigint"))
    copies = materialize(copies, "copies")
    prefixes = copies.groupBy(*own, "key").agg(F.sum("n").alias("n"))
    begins = _begins(prefixes, own, "key", 0, 1 << 4 * PREFIX).select(*own, "key", "begin")
    order = Window.partitionBy(*own, "key").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    placed = copies.withColumn("within", F.coalesce(F.sum("n").over(order), F.lit(0))).join(begins, [*own, "key"])
    first = F.col("place") + F.col("begin") + F.col("within")
    pieces = placed.select(
        "g", "doc_id", "leaf", "changed", first.alias("first"), "n",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / BLOCK))).alias("piece"),
    ).repartition("g", "first", "piece")
    last = F.least(F.col("n"), (F.col("piece") + 1) * BLOCK) - 1
    each = F.explode(F.sequence(F.col("piece") * BLOCK, last)).alias("copy")
    return pieces.select("g", "doc_id", "leaf", "changed", "first", each).select(
        "g", (F.col("first") + F.col("copy")).alias("place"), "doc_id", "leaf", "changed"
    )


def slots(leaves: DataFrame) -> DataFrame:
    """A written table of ``leaves`` (g, doc_id, leaf, changed) with the ``place`` of each in its group, from 0."""
    with Scratch(leaves.sparkSession) as own:
        leaves = materialize(leaves, "leaves")
        word = F.shiftright(F.col("doc_id"), 6)
        low, high = leaves.agg(F.min(word), F.max(word)).first()
        low, high = (0, 0) if low is None else (low, high)
        # Rows without an id: a word of their own below all others.
        none = F.lit(low - 1).cast("bigint")
        bit = F.coalesce(F.col("doc_id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int")
        rows = leaves.withColumn("word", F.coalesce(word, none)).withColumn("bit", bit)
        bitmaps = materialize(_bitmaps(rows), "bitmaps")
        begins = _begins(bitmaps.select("g", "word", "n"), ["g"], "word", low - 1, high)
        ranked = _ranked(rows, bitmaps.join(begins.drop("n"), ["g", "word"]))
        columns = ["g", "place", "doc_id", "leaf", "changed"]
        placed = ranked.select(columns)
        if not bitmaps.where(F.exists("slices", lambda s: s["slice"] > 0)).isEmpty():
            ranked = materialize(ranked, "ranked")
            single = ranked.where(F.col("equal") == 1).select(columns)
            placed = single.unionByName(_spread(ranked.where(F.col("equal") > 1)))
    placed = materialize(placed, "slots")
    own.clear()
    return placed


# -- trees -------------------------------------------------------------------------


def node(parts: Sequence[bytes]) -> bytes:
    return sha256(b"".join(parts).hex().encode()).digest()


def levels(digests: list[bytes], whole: bool) -> list[list[bytes]]:
    """The levels of a block: of a whole tree up to its one node, of a part of a larger one all of them."""
    found = [digests]
    while len(found[-1]) > 1 if whole else len(found) <= LEVELS:
        below = found[-1]
        found.append([node(below[i : i + RUN]) for i in range(0, len(below), RUN)])
    return found


def _slot_array(table: pa.Table, column: str) -> tuple[np.ndarray, list]:
    """The order of a block's rows by slot, and their values in it."""
    places = table.column("place").to_numpy()
    order = np.empty(len(places), np.int64)
    order[places % BLOCK] = np.arange(len(places))
    return order, table.column(column).take(pa.array(order)).to_pylist()


def siblings(found: list[list[bytes]], slot: int) -> list[tuple[int, list[bytes]]]:
    """By level the place of a node in its run, and the others of the run."""
    out = []
    for nodes in found[:-1]:
        begin, own = slot - slot % RUN, slot % RUN
        run = nodes[begin : begin + RUN]
        out.append((own, run[:own] + run[own + 1 :]))
        slot //= RUN
    return out


def packed_path(path: list[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(bytes((own, len(others))) + b"".join(others) for own, others in path)


def unpacked_path(data: bytes) -> list[tuple[int, list[bytes]]]:
    path, at = [], 0
    while at < len(data):
        own, n = data[at], data[at + 1]
        path.append((own, [data[i : i + 32] for i in range(at + 2, at + 2 + 32 * n, 32)]))
        at += 2 + 32 * n
    return path


def folded(digest: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The top of a path, from the node below it."""
    for own, others in path:
        digest = node([*others[:own], digest, *others[own:]])
    return digest


def _tops(table: pa.Table) -> pa.Table:
    _, digests = _slot_array(table, "leaf")
    part, whole = levels(digests, False)[-1][0], levels(digests, True)[-1][0]
    block = table.column("block")[0].as_py()
    return pa.table(
        {"g": table.column("g").slice(0, 1), "place": pa.array([block], pa.int64()), "leaf": pa.array([part], pa.binary()), "whole": pa.array([whole], pa.binary())}
    )


def _downwards(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """The path of every node of a block: its siblings there, then the block's own path."""
    _, digests = _slot_array(nodes, "leaf")
    found, rest = levels(digests, above.column("whole")[0].as_py()), above.column("path")[0].as_py()
    first = nodes.column("place")[0].as_py() // BLOCK * BLOCK
    return pa.table(
        {
            "g": pa.repeat(nodes.column("g")[0], len(digests)),
            "block": pa.array(range(first, first + len(digests)), pa.int64()),
            "path": pa.array([packed_path(siblings(found, i)) + rest for i in range(len(digests))], pa.binary()),
            "top": pa.repeat(above.column("top")[0], len(digests)),
            "root": pa.repeat(above.column("root")[0], len(digests)),
        }
    )


def _results(rows: pa.Table, above: pa.Table) -> pa.Table:
    """Proof and check of every leaf of a block."""
    order, leaves = _slot_array(rows, "leaf")
    changed = rows.column("changed").take(pa.array(order)).to_pylist()
    found = levels(leaves, above.column("whole")[0].as_py())
    rest, root = unpacked_path(above.column("path")[0].as_py()), above.column("root")[0].as_py()
    rest_text = b"".join(d for _, others in rest for d in others).hex().encode()
    proofs, tops, verified = [], [], []
    for i, digest in enumerate(leaves):
        own = siblings(found, i)
        text = b"".join(d for _, others in own for d in others).hex().encode() + rest_text
        top = folded(changed[i] or digest, own + rest)
        proofs.append(sha256(text).hexdigest())
        tops.append(top.hex())
        verified.append(top == root)
    n = len(leaves)
    return pa.table(
        {
            "doc_id": rows.column("doc_id").take(pa.array(order)),
            "leaf": pa.array([d.hex() for d in leaves], pa.string()),
            "subroot": pa.repeat(pa.scalar(above.column("top")[0].as_py().hex(), pa.string()), n),
            "root": pa.repeat(pa.scalar(root.hex(), pa.string()), n),
            "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(tops, pa.string()),
            "verified": pa.array(verified, pa.bool_()),
        }
    )


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("place") / BLOCK).cast("bigint"))


PATHS = "g string, block bigint, path binary, top binary, root binary, whole boolean"


class Tree:
    """The levels of many trees at once: ``nodes`` are their leaves (g, place, leaf), a written table.

    A round takes blocks to their top nodes. Trees of one block end with it (``ends``), the
    others go on; every round's nodes stay written for the way down.
    """

    def __init__(self, nodes: DataFrame):
        self.rounds, self.ends = [nodes], []
        while True:
            blocks = _blocks(self.rounds[-1].select("g", "place", "leaf")).groupBy("g", "block")
            tops = materialize(blocks.applyInArrow(_tops, "g string, place bigint, leaf binary, whole binary"), "tops")
            sizes = tops.groupBy("g").agg(F.count(F.lit(1)).alias("blocks"), F.max_by("whole", "place").alias("top"))
            sizes = materialize(sizes, "sizes")
            self.ends.append(sizes.where(F.col("blocks") == 1).select("g", "top"))
            more = sizes.where(F.col("blocks") > 1)
            if more.isEmpty():
                break
            self.rounds.append(materialize(tops.join(more, "g", "left_semi").select("g", "place", "leaf"), "nodes"))

    def tops(self) -> DataFrame:
        """Every tree's top node: g, top."""
        out = self.ends[0]
        for end in self.ends[1:]:
            out = out.unionByName(end)
        return out

    def paths(self, above: DataFrame) -> DataFrame:
        """Per block of leaves its path, given each tree's (g, path, root), a written table."""
        found = None
        for r in reversed(range(len(self.rounds))):
            begun = self.ends[r].join(above, "g").withColumn("block", F.lit(0).cast("bigint"))
            begun = begun.withColumn("whole", F.lit(True))
            here = begun if found is None else begun.unionByName(found.withColumn("whole", F.lit(False)))
            if r == 0:
                return here
            pair = _blocks(self.rounds[r]).groupBy("g", "block").cogroup(here.groupBy("g", "block"))
            found = materialize(pair.applyInArrow(_downwards, PATHS.replace(", whole boolean", "")), "paths")


def _numbered(tops: DataFrame) -> DataFrame:
    """Groups as the leaves of one tree, in the order of their names: dealt out by ranges and counted."""
    partitions = int(tops.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(tops.repartitionByRange(partitions, "g").withColumn("part", F.spark_partition_id()), "groups")
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("g")) - 1
    numbered = ranged.withColumn("within", within).join(begins, "part")
    return numbered.select("g", (F.col("begin") + F.col("within")).alias("place"), F.col("top").alias("leaf"))


def manifest(leaves: DataFrame) -> DataFrame:
    """Root, proof and check of every leaf.

    ``leaves`` has ``g`` (a group's name, in the order of groups; not null), ``doc_id``
    (a whole number or null), ``leaf`` and ``changed``: the digest that is checked
    against the proof in its stead, or null. Returns doc_id, leaf, subroot, root,
    proof_sha256, folded_root and verified; no rows for no rows.
    """
    placed = slots(leaves)
    tree = Tree(placed)
    groups = materialize(_numbered(tree.tops()), "subroots")
    name = F.lit("all").alias("g")
    upper = Tree(materialize(groups.select(name, "place", "leaf"), "upper"))
    start = upper.tops().select("g", F.lit(b"").alias("path"), F.col("top").alias("root"))
    blocks = upper.paths(materialize(start, "start"))
    nodes = _blocks(groups.select(name, "place", "leaf")).groupBy("g", "block")
    ways = nodes.cogroup(blocks.groupBy("g", "block")).applyInArrow(_downwards, PATHS.replace(", whole boolean", ""))
    above = groups.join(ways.select(F.col("block").alias("place"), "path", "root"), "place").select("g", "path", "root")
    paths = tree.paths(materialize(above, "above"))
    pair = _blocks(placed).groupBy("g", "block").cogroup(paths.groupBy("g", "block"))
    id_type = placed.schema["doc_id"].dataType.simpleString()
    return pair.applyInArrow(
        _results,
        f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )


def tampered(docs: DataFrame) -> Column:
    """The text as someone else might have left it: A-Z in lower case where 3 divides the id's CRC-32."""
    hit = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate(docs["text"], string.ascii_uppercase, string.ascii_lowercase)).otherwise(docs["text"])


def tamper_check(docs: DataFrame) -> DataFrame:
    """The manifest of documents, and whether it tells tampered texts: every row is a leaf of its ``lang``.

    Nulls in any column have a place in the leaf; a row without an id is never tampered
    with. Only the five columns of a leaf are read, whatever others there are.
    """
    whole = [docs[c] for c in FIELDS]
    other = leaf([*whole[:-1], tampered(docs)])
    rows = docs.select(group_name(docs["lang"]).alias("g"), docs["doc_id"].cast("bigint").alias("doc_id"), leaf(whole).alias("leaf"), other.alias("other"))
    changed = F.when(F.col("other") != F.col("leaf"), F.col("other")).alias("changed")
    return manifest(rows.select("g", "doc_id", "leaf", changed))


# -- the query's SQL -----------------------------------------------------------------

# Levels written out for a group (8**8 leaves) and over the groups (8**4 of them).
GROUP_LEVELS, UPPER_LEVELS = 8, 4


def _sql_leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def _sql_levels(name: str, n: int) -> str:
    """CTEs ``name0`` to ``name{n}`` of nodes (g, p, d), and what stands left and right of each in its run."""
    parts = []
    for k in range(n):
        run = "PARTITION BY g, p // 8 ORDER BY p ROWS BETWEEN"
        parts.append(f"""
        {name}{k}_runs AS (SELECT g, p, d,
            coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM {name}{k} QUALIFY count(*) OVER (PARTITION BY g) > 1),
        {name}{k + 1} AS (SELECT g, p // 8 AS p, sha256(string_agg(d, '' ORDER BY p)) AS d FROM {name}{k}_runs GROUP BY ALL)""")
    tops = " UNION ALL ".join(
        f"(SELECT g, d FROM {name}{k} QUALIFY count(*) OVER (PARTITION BY g) = 1)" for k in range(n + 1)
    )
    return ",".join(parts) + f",\n        {name}_tops AS ({tops})"


def _sql_climb(name: str, before: str, g: str, p: str, n: int) -> str:
    """CTEs that take every leaf's ``x`` and ``proof`` up the levels of ``name``."""
    parts = []
    for k in range(n):
        parts.append(f"""
        {name}{k}_climb AS (SELECT b.* REPLACE (
                CASE WHEN s.g IS NULL THEN x ELSE sha256(l || x || r) END AS x, proof || coalesce(l || r, '') AS proof)
            FROM {before} AS b LEFT JOIN {name}{k}_runs AS s ON b.{g} = s.g AND b.{p} // {8**k} = s.p)""")
        before = f"{name}{k}_climb"
    return ",".join(parts)


_UPPER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL = f"""
    WITH leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {_sql_leaf("text")} AS d,
            CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_sql_leaf(_UPPER)} ELSE {_sql_leaf("text")} END AS x
        FROM documents),
        base AS (SELECT *, '' AS proof, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS p FROM leaves),
        n0 AS (SELECT g, p, d FROM base),
        {_sql_levels("n", GROUP_LEVELS)},
        m0 AS (SELECT 'all' AS g, row_number() OVER (ORDER BY g) - 1 AS p, d FROM n_tops),
        {_sql_levels("m", UPPER_LEVELS)},
        {_sql_climb("n", "base", "g", "p", GROUP_LEVELS)},
        placed AS (SELECT c.*, t.d AS subroot, t.q, 'all' AS whole FROM n{GROUP_LEVELS - 1}_climb AS c
            JOIN (SELECT g, d, row_number() OVER (ORDER BY g) - 1 AS q FROM n_tops) AS t USING (g)),
        {_sql_climb("m", "placed", "whole", "q", UPPER_LEVELS)}
    SELECT doc_id, c.d AS leaf, subroot, t.d AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = t.d AS verified
    FROM m{UPPER_LEVELS - 1}_climb AS c, m_tops AS t"""
