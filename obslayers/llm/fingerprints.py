"""Document fingerprints as invertible Bloom lookup sketches (operator 10), in built-in functions only.

A text is the multiset of its paragraphs' digests. A digest goes to three cells of a table, one
in each third of it, and a cell holds how many came and the exclusive or of them; a digest
carries a check value in its lower bits. The cells of a text are its fingerprint. A third has a
power of two of cells, at least half as many as the text has digests.

Two texts are compared by subtracting their cells: what they share cancels out. A cell with one
digest left gives it away; taking it out of its other two cells frees further ones, third by third,
until the digests in which the texts differ are all recovered. Pairs of texts with cells left are tried
again with larger tables, and what is left then by the digests themselves. Tables of different
sizes meet at the larger one. Likeness is the share of common digests among all (Jaccard).

Cells are rows, summed by Spark's aggregates. All rows of a pair of texts stay in the task that the
pair's paragraph hashes were dealt to, so the rounds need no exchange.

Order and texts: rows are told apart by 128 bits over id and text. A document's successor is found
among these and the ids alone, by ranges; texts are dealt out once, and the wanted beginnings of
successors once more. Rows equal in id and text are worked on once and counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslayers.storage import Scratch, materialize

# A paragraph is a line; a longer line is cut where its own text says so, behind a sentence or a
# word with one of some last letters, after so many characters, or else at the most.
PARAGRAPH = r"[^\n]{48,127}?(?:[.!?](?=[ \t\n\x0B\f\r])|[dnrty](?=[ \t\x0B\f\r])|[。！？।؟])|[^\n]{1,128}"
# Cells of the smallest third; lower bits of a digest that check the others.
LEAST_THIRD, CHECK_BITS = 4, 24
# Rounds, each over one third, before a table counts as too small; how much larger the tables of each try are.
ROUNDS, TRIES = 9, (1, 4, 32)
# Repeated rows, by id and text, up to which every executor gets a copy of their digests (some 40 bytes each).
BROADCAST_ROWS = 200_000
# Copies of a row that one task writes out at a time.
COPIES = 4096
# The pairs that a document is compared in, and how much larger their first tables are: unlike texts
# have twice as many digests apart as the larger has.
EDITED, NEXT = 0, 1
START = {EDITED: 1, NEXT: 2}
# Cells of the rows that hold what was found: digests of the first text alone, of the second alone.
FIRST, SECOND = -1, -2


def paragraph_hashes(text: Column) -> Column:
    """A 64-bit hash per paragraph; equal paragraphs have equal ones."""
    return F.transform(F.regexp_extract_all(text, F.lit(f"({PARAGRAPH})"), F.lit(0)), lambda p: F.xxhash64(p))


def third_of(n: Column) -> Column:
    """Cells of a third of the table for ``n`` digests: a power of two, at least half of ``n``."""
    wanted = F.greatest(n / 2, F.lit(LEAST_THIRD)).cast("double")
    return F.pow(F.lit(2.0), F.ceil(F.log2(wanted))).cast("int")


def _partitions(df: DataFrame) -> int:
    """The session's shuffle partitions, asked for by number: hashes are small for the work they make, and are not put together by size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# -- cells ---------------------------------------------------------------------------


def _checked(value: Column) -> Column:
    """The digest bits of a hash with check bits below them."""
    digest = F.shiftleft(F.shiftrightunsigned(value, CHECK_BITS), CHECK_BITS)
    return digest.bitwiseOR(F.xxhash64(digest, F.lit("check")).bitwiseAND(F.lit((1 << CHECK_BITS) - 1)))


def _places(digest: Column, third: Column) -> list[Column]:
    """The three cells of a digest."""
    h, mask = F.xxhash64(digest, third), (third - 1).cast("bigint")
    return [F.shiftrightunsigned(h, 20 * j).bitwiseAND(mask).cast("int") + third * j for j in range(3)]


def digest_rows(texts: DataFrame, keys: list[str], hashes: str = "hashes") -> DataFrame:
    """Per text, named by ``keys``, its digests: the second of two equal paragraphs has another one."""
    each = texts.select(*keys, F.explode(hashes).alias("hash"))
    counted = each.groupBy(*keys, "hash").agg(F.count(F.lit(1)).cast("int").alias("n"))
    numbered = counted.select(*keys, "hash", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("nth"))
    return numbered.select(*keys, _checked(F.xxhash64("hash", "nth")).alias("digest"))


def cell_rows(digests: DataFrame, keys: list[str], weight: Column) -> DataFrame:
    """The cells of tables named by ``keys``, of which one is ``third``: counts ``n`` by ``weight``, digests together."""
    placed = digests.select(*keys, "digest", weight.alias("n"), F.explode(F.array(*_places(F.col("digest"), F.col("third")))).alias("cell"))
    return placed.groupBy(*keys, "cell").agg(F.sum("n").cast("int").alias("n"), F.expr("bit_xor(digest)").alias("digest"))


# -- differences ---------------------------------------------------------------------


def _round(cells: DataFrame, j: int, listed: bool) -> DataFrame:
    """One round: every digest that is alone in a cell of third ``j`` becomes a found one and leaves its other cells.

    A digest has one cell in a third, so none is taken out twice.
    """
    digest, third, n = F.col("digest"), F.col("third"), F.col("n")
    places = _places(digest, third)
    alone = (F.abs(n) == 1) & (F.col("cell") == places[j]) & (_checked(digest) == digest)

    def row(cell: Column, count: Column, found: Column) -> Column:
        return F.struct(cell.alias("cell"), count.alias("n"), found.alias("found"))

    none = F.lit(0).cast("bigint")
    others = [row(places[i], -n, none) for i in range(3) if i != j]
    taken = F.array(row(F.when(n > 0, FIRST).otherwise(SECOND), n, digest if listed else none), *others)
    same = F.array(row(F.col("cell"), n, F.col("found")))
    moved = cells.select("pair", "third", "digest", F.inline(F.when(alone, taken).otherwise(same)))
    summed = moved.groupBy("pair", "third", "cell", "found").agg(
        F.sum("n").cast("int").alias("n"), F.expr("bit_xor(digest)").alias("digest")
    )
    return summed.where("n <> 0 or digest <> 0")


def _sides(pairs: DataFrame) -> Column:
    return F.inline(
        F.array(
            F.struct(F.lit(1).alias("side"), F.col("first").alias("hashes")),
            F.struct(F.lit(-1).alias("side"), F.col("second").alias("hashes")),
        )
    )


def differences(pairs: DataFrame, factor: int = 1, listed: bool = True) -> DataFrame:
    """What peeling recovers of pairs of texts, and the cells that are left (``cell`` of 0 and more).

    ``pairs`` has a unique ``pair``, the paragraph hashes ``first`` and ``second``, and how much larger its
    tables ``start``. They are those of the larger text, times that and ``factor``. A digest of the first
    text alone is a row of cell -1 with ``n`` 1, one of the second of cell -2 with -1; not ``listed``, each
    cell is one row with their sum.
    """
    third = third_of(F.greatest(F.size("first"), F.size("second"))) * F.col("start") * factor
    dealt = pairs.select("pair", third.alias("third"), "first", "second").repartition(_partitions(pairs), "pair")
    digests = digest_rows(dealt.select("pair", "third", _sides(pairs)), ["pair", "third", "side"])
    cells = cell_rows(digests, ["pair", "third"], F.col("side")).where("n <> 0 or digest <> 0")
    cells = cells.withColumn("found", F.lit(0).cast("bigint"))
    for i in range(ROUNDS):
        cells = _round(cells, i % 3, listed)
    return cells


def _plain_differences(pairs: DataFrame) -> DataFrame:
    """How many digests are apart, by the digests themselves, for pairs that no table has decoded."""
    digests = digest_rows(pairs.select("pair", _sides(pairs)), ["pair", "side"])
    alone = digests.groupBy("pair", "digest").agg(F.sum("side").alias("n")).where("n <> 0")
    return alone.groupBy("pair").agg(F.count(F.lit(1)).alias("apart"))


def apart(pairs: DataFrame) -> DataFrame:
    """For every pair that differs the number of digests that one of both has alone; a written table."""
    left, done = pairs, []
    is_found = F.col("cell") < 0
    for factor in TRIES:
        found = differences(left, factor, listed=False).groupBy("pair")
        found = found.agg(F.sum(F.when(is_found, F.abs("n")).otherwise(0)).alias("apart"), F.count_if(~is_found).alias("stuck"))
        found = materialize(found, "apart")
        done.append(found.where("stuck = 0").select("pair", "apart"))
        stuck = found.where("stuck > 0").select("pair")
        if stuck.isEmpty():
            break
        left = pairs.join(stuck, "pair", "left_semi")
    else:
        done.append(_plain_differences(left))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return materialize(out, "differences")


def likeness(first: Column, second: Column, apart: Column) -> Column:
    """The share of common digests among all, from the sizes and the number apart; 1 for no digests."""
    every = (first + second).cast("double")
    return F.when(every == 0, 1.0).otherwise((every - apart) / (every + apart))


# -- fingerprints --------------------------------------------------------------------


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """The ``fingerprint`` of texts named by ``keys``, from their paragraph ``hashes``; texts without any have no row.

    Texts with the same first key stay in one task, and their fingerprints, too.
    Text: the cells of a third, then every cell by number, its count (if not 1) and its digests together.
    """
    sized = texts.select(*keys, third_of(F.size("hashes")).alias("third"), "hashes").repartition(_partitions(texts), keys[0])
    cells = cell_rows(digest_rows(sized, [*keys, "third"]), [*keys, "third"], F.lit(1))
    together = F.regexp_replace(F.base64(F.unhex(F.lpad(F.hex("digest"), 16, "0"))), "=", "")
    shown = F.concat(F.col("cell").cast("string"), F.when(F.col("n") != 1, F.concat(F.lit("*"), F.col("n"))).otherwise(""), F.lit(":"), together)
    listed = F.sort_array(F.collect_list(F.struct("cell", shown.alias("shown"))))
    whole = cells.groupBy(*keys, "third").agg(listed.alias("cells"))
    text = F.concat(F.col("third").cast("string"), F.lit(" "), F.array_join(F.transform("cells", lambda c: c["shown"]), " "))
    return whole.select(*keys, text.alias("fingerprint"))


# -- documents and their successors --------------------------------------------------


def successors(rows: DataFrame, partitions: int) -> DataFrame:
    """The ``rows`` (unique h1, h2, and id) with the name of the row behind each (``next1``, ``next2``).

    Rows stand by descending id, those without one last, those of one id by their names. Behind
    the last comes the first. They are dealt out by ranges of id and name together, so one id may
    have any number of them; only one row per range goes to a single task.
    """
    order = [F.desc_nulls_last("id"), F.asc("h1"), F.asc("h2")]
    ranged = rows.repartitionByRange(partitions, *order).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    name = F.struct("h1", "h2")
    inner = F.lead(name).over(Window.partitionBy("part").orderBy(*order))
    heads = ranged.groupBy("part").agg(F.min_by(name, F.struct(F.col("id").isNull(), -F.col("id").cast("decimal(20,0)"), "h1", "h2")).alias("head"))
    parts = Window.orderBy("part")
    everything = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("head").over(parts), F.first("head").over(everything))
    heads = heads.select("part", following.alias("following"))
    linked = ranged.withColumn("inner", inner).join(heads, "part").withColumn("next", F.coalesce("inner", "following"))
    return linked.drop("part", "inner", "following").withColumns({"next1": F.col("next.h1"), "next2": F.col("next.h2")}).drop("next")


def _texts(base: DataFrame, counted: DataFrame) -> DataFrame:
    """Every text once by its row's name: those of repeated rows are gathered, the others pass."""
    base = base.select("h1", "h2", "text")
    repeated = counted.where("n > 1").select("h1", "h2")
    n = repeated.count()
    if not n:
        return base
    repeated = F.broadcast(repeated) if n <= BROADCAST_ROWS else repeated
    several = base.join(repeated, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.first("text").alias("text"))
    return base.join(repeated, ["h1", "h2"], "left_anti").unionByName(several)


def paragraphs(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per document its size, the digest of its edited text, and the paragraph hashes of own, edited and next text.

    One row for all rows equal in id and text (``times``) but the last of them, whose next is another
    document and which has a row of its own. ``row`` numbers them; it holds once they are written.
    """
    text = F.coalesce(docs[text_column], F.lit(""))
    key = docs[id_column].cast("bigint")
    base = docs.select(key.alias("id"), text.alias("text"))
    # A null is passed over in a hash, so it says itself that it is one.
    whole = [F.col("id").isNull(), F.col("id"), F.col("text")]
    base = base.withColumns({"h1": F.xxhash64(*whole), "h2": F.xxhash64(F.lit(1), *whole)})
    counted = base.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("id"), F.max(F.length("text")).alias("n_chars"))
    counted = materialize(counted, "rows")
    linked = successors(counted, _partitions(docs))
    half = F.floor(F.col("n_chars") / 2).cast("int").alias("half")
    last = F.struct(F.lit(1).cast("bigint").alias("times"), F.col("next1"), F.col("next2"))
    equal = F.struct((F.col("n") - 1).alias("times"), F.col("h1").alias("next1"), F.col("h2").alias("next2"))
    ways = F.when(F.col("n") > 1, F.array(last, equal)).otherwise(F.array(last))
    wanted = linked.select(F.col("h1").alias("by1"), F.col("h2").alias("by2"), "id", "n_chars", half, F.inline(ways))
    wanted = materialize(wanted.withColumnsRenamed({"next1": "h1", "next2": "h2"}), "successors")
    # Both joins deal out the same columns of the texts in the same way, so the texts are dealt out once.
    texts = _texts(base, counted)
    begun = texts.join(wanted, ["h1", "h2"]).select(
        F.col("by1").alias("h1"), F.col("by2").alias("h2"), "times", "id", "n_chars", "half",
        F.substring("text", F.lit(1), F.col("half")).alias("beginning"), paragraph_hashes(F.col("text")).alias("next"),
    )
    kept = F.substring("text", F.lit(1), F.col("n_chars") - F.col("half"))
    both = texts.join(begun, ["h1", "h2"]).withColumn("edited", F.concat(kept, "beginning"))
    return both.select(
        F.monotonically_increasing_id().alias("row"), "times", "id", F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        paragraph_hashes(F.col("text")).alias("mine"), paragraph_hashes(F.col("edited")).alias("edited"), "next",
    )


def fingerprint_edits(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    The edited text has the last half of the code points replaced by as many of the next
    document in descending order of ids (after the last: the first), or all of it. A null
    text counts as empty; a row without an id comes after all others; rows that share an
    id follow each other in a fixed order. Ids are whole numbers, or text that says one. An empty text has no
    paragraphs: its fingerprint is that of no digests, and its likeness to another such text is 1.
    Only these two columns are read.
    """
    with Scratch(docs.sparkSession) as own:
        rows = paragraphs(docs, id_column, text_column)
    rows = materialize(rows, "paragraphs")
    own.clear()
    with Scratch(docs.sparkSession) as own:
        pair = F.inline(
            F.array(
                *[
                    F.struct((F.col("row") * 2 + p).alias("pair"), F.lit(START[p]).alias("start"), F.col(other).alias("second"))
                    for p, other in ((EDITED, "edited"), (NEXT, "next"))
                ]
            )
        )
        found = apart(rows.select(F.col("mine").alias("first"), pair))
        number = {p: F.sum(F.when(F.pmod("pair", F.lit(2)) == p, F.col("apart"))).alias(f"apart{p}") for p in START}
        by_row = found.groupBy(F.shiftright("pair", 1).alias("row")).agg(*number.values())
    by_row = materialize(by_row, "likeness")
    own.clear()
    version = F.inline(
        F.array(*[F.struct(F.lit(v).alias("version"), F.col(c).alias("hashes")) for v, c in ((0, "mine"), (1, "edited"))])
    )
    shown = fingerprints(rows.select("row", version), ["row", "version"])
    either = [F.max(F.when(F.col("version") == v, F.col("fingerprint"))).alias(f"shown{v}") for v in (0, 1)]
    shown = shown.groupBy("row").agg(*either)
    sizes = rows.select("row", "times", "id", "n_chars", "edited_sha256", *[F.size(c).alias(f"n_{c}") for c in ("mine", "edited", "next")])
    whole = sizes.join(shown, "row", "left").join(by_row, "row", "left")
    empty = F.lit(f"{LEAST_THIRD} ")

    def near(other: str, pair: int) -> Column:
        return likeness(F.col("n_mine"), F.col(f"n_{other}"), F.coalesce(f"apart{pair}", F.lit(0)))

    result = whole.select(
        F.col("id").alias(id_column),
        "n_chars",
        "edited_sha256",
        F.coalesce("shown0", empty).alias("fingerprint"),
        F.coalesce("shown1", empty).alias("edited_fingerprint"),
        near("edited", EDITED).alias("near_edited"),
        near("next", NEXT).alias("near_next"),
        "times",
    )
    # Nearly all rows are there once; of the others some thousands are written out together.
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("times") - 1) / COPIES))
    result = result.withColumn("piece", F.explode(pieces))
    copies = F.least(F.col("times") - F.col("piece") * COPIES, F.lit(COPIES)).cast("int")
    return result.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("times", "piece", "copy")
