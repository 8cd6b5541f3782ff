"""Spelling variants (operator 12): words one edit apart, found by k-d trees over letter counts.

A word is the point of its letter counts. One replaced letter takes at most one up and one
down among the counts, one inserted letter takes one up, so a word's near words of a length
lie in a small box around it. The words of a length are dealt out by a k-d tree made from a
sample of them: a word goes to one cell as a point, and as a query to every cell that its
box meets, in the tree of its own length and in that of the length above. In a cell a
second k-d tree over all its points gives the candidates in the same way, and the order of
the letters decides.

The sample only decides how evenly cells are filled. Cells with too many points or
queries are searched in pieces, every piece of points by every piece of queries.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator
from math import ceil, log, log2
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslayers.llm import sql
from obslayers.storage import Scratch, materialize

# Letters of a run, the code points a word has at least, and its occurrences.
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 6, 5
# A form is so many times as frequent as its variant.
FORM_FACTOR = 5
# Words of which a task keeps the counts before it hands them on.
HELD_WORDS = 200_000
# Words the trees are made from, at most about (their bound: the driver has them), and their
# length; longer words have a cell for each length.
SAMPLE_WORDS, SAMPLE_LENGTH = 100_000, 64
# Points a cell should have; points and queries of one search; words of the sample in a cell at least.
CELL_POINTS, SEARCH_POINTS, SEARCH_QUERIES, LEAST_SAMPLE = 16_384, 32_768, 65_536, 32
# Cells with too many rows up to which every executor gets a copy (some 40 bytes each).
BROADCAST_ROWS = 200_000
# Counts compared at a time, and points of a leaf of the inner trees.
BLOCK_VALUES, LEAF_POINTS = 1 << 22, 48
# Letters share counts beyond a-z: a near pair stays near then.
DIMENSIONS = 32
CLASS = np.array([b - 97 if 97 <= b < 123 else 26 + b % 6 for b in range(256)], np.int64)

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


# -- words ---------------------------------------------------------------------------


def count_words(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", slips: int | None = 199
) -> DataFrame:
    """Words of at least 6 letters with their number of occurrences over all texts, at least 5.

    Words are runs of letters with A-Z in lower case. ``slips`` plants misspellings: where it
    divides the CRC-32 of ``<id>:<run>`` the run loses the letter that the CRC names. A null text
    has no words; a null id counts as an empty one. Only these two columns are read.
    """
    find = re.compile(RUN).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def given() -> pa.RecordBatch:
            columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = crc32(f"{name or ''}:".encode())
                for found, n in Counter(w for w in find(text or "") if len(w) >= LEAST_LENGTH).items():
                    word = found.translate(_LOWER)
                    code = crc32(word.encode(), start) if slips else 1
                    if slips and code % slips == 0:
                        at = code % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < LEAST_LENGTH:
                            continue
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield given()
                    held.clear()
        yield given()

    given = docs.select(docs[id_column].cast("string").alias("id"), docs[text_column].alias("text"))
    counted = given.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT).withColumn("size", F.char_length("word"))


# -- letter counts and trees ----------------------------------------------------------


def letters(words: list[str], size: int) -> np.ndarray:
    """The letters of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), size)


def counts(rows: np.ndarray) -> np.ndarray:
    """Letter counts of rows of letters."""
    at = CLASS[rows] + DIMENSIONS * np.arange(len(rows))[:, None]
    kind = np.int8 if rows.shape[1] < 64 else np.int32
    return np.bincount(at.ravel(), minlength=DIMENSIONS * len(rows)).reshape(-1, DIMENSIONS).astype(kind)


class KdTree:
    """Cells of points by single counts, each cut where it parts a cell most evenly.

    Cells with over ``most`` points are cut while any of their counts differ.
    """

    def __init__(self, points: np.ndarray, most: int):
        # Rows: dimension, highest count on the left, left and right row; or -1 and the cell.
        self.rows: list[tuple[int, int, int, int]] = [(-1, 0, 0, 0)]
        self.members: list[np.ndarray] = []
        todo = [(0, np.arange(len(points)))]
        while todo:
            row, own = todo.pop()
            cut = self._cut(points[own]) if len(own) > most else None
            if cut is None:
                self.rows[row] = (-1, len(self.members), 0, 0)
                self.members.append(own)
                continue
            dim, value = cut
            left = points[own, dim] <= value
            self.rows[row] = (dim, value, len(self.rows), len(self.rows) + 1)
            todo += [(len(self.rows), own[left]), (len(self.rows) + 1, own[~left])]
            self.rows += [(-1, 0, 0, 0)] * 2

    @staticmethod
    def _cut(points: np.ndarray) -> tuple[int, int] | None:
        low = points.min(axis=0)
        middle = np.maximum(np.median(points, axis=0).astype(np.int64), low)
        best, found = 0, None
        for values in (middle, np.maximum(middle - 1, low)):
            left = (points <= values).sum(axis=0)
            even = np.minimum(left, len(points) - left)
            dim = int(even.argmax())
            if even[dim] > best:
                best, found = even[dim], (dim, int(values[dim]))
        return found

    def without_members(self) -> KdTree:
        other = object.__new__(KdTree)
        other.rows, other.members = self.rows, []
        return other

    def reached(self, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Cells and the queries that may come to them by at most so many counts up and down."""
        zero, none = np.zeros(len(queries), np.int32), {}
        todo = [(0, np.arange(len(queries)), zero, zero, none, none)]
        while todo:
            row, own, ups, downs, low, high = todo.pop()
            dim, value, left, right = self.rows[row]
            if dim < 0:
                yield value, own
                continue
            at = queries[own, dim].astype(np.int32)
            over = np.maximum(at - high[dim], 0) if dim in high else 0
            under = np.maximum(low[dim] - at, 0) if dim in low else 0
            new = downs - over + np.maximum(at - value, 0)
            take = new <= down
            if take.any():
                todo.append((left, own[take], ups[take], new[take], low, {**high, dim: value}))
            new = ups - under + np.maximum(value + 1 - at, 0)
            take = new <= up
            if take.any():
                todo.append((right, own[take], new[take], downs[take], {**low, dim: value + 1}, high))


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``b`` are those of ``a`` with a letter more."""
    begin = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    end = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return begin + end >= a.shape[1]


def near_pairs(queries: list[str], points: list[str], inserted: bool) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of queries and points one edit apart: a replaced letter, or one more in the point."""
    none = np.empty(0, np.int64)
    if not queries or not points:
        return none, none
    of_queries, of_points = letters(queries, len(queries[0])), letters(points, len(points[0]))
    around, at = counts(of_queries), counts(of_points)
    tree, found = KdTree(at, LEAF_POINTS), []
    for cell, own in tree.reached(around, 1, 0 if inserted else 1):
        members = tree.members[cell]
        step = max(1, BLOCK_VALUES // (len(members) * max(DIMENSIONS, of_points.shape[1])))
        for begin in range(0, len(own), step):
            some = own[begin : begin + step]
            apart = np.abs(around[some][:, None, :] - at[members][None, :, :]).sum(axis=2, dtype=np.int32)
            i, j = np.nonzero(apart <= (1 if inserted else 2))
            q, p = some[i], members[j]
            for first in range(0, len(q), step * len(members)):
                a, b = q[first : first + step * len(members)], p[first : first + step * len(members)]
                same = (_inserted if inserted else _replaced)(of_queries[a], of_points[b])
                found.append((a[same], b[same]))
    if not found:
        return none, none
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


# -- search --------------------------------------------------------------------------

POINT, REPLACE, INSERT = range(3)


def _trees(words: DataFrame) -> dict[int, KdTree]:
    """For each length a tree made from a sample of its words, for cells of about ``CELL_POINTS``."""
    every = ceil(words.count() / SAMPLE_WORDS) or 1
    picked = words.where((F.col("size") <= SAMPLE_LENGTH) & (F.pmod(F.xxhash64("word"), F.lit(every)) == 0))
    by_length: dict[int, list[str]] = {}
    for row in picked.select("word").toLocalIterator():
        by_length.setdefault(len(row.word), []).append(row.word)
    most = max(LEAST_SAMPLE, CELL_POINTS // every)
    return {size: KdTree(counts(letters(some, size)), most).without_members() for size, some in by_length.items()}


def _dealt(words: DataFrame, trees: dict[int, KdTree]) -> DataFrame:
    """Every word with the cells it is a point or a query of."""
    roles = ((POINT, 0, 0, 0), (REPLACE, 0, 1, 1), (INSERT, 1, 1, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words_, sizes = batch.column("word").to_pylist(), batch.column("size").to_numpy()
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                at = counts(letters([words_[i] for i in own], int(size)))
                for role, longer, up, down in roles:
                    tree = trees.get(int(size) + longer)
                    cells = [(0, np.arange(len(own)))] if tree is None else tree.reached(at, up, down)
                    for cell, some in cells:
                        rows = batch.take(pa.array(own[some]))
                        n = rows.num_rows
                        kinds = [("length", size + longer), ("cell", cell), ("role", role)]
                        columns = [pa.array(np.full(n, value, np.int32)) for _, value in kinds]
                        columns += [rows.column("word"), rows.column("n")]
                        yield pa.RecordBatch.from_arrays(columns, names=["length", "cell", "role", "word", "n"])

    return words.select("word", "n", "size").mapInArrow(run, "length int, cell int, role int, word string, n bigint")


def _in_pieces(dealt: DataFrame) -> DataFrame:
    """``dealt`` with the piece of points and the piece of queries that a row is searched in."""
    is_point = F.col("role") == POINT

    def pieces(rows: Column, most: int) -> Column:
        return F.ceil(F.greatest(F.sum(rows.cast("long")), F.lit(1)) / most).cast("int")

    sizes = dealt.groupBy("length", "cell").agg(
        pieces(is_point, SEARCH_POINTS).alias("points"), pieces(~is_point, SEARCH_QUERIES).alias("queries")
    )
    crowded = sizes.where("points > 1 or queries > 1")
    n = crowded.count()
    if not n:
        return dealt.withColumn("of_points", F.lit(0)).withColumn("of_queries", F.lit(0))
    crowded = F.broadcast(crowded) if n <= BROADCAST_ROWS else crowded
    joined = dealt.join(crowded, ["length", "cell"], "left")
    points, queries = F.coalesce("points", F.lit(1)), F.coalesce("queries", F.lit(1))

    def one(n: Column) -> Column:
        return F.array(F.pmod(F.xxhash64("word"), n).cast("int"))

    def all_(n: Column) -> Column:
        return F.sequence(F.lit(0), n - 1)

    joined = joined.withColumn("of_points", F.explode(F.when(is_point, one(points)).otherwise(all_(points))))
    joined = joined.withColumn("of_queries", F.explode(F.when(is_point, all_(queries)).otherwise(one(queries))))
    return joined.drop("points", "queries")


def _search(table: pa.Table) -> pa.Table:
    """Near words in one piece of a cell, told to both words of a pair."""
    roles = table.column("role").to_numpy()
    parts = [table.filter(pa.array(roles == role)) for role in (POINT, REPLACE, INSERT)]
    words = [part.column("word").to_pylist() for part in parts]
    out = []
    for role in (REPLACE, INSERT):
        q, p = (pa.array(x) for x in near_pairs(words[role], words[POINT], role == INSERT))
        asked, met = parts[role].take(q), parts[POINT].take(p)
        ways = [(asked, met)] if role == REPLACE else [(asked, met), (met, asked)]
        for a, b in ways:
            out.append(pa.table({"word": a.column("word"), "other": b.column("word"), "other_n": b.column("n")}))
    return pa.concat_tables(out)


def near_words(words: DataFrame) -> DataFrame:
    """Rows (word, other, other_n) for every two ``words`` (word, n, size) one edit apart, both ways."""
    dealt = materialize(_dealt(words, _trees(words)), "dealt")
    groups = _in_pieces(dealt).groupBy("length", "cell", "of_points", "of_queries")
    return groups.applyInArrow(_search, "word string, other string, other_n bigint")


def with_forms(words: DataFrame, near: DataFrame) -> DataFrame:
    """``words`` with their number of near words and their form, where they have one."""
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    found = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    much = -F.col("best.n") >= F.col("n") * FORM_FACTOR
    return words.join(found, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(much, F.col("best.word")).alias("form"),
        F.when(much, -F.col("best.n")).alias("form_n"),
    )


def with_roots(formed: DataFrame) -> DataFrame:
    """``formed`` with the last word that forms lead to; each round takes twice as many steps.

    Every step is to a word at least five times as frequent, so the number of rounds is known.
    """
    highest = formed.agg(F.max("n")).first()[0] or LEAST_COUNT
    steps = int(log(max(highest / LEAST_COUNT, 1), FORM_FACTOR)) + 1
    links = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(steps))):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        links = materialize(links, "links")
    joined = formed.join(links, "word", "left")
    return joined.withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", slips: int | None = 199
) -> DataFrame:
    """Frequent words with their near words, their form and the root of their forms.

    Nulls, ids and texts as in ``count_words``; repeated rows count again; no rows give none.
    Ties of near words go to the first in code-point order.
    """
    with Scratch(docs.sparkSession) as own:
        words = materialize(count_words(docs, id_column, text_column, slips), "words")
        formed = with_forms(words, near_words(words))
    formed = materialize(formed, "forms")
    own.clear()
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")


# -- the query's SQL -------------------------------------------------------------------

ORACLE_SQL = f"""
    WITH RECURSIVE runs AS (
            SELECT doc_id, translate(run, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{RUN}')) AS run FROM documents)
            WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
        coded AS (SELECT run, n, {sql.crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 199 = 0
                THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM coded)
            WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
        rests AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM rests AS a JOIN rests AS b USING (i, rest) WHERE a.word <> b.word
            UNION SELECT r.word, w.word, w.n FROM rests AS r JOIN words AS w ON r.rest = w.word
            UNION SELECT w.word, r.word, r.n FROM rests AS r JOIN words AS w ON r.rest = w.word),
        best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n
            FROM near GROUP BY word),
        formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near,
                CASE WHEN other_n >= {FORM_FACTOR} * n THEN other END AS form,
                CASE WHEN other_n >= {FORM_FACTOR} * n THEN other_n END AS form_n
            FROM words LEFT JOIN best USING (word)),
        climb AS (SELECT word, word AS at, form AS next FROM formed
            UNION ALL SELECT c.word, f.word, f.form FROM climb AS c JOIN formed AS f ON c.next = f.word)
    SELECT f.word, form, c.at AS root, n, n_near, form_n FROM formed AS f JOIN climb AS c ON f.word = c.word AND c.next IS NULL"""
