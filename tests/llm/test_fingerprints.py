"""Fingerprints against brute force over the paragraphs themselves."""

import base64
import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from obslayers.llm import fingerprints as fp

TEXTS = [
    "",
    "one line",
    "a\nb\nc\nd",
    "a\nb\nc\nd",
    "same\n" * 9 + "same",
    "\n\n \n",
    "\n".join(f"line {i}" for i in range(300)),
    "\n".join(f"line {i}" for i in range(150)) + "\n" + "\n".join(f"other {i}" for i in range(150)),
    " ".join(f"Sentence number {i} is here." for i in range(400)),
    "é漢\n" * 3,
    "odd",
]


def paragraphs(text):
    return Counter(re.findall(fp.PARAGRAPH, text))


def like(a, b):
    a, b = paragraphs(a), paragraphs(b)
    both, either = sum((a & b).values()), sum((a | b).values())
    return both / either if either else 1.0


def edited_of(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def expected(order):
    """Result rows of (id, text) in their order, without the fingerprints."""
    found = Counter()
    for (k, text), (_, following) in zip(order, [*order[1:], order[0]]):
        edited = edited_of(text, following)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        found[k, len(text), sha, round(like(text, edited), 9), round(like(text, following), 9)] += 1
    return found


def results(rows):
    return Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows)


def test_equal_brute_force(spark):
    rows = [(i * 7 - 5, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", "x"), (300, None, "x"), (-(2**63), "a\nz", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, next string").repartition(4)
    order = sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = fp.fingerprint_edits(docs).collect()
    assert results(got) == expected(order)
    by_text, text_of = {}, {i: t or "" for i, t, _ in rows}
    for r in got:
        assert by_text.setdefault(text_of[r.doc_id], r.fingerprint) == r.fingerprint
    # Texts with the same paragraphs share one, and so do those without any.
    assert len(set(by_text.values())) == len({frozenset(paragraphs(t).items()) for t in by_text})


def test_rows_that_share_an_id(spark):
    """Null ids and repeated ids follow each other; equal rows next to each other."""
    rows = [(None, f"line {i % 40}\nmore") for i in range(120)] + [(3, "a\nb"), (3, "a\nb"), (3, "c\nd"), (9, "z")]
    got = fp.fingerprint_edits(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert len(got) == len(rows)
    # Which texts follow is fixed, but not told; whole chains of equal rows are.
    for text, times in Counter(rows).items():
        sha = hashlib.sha256(edited_of(text[1], text[1]).encode()).hexdigest()
        assert sum(r.doc_id == text[0] and r.edited_sha256 == sha for r in got) >= times - 1
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((i, len(t)) for i, t in rows)
    assert sum(r.near_next == 1.0 for r in got) == 80 + 1


def test_copies_are_written_out_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(fp, "COPIES", 7)
    docs = spark.createDataFrame([(1, "a\nb")] * 30 + [(2, None)], "doc_id bigint, text string")
    assert Counter(r.doc_id for r in fp.fingerprint_edits(docs).collect()) == {1: 30, 2: 1}


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(5, "abcd")], "doc_id bigint, text string")
    row = fp.fingerprint_edits(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
    assert fp.fingerprint_edits(one.limit(0)).count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(5, "abcd"), (4, "x")], "doc_id bigint, text string")
    for name in ("h1", "own", "n", "id", "pair", "times"):
        docs = docs.withColumn(name, F.lit("?"))
    assert fp.fingerprint_edits(docs).count() == 2


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_successors(spark, partitions):
    ids = [(5, 1), (3, 1), (3, 2), (-4, 1), (100, 1), (None, 7), (None, 2), (2**63 - 1, 0), (-(2**63), 0)]
    rows = spark.createDataFrame([(i, h, -h) for i, h in ids], "id bigint, h1 bigint, h2 bigint")
    got = {(r.id, r.h1): (r.next1, r.next2) for r in fp.successors(rows, partitions).collect()}
    order = sorted(ids, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert got == {x: (n[1], -n[1]) for x, n in zip(order, [*order[1:], order[0]])}


def pair_frame(spark, pairs):
    df = spark.createDataFrame([(i, 1, a, b) for i, (a, b) in enumerate(pairs)], "pair bigint, start int, a string, b string")
    hashes = [fp.paragraph_hashes(F.col(c)).alias(name) for c, name in (("a", "first"), ("b", "second"))]
    return df.select("pair", "start", *hashes)


def likenesses(spark, pairs):
    frame = pair_frame(spark, pairs)
    near = fp.likeness(F.size("first"), F.size("second"), F.coalesce("apart", F.lit(0)))
    rows = frame.join(fp.apart(frame), "pair", "left").select("pair", near.alias("near")).collect()
    return {r.pair: r.near for r in rows}


def test_half_equal_lines_share_digests(spark):
    lines = ["word " * 700, "x" * 1000, "漢字" * 200, ", ".join(f"item{i}" for i in range(300)), "漢字。" * 100]
    pairs = [(t, t[: len(t) // 2] + "other " * 50) for t in lines]
    pairs += [(t, t[: len(t) // 2] + "!" + t[len(t) // 2 + 1 :]) for t in lines]
    near = likenesses(spark, pairs)
    for i, (a, b) in enumerate(pairs):
        assert near[i] == pytest.approx(like(a, b)) and near[i] > 0


@pytest.mark.parametrize("rounds, tries", [(9, (1, 4, 32)), (1, (1,)), (0, (1, 2))])
def test_every_way_gives_the_same(spark, monkeypatch, rounds, tries):
    """Recovered at once, after larger tables, or by the digests themselves."""
    monkeypatch.setattr(fp, "ROUNDS", rounds)
    monkeypatch.setattr(fp, "TRIES", tries)
    pairs = [("\n".join(f"{i} {j}" for j in range(i)), "\n".join(f"{i} {j}" for j in range(i // 2, i + 9))) for i in range(60)]
    pairs += [("", ""), ("a", ""), ("", "b\nc"), ("a\na\na", "a")]
    near = likenesses(spark, pairs)
    assert all(near[i] == pytest.approx(like(a, b)) for i, (a, b) in enumerate(pairs))


def parsed(fingerprint):
    """Size of a third, and the cells by number."""
    third, _, rest = fingerprint.partition(" ")
    cells = {}
    for word in rest.split():
        place, _, digest = word.partition(":")
        cell, _, n = place.partition("*")
        cells[int(cell)] = (int(n or 1), int.from_bytes(base64.b64decode(digest + "="), "big"))
    return int(third), cells


def test_fingerprints_hold_the_cells_that_are_subtracted(spark):
    """Cells of the difference, unpeeled, are those of the two fingerprints subtracted."""
    a, b = "\n".join(f"line {i}" for i in range(50)), "\n".join(f"line {i}" for i in range(20, 70))
    texts = spark.createDataFrame([(0, a), (1, b)], "t int, text string")
    texts = texts.withColumn("hashes", fp.paragraph_hashes(F.col("text")))
    (third, first), (third_b, second) = (parsed(r.fingerprint) for r in fp.fingerprints(texts, ["t"]).orderBy("t").collect())
    assert third == third_b == 32
    subtracted = {}
    for cell in first.keys() | second.keys():
        (n, x), (m, y) = first.get(cell, (0, 0)), second.get(cell, (0, 0))
        if (n, x) != (m, y):
            subtracted[cell] = (n - m, x ^ y)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(fp, "ROUNDS", 0)
        rows = fp.differences(pair_frame(spark, [(a, b)])).collect()
    assert {r.cell: (r.n, r.digest % 2**64) for r in rows} == subtracted
    peeled = fp.differences(pair_frame(spark, [(a, b)])).collect()
    assert Counter(r.n for r in peeled if r.cell < 0) == {1: 20, -1: 20} and all(r.cell < 0 for r in peeled)


def test_fingerprints_are_well_below_the_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = fp.fingerprint_edits(docs).agg(F.sum("n_chars").alias("text"), F.sum(F.length("fingerprint")).alias("print")).first()
    assert rows.print < 0.5 * rows.text


def test_rounds_need_no_exchange(spark):
    plan = fp.differences(pair_frame(spark, [("a", "b")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
