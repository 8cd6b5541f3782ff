"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from obslayers.llm import spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if v != w and one_edit(w, v)] for w in words}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None))
    return out


def check(spark, rows):
    got = spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows))


def words(pick, n):
    made = {"".join(pick.choice("abé") for _ in range(pick.choice([6, 7, 7, 8]))) for _ in range(n)}
    return sorted(made)


def test_near_words_forms_and_roots(spark):
    pick = random.Random(3)
    some = words(pick, 300)
    rows = [(i if i % 9 else None, " ".join(pick.choices(some, [5 ** (k % 5) for k in range(len(some))], k=400))) for i in range(120)]
    rows += [(7, None), (8, ""), (9, "12 ×÷À !")] + [(10, "Same words Everywhere " * 3)] * 4
    check(spark, rows)


def test_crowded_cells_are_searched_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SEARCH_POINTS", 20)
    monkeypatch.setattr(spelling, "SEARCH_QUERIES", 30)
    monkeypatch.setattr(spelling, "CELL_POINTS", 50)
    monkeypatch.setattr(spelling, "LEAST_SAMPLE", 4)
    pick = random.Random(4)
    some = words(pick, 400)
    check(spark, [(i, " ".join(some)) for i in range(6)])


def test_long_words_and_no_words(spark):
    long = "ab" * 40
    check(spark, [(1, f"{long} {long}c abcdef {'a' * 64} {'a' * 65} " * 5)])
    check(spark, [(1, "few"), (2, None)])
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "letters " * 5, 1, "x")], "doc_id long, text string, n long, word string")
    assert [tuple(r) for r in spelling.spelling_variants(docs).collect()] == [("letters", None, "letters", 5, 0, None)]


def test_trees_reach_every_near_point():
    pick = random.Random(5)
    points = sorted({"".join(pick.choice("abcdefgh") for _ in range(7)) for _ in range(3000)})
    queries = sorted({"".join(pick.choice("abcdefgh") for _ in range(6)) for _ in range(300)})
    q, p = spelling.near_pairs(queries, points, True)
    expected = {(a, b) for a in queries for b in points if one_edit(a, b)}
    assert {(queries[i], points[j]) for i, j in zip(q, p)} == expected and len(q) == len(expected)
    q, p = spelling.near_pairs(points[:200], points, False)
    expected = {(a, b) for a in points[:200] for b in points if a != b and one_edit(a, b)}
    assert {(points[i], points[j]) for i, j in zip(q, p)} == expected and len(q) == len(expected)


def test_same_counts_make_one_cell():
    tree = spelling.KdTree(np.zeros((500, spelling.DIMENSIONS), np.int8), 48)
    assert len(tree.members) == 1 and len(tree.members[0]) == 500
