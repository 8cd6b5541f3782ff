"""The manifest against one built over sorted lists."""

import collections
import hashlib
import random
import zlib

import duckdb
import pytest

from obslayers.llm import merkle
from obslayers.llm.sql import crc32

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest(*found[-1][i : i + 8]) for i in range(0, len(found[-1]), 8)])
    return found


def leaf_text(row):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def plain(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        text = row[4]
        if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        groups[row[2]].append((row[0], digest(leaf_text(row)), digest(leaf_text((*row[:4], text)))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[name] = levels([x[1] for x in groups[name]])
    upper, out = levels([trees[name][-1][0] for name in names]), []
    for k, name in enumerate(names):
        for i, (doc_id, leaf, node) in enumerate(groups[name]):
            others = []
            for tree, at in ((trees[name], i), (upper, k)):
                for nodes in tree[:-1]:
                    run, own = nodes[at - at % 8 : at - at % 8 + 8], at % 8
                    others += run[:own] + run[own + 1 :]
                    node = digest(*run[:own], node, *run[own + 1 :])
                    at //= 8
            root = upper[-1][0]
            out.append((doc_id, leaf, trees[name][-1][0], root, digest(*others), node, node == root))
    return out


def key(row):
    return tuple((x is not None, str(x)) for x in row)


def check(spark, rows):
    got = merkle.tamper_check(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain(rows), key=key)


def test_nulls_ties_and_far_ids(spark):
    pick = random.Random(1)
    ids = [None, None, 5, 5, -7, 2**63 - 1, -(2**63)]
    langs = [None, "", "é", "z", *[f"l{i}" for i in range(20)]]
    texts = [None, "", "Ab", "ab", "é Q"]
    rows = []
    for _ in range(1500):
        doc_id = pick.choice([*ids, pick.randrange(-(2**63), 2**63), pick.randrange(1000)])
        rows.append((doc_id, pick.choice([None, "s"]), pick.choice(langs), pick.choice([None, 3]), pick.choice(texts)))
    check(spark, rows)


def test_many_blocks(spark):
    check(spark, [(i * 3, "s", "x" if i % 10 else "y", 1, f"T{i}") for i in range(40_000)])


def test_crowded_ids(spark, monkeypatch):
    monkeypatch.setattr(merkle, "CROWDED", 500)
    check(spark, [(i % 900 if i % 3 else None, "s", "x", 1, "T" if i % 7 else f"U{i}") for i in range(12_000)])


@pytest.mark.parametrize("n", [0, 1])
def test_small_tables(spark, n):
    check(spark, [(4, None, None, None, None)] * n)


def test_clashing_columns(spark):
    rows = [(i, "s", "x", 1, "T") for i in range(3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("leaf", "g", "place", "root"):
        docs = docs.selectExpr("*", f"'a' AS {name}")
    assert sorted(map(tuple, merkle.tamper_check(docs).collect())) == sorted(plain(rows))


def test_sql_agrees_where_rows_tie(spark):
    pick = random.Random(2)
    rows = [(pick.choice([None, 1, 2, pick.randrange(200)]), "s", pick.choice([None, "a", "b"]), 1, "T") for _ in range(900)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, lang VARCHAR, n_chars BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert sorted(con.execute(merkle.ORACLE_SQL).fetchall(), key=key) == sorted(plain(rows), key=key)


def test_sql_crc():
    texts = ["", "12", "é1:abc", "漢字" * 20]
    con = duckdb.connect()
    assert [con.execute(f"SELECT {crc32('?1')}", [t]).fetchone()[0] for t in texts] == [zlib.crc32(t.encode()) for t in texts]
