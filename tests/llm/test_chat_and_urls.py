"""Perspective rotation and URL filters against plain Python."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from obslayers.llm import chat_rotation as chat
from obslayers.llm import url_filters as urls


def rendered(turns, perspective):
    out, spans = "", []
    for _, role, text in turns:
        head = "system" if role == "system" else "assistant" if role == perspective else f"user name={role}"
        out += f"{chat.BEGIN}{head}\n"
        begin = len(out)
        out += text + chat.END
        if role == perspective:
            spans.append((begin, len(out)))
    return out, spans


def test_rotation_equals_plain_python(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "é漢\n"), (1, 3, "cy", ""), (1, 4, "ann", "x" * 5000),
        (2, 0, "ann", "alone"), (2, 0, "ann", "alone"), (3, 0, "system", "no one"), (4, 5, None, None), (4, 2, "bob", "b"),
        (None, 1, "ann", "q"), (None, None, "bob", "r"), (5, 1, "bob", "tie b"), (5, 1, "ann", "tie a"),
    ]
    rows += [(6, i * 1000, f"s{i % 2}", f"t{i}") for i in range(600)]
    rows += [(7, None, "ann", f"t{i % 300}") for i in range(700)] + [(8, 1, "ann", "same")] * 700
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, part string")
    got = {(r.conv_id, r.perspective, r.part): r for r in chat.rotate(df.repartition(3)).collect()}
    expected = {}
    plain = [(c, t, r or chat.NAMELESS, x or "") for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in plain if r[0] == conv), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        for who in {t[1] for t in turns} - {"system"}:
            for begin in range(0, len(turns), chat.PART_TURNS):
                expected[conv, who, begin // chat.PART_TURNS] = rendered(turns[begin : begin + chat.PART_TURNS], who)
    assert got.keys() == expected.keys()
    for key, (text, spans) in expected.items():
        assert got[key].rendered == text and [tuple(s) for s in got[key].spans] == spans
        assert "".join(text[a:b] for a, b in spans) == "".join(got[key].rendered[s.begin : s.end] for s in got[key].spans)
    assert chat.rotate(df.limit(0)).count() == 0


def test_no_conversation_makes_a_long_row(spark, monkeypatch):
    monkeypatch.setattr(chat, "COPIES", 100)
    rows = [(None, None, f"s{i % 3}", f"t{i // 2}" if i % 5 else "same") for i in range(20_000)]
    got = chat.rotate(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(7))
    parts = got.select("perspective", "part", "n_messages").collect()
    assert len(parts) == 3 * 79 and {p.n_messages for p in parts} == {256, 20_000 % 256}
    assert sum(p.n_messages for p in parts) == 3 * 20_000
    assert sorted(p.part for p in parts) == sorted(list(range(79)) * 3)


def test_parts_of_another_size(spark):
    df = spark.createDataFrame([(1, i, "a", str(i)) for i in range(5)], "conv_id bigint, turn bigint, role string, text string")
    assert [r.n_messages for r in chat.rotate(df, part_turns=2).orderBy("part").collect()] == [2, 2, 1]


def test_sql_agrees_with_nulls_and_ties(spark):
    rows = [(c, t, r, x) for c in (None, 1) for t in (None, 0, 0) for r in (None, "a", "system") for x in (None, "q")] * 30
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["begin"], s["end"])), " ")
    got = [tuple(r) for r in chat.rotate(df).withColumn("spans", spans).collect()]
    assert sorted(got, key=repr) == sorted(con.execute(chat.ORACLE_SQL).fetchall(), key=repr)


def test_filters_with_clashing_names(spark):
    caps = spark.createDataFrame([("http://a.org", dt.datetime(2024, 5, 5))], "url string, fetched_at timestamp")
    plain = [(r.list_pattern, r.list_action, r.blocked) for r in urls.judge_captures(caps, listing(spark)).collect()]
    others = ["u", "d", "best", "month", "since", "action", "list_pattern", "list_action", "blocked"]
    for name in others:
        caps = caps.withColumn(name, F.lit("x"))
    judged = urls.judge_captures(caps, listing(spark))
    assert judged.columns == ["url", "fetched_at", "u", "d", "best", "month", "since", "action", *urls.RESULT]
    assert [(r.list_pattern, r.list_action, r.blocked) for r in judged.collect()] == plain == [("a.org", "block", True)]
    assert judged.first().u == "x"


def listing(spark):
    return spark.createDataFrame([("a.org", "block", dt.date(2024, 1, 1))], "pattern string, action string, listed_on date")


def test_filters_equal_plain_python(spark):
    day = dt.date.fromisoformat
    entries = [
        ("a.org", "block", day("2024-01-10")), ("a.org", "remove", day("2024-02-01")), ("a.org", "block", day("2024-05-01")),
        ("x.a.org", "allow", day("2024-01-15")), ("a.org/p/q", "block", day("2024-01-01")), ("a.org/p", "allow", day("2024-01-01")),
        ("org", "block", day("2025-01-01")), ("b.org", "allow", day("2024-01-01")), ("b.org", "block", day("2024-01-01")),
        (None, "block", day("2024-01-01")), ("c.org", None, day("2024-01-01")), ("c.org", "block", None), ("a.org", "block", day("2024-01-10")),
    ]
    names = ["http://A.org/", "https://x.a.org/z?q=1", "http://u:p@a.org:80/p/q/r#f", "http://a.org/p", "http://b.org", "ftp://c.org/x", "no url", "", None, "http://xa.org/"]
    days = [None, *(dt.datetime.fromisoformat(x) for x in ("2023-12-31T23:59:59", "2024-01-10T00:00:00", "2024-01-31T23:59:59", "2024-02-01T00:00:00", "2024-06-01T12:00:00"))]
    captures = [(i, u, t, "x") for i, (u, t) in enumerate((u, t) for u in names for t in days)]
    captures += captures[:9]
    caps = spark.createDataFrame(captures, "page_id bigint, url string, fetched_at timestamp, pattern string")
    listed = spark.createDataFrame([(*e, 1) for e in entries], "pattern string, action string, listed_on date, month int")
    keys = {
        "http://A.org/": ["a.org", "org"], "https://x.a.org/z?q=1": ["x.a.org/z", "x.a.org", "a.org", "org"],
        "http://u:p@a.org:80/p/q/r#f": ["a.org/p/q/r", "a.org/p/q", "a.org/p", "a.org", "org"], "http://a.org/p": ["a.org/p", "a.org", "org"],
        "http://b.org": ["b.org", "org"], "ftp://c.org/x": ["c.org/x", "c.org", "org"], "http://xa.org/": ["xa.org", "org"],
    }
    expected = []
    for i, url, at, _ in captures:
        found = None
        for pattern in keys.get(url, []) if at else []:
            history = sorted((d, a) for p, a, d in entries if p == pattern and a and d and d <= at.date())
            if history and history[-1][1] != "remove":
                found = (pattern, history[-1][1])
                break
        expected.append((i, found and found[0], found and found[1], bool(found and found[1] == "block")))
    got = urls.judge_captures(caps, listed).collect()
    assert sorted(map(repr, expected)) == sorted(repr((r.page_id, r.list_pattern, r.list_action, r.blocked)) for r in got)
    assert urls.judge_captures(caps.limit(0), listed).count() == 0
    assert not any(r.blocked for r in urls.judge_captures(caps, listed.limit(0)).collect())
