"""License scans: planted notices, phrases against plain search, and edge cases."""

import random
import re

from obslayers.llm import licenses

MIT = next(text for label, text in licenses.NOTICES if label == "mit" and len(text) > 100)
SCHEMA = "doc_id long, text string"


def scan(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    return {r.doc_id: r for r in licenses.scan_licenses(docs, **options).collect()}


def filler(pick, n):
    return " ".join(pick.choice(["alpha", "beta", "the", "of", "license", "work"]) for _ in range(n))


def plain_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = []
    for phrase, label in licenses.PHRASES:
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return len(words), places


def test_base_columns_equal_a_plain_search(spark):
    pick = random.Random(1)
    parts = ["GNU General Public License", "gnu general public", "MIT-license", "MIT", "Apache License", "Apache  License,", "CC-BY", "cc by by", "été", "x"]
    texts = [" ".join(pick.choices(parts, k=pick.randrange(12))) for _ in range(200)] + [None, "", "mit license " * 3000]
    got = scan(spark, texts)
    for i, text in enumerate(texts):
        n, places = plain_places(text)
        starts = [at for at, _ in places]
        row = got[i]
        assert (row.n_words, row.n_base) == (n, len(places))
        assert (row.first_word, row.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        base = sorted({label for _, label in places})
        assert row.base_labels == ",".join(base) and set(base) <= set(filter(None, row.labels.split(",")))


def test_edited_notices_are_found(spark):
    pick = random.Random(2)
    words = MIT.split()
    replaced = [w if i % 9 else "changed" for i, w in enumerate(words)]
    dropped = [w for i, w in enumerate(words) if i % 12]
    added = [x for i, w in enumerate(words) for x in ([w, "more"] if i % 12 == 0 else [w])]
    broken = [w if i % 2 else "changed" for i, w in enumerate(words)]
    texts = [
        f"{filler(pick, 300)} {' '.join(some)} {filler(pick, 300)}" for some in (words, replaced, dropped, added, broken, [])
    ]
    got = scan(spark, texts)
    assert [got[i].labels for i in range(6)] == ["mit", "mit", "mit", "mit", "", ""]
    assert got[0].score == 1.0 and got[5].score == 0.0 and all(got[i].n_base == 0 for i in range(6))


def test_every_share_of_replaced_words_above_the_limit_is_found(spark):
    """Whichever words are replaced: no span with 80 % of them goes by its votes."""
    pick, words = random.Random(3), MIT.split()
    texts = []
    for _ in range(40):
        gone = set(pick.sample(range(len(words)), int(len(words) * 0.19)))
        texts.append(" ".join("zzz" if i in gone else w for i, w in enumerate(words)))
    # Runs of three words only, but for a stretch that is whole.
    texts.append(" ".join("zzz" if i % 4 == 3 and i < len(words) * 0.75 else w for i, w in enumerate(words)))
    assert {r.labels for r in scan(spark, texts).values()} == {"mit"}


def test_best_notice_of_a_place(spark):
    got = scan(spark, ["Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0", "Licensed under the Apache License, Version 2.0."])
    assert [got[i].labels for i in range(3)] == ["cc-by,cc-by-nc-4.0", "cc-by,cc-by-4.0", "apache,apache-2.0"]


def test_copies_null_ids_and_own_notices(spark):
    docs = spark.createDataFrame([(None, "one two three four five"), (None, "one two three four five"), (3, "one two three")], SCHEMA)
    docs = docs.selectExpr("*", "1 AS notice", "'x' AS marks", "2 AS h1", "3 AS id")
    rows = licenses.scan_licenses(docs, notices=[("own", "one two three four")], phrases=[("three four", "34")]).collect()
    assert sorted((r.doc_id or 0, r.labels, r.n_base) for r in rows) == [(0, "34,own", 1), (0, "34,own", 1), (3, "", 0)]
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_joins_agree_without_broadcast(spark, monkeypatch):
    texts = [MIT, "Released under the MIT License.", "nothing", None]
    broadcast = scan(spark, texts)
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", 0)
    assert scan(spark, texts) == broadcast
