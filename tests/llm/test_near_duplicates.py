"""Near duplicates against brute force over all pairs."""

import itertools
import random

import numpy as np
import pytest

from obslayers.llm import near_duplicates as nd
from obslayers.llm.shingles import shingles, word_hashes


def plain_shingles(text):
    words = text.split()
    return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def similarity(a, b, weights):
    return nd.similarities([a], [b], weights)[0]


def groups(n, pairs):
    root = list(range(n))
    for a, b in pairs:
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        root[max(a, b)] = min(a, b)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    return [find(i) for i in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(words) for _ in range(60)]
    out = ["", " \n", "short one", "short one", "short two"]
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([20, 80, 300]))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.choice([1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    return out


def test_shingles_equal_sets(texts):
    found = shingles(texts)
    for i, text in enumerate(texts):
        own = plain_shingles(text)
        assert (found.text == i).sum() == len(set(own))
        assert found.count[found.text == i].sum() == len(own)
    assert len(shingles([]).hash) == 0 and len(shingles([""]).hash) == 0
    hashes, owner = word_hashes(["a b", "", "b a"])
    assert owner.tolist() == [0, 0, 2, 2] and hashes[0] == hashes[3] != hashes[1] == hashes[2]


def test_unit_weights_give_plain_jaccard(texts):
    level = np.zeros(1 << nd.SKETCH_BITS, np.uint8)
    for a, b in itertools.islice(itertools.combinations([t for t in texts if len(set(plain_shingles(t))) == len(plain_shingles(t))], 2), 300):
        x, y = set(plain_shingles(a)), set(plain_shingles(b))
        assert similarity(a, b, level) == pytest.approx(len(x & y) / max(len(x | y), 1))


def test_samples_agree_as_often_as_texts_are_similar():
    rng = random.Random(5)
    level = np.random.default_rng(1).integers(0, 256, 1 << nd.SKETCH_BITS).astype(np.uint8)
    off = []
    for _ in range(60):
        base = [f"w{rng.randrange(500)}" for _ in range(200)]
        copy = list(base)
        for _ in range(rng.randrange(12)):
            copy[rng.randrange(200)] = "other"
        pair = [" ".join(base), " ".join(copy)]
        found = shingles(pair)
        _, samples = nd.consistent_samples(found, nd.weighted(found, level), 48)
        off.append((samples[0] == samples[1]).mean() - similarity(*pair, level))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.09


def test_classes_equal_brute_force(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(900, None, "x"), (2, "short one", "x"), (None, texts[7], "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, node string").repartition(5)
    weights = nd.shingle_weights(docs)
    pairs = [
        (a, b)
        for a, b in itertools.combinations(range(len(texts)), 2)
        if plain_shingles(texts[a]) and plain_shingles(texts[b]) and similarity(texts[a], texts[b], weights) >= nd.THRESHOLD
    ]
    expected = groups(len(texts), pairs)
    got = nd.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id == 900:
            assert (r.class_id, r.n_links, r.node) == (900, 0, None)
        else:
            assert r.class_id == expected[texts.index(texts[7]) if r.doc_id is None else r.doc_id]
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({*expected, 900})


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert nd.near_duplicates(docs).count() == 0 and nd.keep_one(docs).count() == 0


def test_components_of_a_path(spark):
    names = random.Random(1).sample(range(-1000, 1000), 61)
    edges = [*zip(names, names[1:]), (5000, 5001), (5001, 5000)]
    got = {r.node: r.root for r in nd.components(spark.createDataFrame(edges, "leader bigint, node bigint")).collect()}
    assert len(got) == 63 and got[5000] == 5000 and {got[n] for n in names} == {min(names)} and got[5001] == 5000


def test_every_class_keeps_a_row_whatever_its_ids(spark):
    rng = random.Random(7)
    apart = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(30)) for _ in range(9)]
    near = apart[5] + " one more"
    rows = [(None, t) for t in apart[:4]] + [(1, apart[4]), (1, apart[5]), (None, near), (2, apart[6]), (None, apart[6]), (3, apart[7]), (3, apart[7] + " end"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = [(r.doc_id, r.text) for r in nd.keep_one(docs).collect()]
    last = [r for r in kept if r[0] == 3]
    assert len(last) == 1 and last[0] in rows
    expected = [(None, t) for t in apart[:4]] + [(1, apart[4]), (1, apart[5]), (2, apart[6]), (None, None)]
    assert sorted(map(repr, set(kept) - set(last))) == sorted(map(repr, expected)) and len(kept) == 9


def test_links_and_chains_of_hot_buckets_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_MEMBERS", 16)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(5000)]
    passage = [rng.choice(words) for _ in range(150)]
    out = []
    for _ in range(60):  # a passage that all share, below the threshold
        out.append(passage + [rng.choice(words) for _ in range(100)])
    for text in out[:10]:  # links in the same buckets
        out.append([*text[:-1], "end"])
    for _ in range(30):  # a chain of copies
        copy = list(out[-1])
        for _ in range(2):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        out.append(copy)
    out += [[*out[70], f"n{i}"] for i in range(40)]
    texts = [" ".join(t) for t in out]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    weights = nd.shingle_weights(docs)
    every = list(itertools.combinations(range(len(texts)), 2))
    alike = nd.similarities([texts[a] for a, _ in every], [texts[b] for _, b in every], weights)
    left, right = (np.array(x) for x in zip(*every))
    assert np.array_equal(nd.pair_similarities(texts, left, right, weights), alike)
    pairs = [p for p, x in zip(every, alike) if x >= nd.THRESHOLD]
    expected = groups(len(texts), pairs)
    got = {r.doc_id: r for r in nd.near_duplicates(docs).collect()}
    assert [got[i].class_id for i in range(len(texts))] == expected
    degrees = [sum(i in p for p in pairs) for i in range(len(texts))]
    # Bands miss two in a thousand of those at the very threshold.
    assert sum(abs(got[i].n_links - n) for i, n in enumerate(degrees)) <= 0.004 * sum(degrees)


def near_copies(n, seed=13):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(150)]
    return [" ".join([*base[: (at := rng.randrange(150))], f"n{i}", *base[at + 1 :]]) for i in range(n)]


def written_of(spark, texts, monkeypatch):
    """Rows that go into tiles, and rows of every table written on the way."""
    tiled, written = [], []
    drawn, keep = nd.candidates, nd.materialize

    def counted(members, threshold):
        tiled.append(members.count())
        return drawn(members, threshold)

    def kept(df, purpose):
        out = keep(df, purpose)
        written.append(out.count())
        return out

    monkeypatch.setattr(nd, "candidates", counted)
    monkeypatch.setattr(nd, "materialize", kept)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    rows = nd.near_duplicates(docs).collect()
    monkeypatch.undo()
    return tiled[0], max(written), rows


def test_rows_of_a_group_of_near_copies_grow_in_proportion(spark, monkeypatch):
    few, many = (written_of(spark, near_copies(n), monkeypatch) for n in (500, 2000))
    assert many[0] <= 4.5 * few[0]
    for tiled, written, rows in (few, many):
        # Once for each band at most, whatever the number of its partners; in how many bands a text has
        # a partner of its own rises slowly with the group.
        assert written <= tiled <= nd.BANDS * len(rows)
        assert {r.class_id for r in rows} == {0} and min(r.n_links for r in rows) > 0.99 * (len(rows) - 1)


def test_blocks_follow_the_length_of_texts(spark, monkeypatch):
    rng = random.Random(17)
    base = [f"w{rng.randrange(9000)}" for _ in range(20000)]
    texts = [" ".join([*base, f"n{i}"]) for i in range(12)] + near_copies(40)
    one = written_of(spark, texts, monkeypatch)
    monkeypatch.setattr(nd, "BLOCK_CHARS", 1 << 18)
    several = written_of(spark, texts, monkeypatch)
    assert several[0] > one[0] and sorted(several[2]) == sorted(one[2])
    assert {r.class_id for r in one[2] if r.doc_id < 12} == {0}


@pytest.mark.parametrize("laid_out, stretch", [(2, 64), (2, 1 << 17), (10**9, 64)])
def test_similarities_are_the_same_by_either_way(texts, monkeypatch, laid_out, stretch):
    monkeypatch.setattr(nd, "LAID_OUT", laid_out)
    monkeypatch.setattr(nd, "COMPARED_SHINGLES", stretch)
    own = [t for t in texts if t.split()]
    weights = np.random.default_rng(2).integers(0, 256, 1 << nd.SKETCH_BITS).astype(np.uint8)
    pairs = [p for p in itertools.combinations(range(len(own)), 2) if p[0] % 3 or p[1] % 7 == 0]
    left, right = (np.array(x) for x in zip(*pairs))
    expected = nd.similarities([own[a] for a in left], [own[b] for b in right], weights)
    assert np.array_equal(nd.pair_similarities(own, left, right, weights), expected)
    assert len(nd.pair_similarities(own, left[:0], right[:0], weights)) == 0
