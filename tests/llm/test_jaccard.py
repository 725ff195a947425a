import random

import numpy as np
import pytest
from near_copies import brute, groups, shingle_set

from tideline.llm.components import components
from tideline.llm import jaccard
from tideline.llm.jaccard import (
    common_bit, decode_run, encode_run, enough_left, frequent, jaccard_join, level_of, most_shared,
    one_of_each, prefix, prefix_length, shingles, signature,
)

def make_rows(seed, count=80, vocabulary=60):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefXYZ") + str(rnd.randrange(vocabulary))
    line = [word() for _ in range(9)]
    texts = []
    for _ in range(count):
        if texts and rnd.random() < 0.6:
            words = rnd.choice(texts).split()
            for _ in range(rnd.randrange(0, 4)):
                if words:
                    words[rnd.randrange(len(words))] = word()
            texts.append(rnd.choice([" ", "\n"]).join(words))
        else:
            texts.append(" ".join([word() for _ in range(rnd.randrange(0, 80))] + line))
    return [(3 * i % 251, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(documents, seed):
    rows = make_rows(seed)
    found = {r["doc_id"]: r for r in jaccard_join(documents(*rows)).collect()}
    due = brute(rows)
    assert {i: r["component_id"] for i, r in found.items()} == due
    for i, t in rows:
        assert found[i]["n_shingles"] == len(shingle_set(t))


def test_edges(documents):
    long = " ".join(f"v{i}" for i in range(20_000))
    rows = [
        (9, None), (8, ""), (7, " \n"), (6, "one two"), (5, "ONE two"), (4, "É x"), (3, "é x"),
        (2, long), (1, long + " tail"), (None, long), (12, "a b c d e f"), (12, "one two"),
        (11, "a b c d e f"), (11, "a b c d e f"),
    ]
    df = documents(*rows, more="id string, n string, key string, component_id string")
    found = jaccard_join(df).collect()
    assert len(found) == len(rows)
    got = {(r["doc_id"], r["component_id"]) for r in found}
    # The document 12 has two rows, which make one of the groups of 5 and of 11.
    assert got == {
        (9, 9), (8, 8), (7, 7), (6, 5), (5, 5), (4, 4), (3, 3), (2, 1), (1, 1), (None, None),
        (12, 5), (11, 5),
    }
    kept = one_of_each(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {9, 8, 7, 5, 4, 3, 1, None}
    assert jaccard_join(documents()).count() == 0


def test_prefix_length():
    # A pair of that similarity shares at least this many tokens of the larger set.
    assert [prefix_length(n, 75) for n in (0, 1, 4, 5, 100)] == [0, 1, 2, 2, 26]


def test_signatures_never_say_too_little():
    rnd = np.random.default_rng(8)
    for n, m, both in ((1, 1, 0), (5, 5, 3), (400, 300, 250), (2000, 40, 40), (900, 1000, 870)):
        pool = rnd.integers(0, 1 << 63, n + m - both).astype(np.uint64)
        a, b = pool[:n], pool[n - both :]
        assert min(n, m) >= most_shared(signature(a), signature(b), n, m) >= both


def test_runs_of_tokens():
    rnd = np.random.default_rng(3)
    for high, count in ((1 << 40, 5), (1 << 40, 1), (1 << 30, 5000), (50, 400), (1 << 40, 90_000)):
        short = np.sort(rnd.integers(0, high, count).astype(np.uint64))
        tokens, counts = decode_run(*encode_run(short))
        due = np.unique(short, return_counts=True)
        assert (tokens == due[0]).all() and (counts == due[1]).all()


def test_frequent_tokens_are_counted_exactly(documents, monkeypatch):
    """Over several runs a task, and ranges; a token counts once a document."""
    monkeypatch.setattr(jaccard, "LEAST", 3)
    monkeypatch.setattr(jaccard, "RUN_TOKENS", 64)
    rows = make_rows(7) + [(900 + i, "one two three four five six " * 3) for i in range(9)]
    sets = [shingles((t or "").encode()) for _, t in rows]
    tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
    short, levels = frequent(documents(*rows), 5)
    due = {int(t) >> 24: int(np.log2(n)) for t, n in zip(tokens, counts) if n >= 3}
    assert dict(zip(short.tolist(), levels.tolist())) == due
    assert level_of(tokens, (short, levels)).tolist() == [due.get(int(t) >> 24, 0) for t in tokens]
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    assert len(frequent(documents(*rows), 5)[0]) == 2


def test_any_order_finds_similar_sets():
    rnd = np.random.default_rng(5)
    pool = rnd.integers(0, 1 << 63, 400).astype(np.uint64)
    known = (np.sort(pool[:300] >> np.uint64(24)), rnd.integers(4, 9, 300).astype(np.uint8))
    for _ in range(200):
        a = np.unique(rnd.choice(pool, 60))
        b = np.unique(np.concatenate([a[rnd.random(len(a)) < 0.9], rnd.choice(pool, 3)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        for order in range(3):
            p, q = (prefix(x, level_of(x, known), order, 75) for x in (a, b))
            assert len(np.intersect1d(p, q)) and common_bit(signature(p), signature(q))


def test_passage_that_many_share(documents):
    """Documents around the similarity, which differ in how much they have besides a passage."""
    rnd = random.Random(12)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(120):
        own = [f"o{i}x{j}" for j in range(rnd.randrange(0, 22))]
        at = rnd.randrange(len(own) + 1)
        rows.append((i + 1, " ".join(own[:at] + passage + own[at:])))
    found = jaccard_join(documents(*rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute(rows)


def test_places_never_hide_similar_sets(spark):
    """What is left from the first common token on is enough wherever sets are similar."""
    rnd = np.random.default_rng(11)
    pool = rnd.integers(0, 1 << 63, 500).astype(np.uint64)
    known = (np.sort(pool[:300] >> np.uint64(24)), rnd.integers(4, 9, 300).astype(np.uint8))
    rows = []
    for _ in range(300):
        a = np.unique(rnd.choice(pool, 80))
        b = np.unique(np.concatenate([a[rnd.random(len(a)) < 0.9], rnd.choice(pool, 4)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        p, q = (prefix(x, level_of(x, known), 0, 75).tolist() for x in (a, b))
        i = next(k for k, t in enumerate(p) if t in q)
        assert [t for t in p if t in q] == [t for t in q if t in p]
        rows.append((len(a), len(b), i, q.index(p[i])))
    assert len(rows) > 50
    df = spark.createDataFrame(rows, "n int, m int, i int, j int")
    assert df.where(enough_left(75)).count() == len(rows)
    # Ten common tokens at the end of twenty are too few, and so are sizes too far apart.
    none = [(20, 20, 10, 10), (20, 20, 3, 0), (20, 14, 0, 0)]
    assert spark.createDataFrame(none, df.schema).where(enough_left(75)).count() == 0


def test_components(spark):
    rnd = random.Random(6)
    links = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)]
    links += [(i, i + 1) for i in range(300, 420)] + [(500, x) for x in range(501, 540)]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {(r["node"], r["component"]) for r in found} == set(groups(nodes, links).items())
    assert len(found) == len(nodes)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
