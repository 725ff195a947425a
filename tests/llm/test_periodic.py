"""Runs against a search of all periods."""

import random
import re

import numpy as np
import pytest

from tideline.llm.periodic import WaveletMatrix, collapsed, periodic_runs, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least=6, times=4):
    n, out = len(w), set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            part = w[i : j + q]
            if len(part) >= max(least, times * q):
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.add((i, len(part), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rng, symbols=3):
    """Words with runs of many periods, next to one another and inside one another."""
    words = []
    while len(words) < rng.randint(0, 120):
        root = [rng.randrange(symbols) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 13, 17]))]
        words += [root[i % len(root)] for i in range(rng.randint(1, 6 * len(root)))]
    return words


def test_arrays():
    rng = random.Random(3)
    total = 0
    for _ in range(400):
        docs = [made(rng, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(1, 5))]
        starts = np.cumsum([0, *map(len, docs)])
        found = runs(
            np.array(sum(docs, []), np.int64), np.repeat(np.arange(len(docs)), [*map(len, docs)]), 6, 4
        )
        due = [(int(a) + s, n, q) for d, a in zip(docs, starts) for s, n, q in brute(d)]
        assert [*map(tuple, found.tolist())] == sorted(due, key=lambda r: (r[0], r[2]))
        total += len(due)
    assert total > 500


def test_successors():
    rng = np.random.default_rng(2)
    values = rng.permutation(1000)[:700]
    low = rng.integers(0, 700, 500)
    high = np.minimum(700, low + rng.integers(0, 200, 500))
    least = rng.integers(0, 1001, 500)
    found = WaveletMatrix(values, 10).successors(low, high, least)
    for a, b, x, got in zip(low, high, least, found):
        assert got == min((v for v in values[a:b] if v >= x), default=-1)


def check(df, texts):
    rows = df.collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = WORD.findall(texts[r["doc_id"]] or "")
        due = brute(words)
        assert r["n_words"] == len(words)
        assert [tuple(x) for x in r["runs"]] == due, words[:50]
        gone = {i for s, n, q in due for i in range(s + q, s + n)}
        assert r["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)


ODD = [
    None, "", " \n\t", "a", "a a a a a", "a a a a a a", "A a A a A a A a", "x\x0by\x0cx\ry x y x y",
    "é ü é ü é ü é ü", "👍🏽 " * 9, "a b " * 7, "b" * 100_000, ("b" * 1000 + " ") * 8,
    "a b c d e f g h i j k l " * 4, "a b c d e f g h i j k l " * 3 + "a b c d e f g h i j k",
    "a a a a a a b " * 5, "the end the end the end the end. the end",
]


@pytest.mark.parametrize("size", [1, 200, 1 << 20])
def test_texts(documents, size):
    rng = random.Random(size)
    texts = ODD + [" ".join(f"w{x}" for x in made(rng)) for _ in range(60)]
    df = documents(*enumerate(texts), more="runs string, collapsed string, id string, n_words string")
    check(periodic_runs(df, slice_bytes=size), texts)


def test_whole_sample(sample):
    check(periodic_runs(sample), {r["doc_id"]: r["text"] for r in sample.collect()})


def test_very_long_texts(documents):
    texts = [
        "w " * 200_000, " ".join(str(i % 4001) for i in range(100_000)),
        " ".join(map(str, range(100_000))) + " x" * 6,
    ]
    rows = periodic_runs(documents(*enumerate(texts))).orderBy("doc_id").collect()
    assert [[tuple(x) for x in r["runs"]] for r in rows] == [
        [(0, 200_000, 1)], [(0, 100_000, 4001)], [(100_000, 6, 1)]
    ]
    assert [len(r["collapsed"].split()) for r in rows] == [1, 4001, 100_001]


def test_edges(documents):
    assert periodic_runs(documents()).count() == 0
    text = "a b " * 6
    rows = periodic_runs(documents((None, text), (1, text), (1, text), (2, None))).collect()
    assert sorted(len(r["runs"]) for r in rows) == [0, 1, 1, 1]
    assert collapsed(list("abababab"), np.array([[0, 8, 2]])) == ["a", "b"]
    with pytest.raises(ValueError, match="blocks"):
        periodic_runs(documents(), exponent=2)


def test_stronger_thresholds(documents):
    texts = ["a b " * 4, "a b " * 6, "c " * 9]
    found = periodic_runs(documents(*enumerate(texts)), min_length=10, exponent=5).collect()
    for r in found:
        assert [tuple(x) for x in r["runs"]] == brute(texts[r["doc_id"]].split(), 10, 5)
