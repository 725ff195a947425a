import random
from collections import Counter

import pytest

from tideline.llm import substrings
from tideline.llm.substrings import SuffixAutomaton, dedup_substrings


def brute(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(
        tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1)
    )
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        out.append((len(w), sum(gone), kept))
    return out


def results(df):
    rows = df.orderBy("doc_id").collect()
    return [(r["n_words"], r["n_removed"], r["kept"]) for r in rows]


def make_texts(seed, count=40, vocabulary=300):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(vocabulary)}"
    passages = [[word() for _ in range(rnd.randrange(20, 90))] for _ in range(6)]
    texts = []
    for _ in range(count):
        parts = [word() for _ in range(rnd.randrange(0, 60))]
        for _ in range(rnd.randrange(0, 3)):
            at = rnd.randrange(len(parts) + 1)
            piece = list(rnd.choice(passages))
            if rnd.random() < 0.5:
                piece[rnd.randrange(len(piece))] = "edit"
            parts[at:at] = piece
        texts.append(rnd.choice([" ", "\n", "\t "]).join(parts))
    return texts + ["same " * 80, "a b " * 50, texts[0], texts[0]]


@pytest.mark.parametrize("seed,counted", [(1, 2000), (2, 2), (3, 2000)])
def test_against_brute_force(documents, monkeypatch, seed, counted):
    monkeypatch.setattr(substrings, "COUNTED_CONTENTS", counted)
    texts = make_texts(seed)
    found = dedup_substrings(documents(*enumerate(texts)))
    assert results(found) == brute(texts, 35)


def test_small_window(documents):
    texts = ["a b c d e", "x b c d y", "a b", "b c d"]
    assert results(dedup_substrings(documents(*enumerate(texts)), window=3)) == brute(texts, 3)


@pytest.mark.parametrize("counted", [2000, 0])
def test_window_of_more_words_than_64(documents, monkeypatch, counted):
    monkeypatch.setattr(substrings, "COUNTED_CONTENTS", counted)
    words = [f"p{i}" for i in range(70)]
    swapped = [words[64], *words[1:64], words[0], *words[65:]]
    texts = [" ".join(x) for x in (words, swapped, ["x", *words, "y"], words[:65], ["z", *swapped])]
    assert results(dedup_substrings(documents(*enumerate(texts)), window=65)) == brute(texts, 65)


def test_rows_without_id_whose_32_bit_hashes_are_equal(documents):
    # The first two texts have one Spark hash of 32 bits.
    repeated = " ".join(f"p{i}" for i in range(40))
    texts = [
        f"{repeated} x28138",
        " ".join(f"q{i}" for i in range(44)) + " y93220",
        repeated,
    ]
    df = documents((None, texts[0]), (None, texts[1]), (7, texts[2]))
    same = df.selectExpr("doc_id", "hash(text) AS h").where("doc_id IS NULL")
    assert same.select("h").distinct().count() == 1
    found = [(r["n_words"], r["n_removed"], r["kept"]) for r in dedup_substrings(df).collect()]
    assert sorted(found) == sorted(brute(texts, 35))


def test_spans(documents):
    passage = " ".join(f"p{i}" for i in range(40))
    found = dedup_substrings(documents((1, f"x {passage} y"), (2, f"{passage} z")))
    rows = {r["doc_id"]: r["removed"] for r in found.collect()}
    assert [tuple(x) for x in rows[1]] == [(1, 41)]
    assert [tuple(x) for x in rows[2]] == [(0, 40)]


def test_edges(documents):
    long = " ".join(f"v{i}" for i in range(20_000))
    df = documents(
        (1, None), (2, ""), (3, " \n\t"), (4, long), (4, long), (None, "one two"),
        (None, "one two"), (6, "é" * 50), more="h string, kept string, spans string",
    )
    rows = sorted(
        [(r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in dedup_substrings(df).collect()]
    )
    assert rows == [
        (0, 2, 0), (0, 2, 0), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 20_000, 20_000),
        (4, 20_000, 20_000), (6, 1, 0),
    ]
    assert dedup_substrings(documents()).count() == 0


def test_automaton():
    rnd = random.Random(4)
    for _ in range(60):
        sequences = [
            [rnd.randrange(3) for _ in range(rnd.randrange(1, 12))] for _ in range(rnd.randrange(1, 5))
        ]
        distinct = [list(x) for x in dict.fromkeys(map(tuple, sequences))]
        automaton = SuffixAutomaton()
        for s in distinct:
            automaton.add(s, sequences.count(s))
        automaton.finish()
        counts = Counter(
            tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)
        )
        for s in distinct:
            due = [
                max((n for n in range(1, e + 1) if counts[tuple(s[e - n : e])] > 1), default=0)
                for e in range(1, len(s) + 1)
            ]
            assert list(automaton.statistics(s)) == due
