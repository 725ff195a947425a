"""Trees against an exhaustive search for splits, a walk node by node, and held-out labels."""

import math
import zlib

import numpy as np
import pytest

from tideline.llm.boosting import FEATURES, bin_edges, fit, score_quality, statistics, train

WORDS = [f"w{i}" for i in range(40)]


@pytest.fixture
def labels(spark):
    return lambda *rows: spark.createDataFrame(
        list(rows), "doc_id bigint, quality int, toxic int"
    )


def plain(i):
    return " ".join(WORDS[(i * 7 + k * k) % 40] for k in range(80)) + "."


def junk(i):
    return " | ".join(WORDS[(i + k) % 40].upper() + "!!" for k in range(60))


def brute_fit(rows, good, trees, depth, rate, shrink, least):
    """Margins of Newton boosting with every threshold between two values tried."""
    base = math.log((good.sum() + 1) / (len(good) - good.sum() + 1))
    margins = np.full(len(rows), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margins))
        g, h = p - good, p * (1 - p)
        parts = [np.arange(len(rows))]
        for _ in range(depth):
            split = []
            for part in parts:
                best = (1e-9, None)
                for f in range(rows.shape[1]):
                    values = np.unique(rows[:, f])
                    for t in values[:-1] + np.diff(values) / 2:
                        low = part[rows[part, f] <= t]
                        high = part[rows[part, f] > t]
                        if h[low].sum() < least or h[high].sum() < least:
                            continue
                        score = sum(g[s].sum() ** 2 / (h[s].sum() + shrink) for s in (low, high))
                        gain = score - g[part].sum() ** 2 / (h[part].sum() + shrink)
                        if gain > best[0] + 1e-12:
                            best = (gain, (low, high))
                split += best[1] or (part, part[:0])
            parts = split
        for part in parts:
            if len(part):
                margins[part] += -rate * g[part].sum() / (h[part].sum() + shrink)
    return margins


def test_against_exhaustive_splits():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(120, 4)).round(2)
    good = ((rows[:, 0] > 0.2) ^ (rows[:, 2] > 0.5)).astype(float)
    found = fit(rows, good, trees=6, depth=3, rate=0.3, shrink=1.0, least=1.0)
    due = brute_fit(rows, good, 6, 3, 0.3, 1.0, 1.0)
    assert np.allclose(found.margins(rows), due, atol=1e-9)
    assert ((found.scores(rows) >= 0.5) == (good == 1)).mean() > 0.9


def test_flat_arrays_against_a_walk():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(5000, 3))
    good = (rows.sum(axis=1) + rng.normal(size=5000) > 0).astype(float)
    model = fit(rows, good, trees=9, depth=4)
    new = rng.normal(size=(300, 3)) * 2
    for row, margin in zip(new, model.margins(new)):
        due = model.base
        for t in range(9):
            node = 0
            while node < 15:
                node = 2 * node + (2 if row[model.feature[t, node]] > model.threshold[t, node] else 1)
            due += model.value[t, node - 15]
        assert math.isclose(margin, due, abs_tol=1e-12)


def test_bins():
    many = np.random.default_rng(1).normal(size=(10_000, 1))
    edges = bin_edges(many, 16)[0]
    assert len(edges) == 15
    sizes = np.bincount(np.searchsorted(edges, many[:, 0]))
    assert sizes.min() > 250
    assert bin_edges(np.array([[1.0], [1.0], [3.0]]))[0].tolist() == [2.0]


def test_statistics():
    found = dict(zip(FEATURES, statistics(b"Aa bb. Aa bb.\n\nAa bb.\nAa bb. 7|")))
    assert found["words"] == math.log1p(9) and found["lines"] == math.log1p(3)
    assert found["short_lines"] == 1 and found["dup_lines"] == 0
    assert found["distinct_words"] == 3 / 9 and found["top_word"] == 4 / 9
    assert found["repeated_3"] == 6 / 7
    assert found["stops"] == 4 / 31 and found["bars"] == found["digits"] == 1 / 31
    assert statistics(b"") == [0.0] * len(FEATURES)
    assert all(map(math.isfinite, statistics(b" \n ") + statistics(b"\xff" * 9) + statistics(b"a" * 10**6)))


def test_held_out_labels(spark, sample_dir):
    folder = sample_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = spark.read.parquet(f"{folder}/labels.parquet")
    rows = score_quality(docs, known, held_out="crc32(CAST(id AS STRING)) % 3 = 1").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    due = {r["doc_id"]: r["quality"] for r in known.collect()}
    test = [r for r in rows if r["held_out"] and r["doc_id"] in due]
    right = sum(r["predicted"] == due[r["doc_id"]] for r in test)
    assert len(test) > 50 and right >= 0.95 * len(test)


def test_held_out_labels_change_nothing(documents, labels):
    texts = [(i, plain(i) if i % 3 else junk(i)) for i in range(60)]
    true = [(i, int(i % 3 > 0), 0) for i in range(60)]
    wrong = [(i, 1 - q if i % 2 else q, t) for i, q, t in true]
    docs = documents(*texts)
    a = score_quality(docs, labels(*true), held_out="id % 2 = 1").orderBy("doc_id").collect()
    b = score_quality(docs, labels(*wrong), held_out="id % 2 = 1").orderBy("doc_id").collect()
    assert a == b
    assert all(r["predicted"] == (r["doc_id"] % 3 > 0) for r in a)


def test_odd_labels(documents, labels):
    docs = documents(*((i, plain(i) if i % 2 else junk(i)) for i in range(40)), (None, junk(1)),
                     more="score string, label string, id string, good string, known string")
    clear = [(i, i % 2, 0) for i in range(40)]
    model = score_quality(docs, labels(*clear)).orderBy("doc_id").collect()
    # Repeated labels, labels of no document, NULL ids and labels, and contradictions.
    more = [*clear, *clear, (99, 0, 0), (None, 1, 1), (3, None, 0), (500, 1, 0)]
    assert score_quality(docs, labels(*more)).orderBy("doc_id").collect() == model
    torn = [x for x in clear if x[0] != 6] + [(6, 0, 0), (6, 1, 0)]
    due = score_quality(docs, labels(*(x for x in clear if x[0] != 6))).orderBy("doc_id").collect()
    assert score_quality(docs, labels(*torn)).orderBy("doc_id").collect() == due


def test_sample_is_bounded(documents, labels):
    docs = documents(*((i % 7, plain(i) if i % 7 % 2 else junk(i)) for i in range(70)))
    known = labels(*((i, i % 2, 0) for i in range(7)))
    assert train(docs, known).base == pytest.approx(math.log(4 / 5))
    assert abs(train(docs, known, sample_rows=1).base) == pytest.approx(math.log(2))


def test_edges(documents, labels):
    assert score_quality(documents(), labels((1, 1, 0))).count() == 0
    rows = score_quality(documents((1, None), (1, ""), (None, "b" * 300_000)), labels()).collect()
    assert [(r["score"], r["predicted"], r["held_out"]) for r in rows] == [(0.5, 1, False)] * 3
    only = score_quality(documents((1, plain(1)), (2, None)), labels((1, 1, 0))).collect()
    assert all(r["predicted"] == 1 for r in only)
    rows = score_quality(documents((None, "x")), labels(), held_out="id = 1").collect()
    assert rows[0]["held_out"] is False
