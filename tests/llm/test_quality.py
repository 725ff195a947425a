import math
import re
from collections import Counter

import numpy as np
import pytest

from tideline.llm.quality import grams, log_ratios, quality_rules
from tideline.llm.words import word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered), failed,
    )


@pytest.fixture
def labels(spark):
    return lambda *rows: spark.createDataFrame(
        list(rows), "doc_id bigint, quality int, toxic int"
    )


ODD = [
    None, "", " \n", "one", "a a a a", "x\n\nx\n y\nx", "é 👍🏽 <b>|#", "a\x0bb\x0cc\r\nd", "b" * 50_000,
    "w " * 200, " ".join(f"u{i}" for i in range(60)),
]


def test_counts(documents, sample, labels):
    texts = ODD + [r["text"] for r in sample.collect()]
    df = documents(*enumerate(texts), more="score string, good string, id string")
    rows = quality_rules(df, labels((10, 1, 0), (20, 1, 0), (21, 0, 0))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in NAMES) == brute(texts[r["doc_id"]]), texts[r["doc_id"]][:80]


def test_scores(documents, labels):
    """Scores against the formula on plain counts."""
    texts = [" ".join(f"{a}{(i * k) % 61}" for i in range(60)) for k, a in enumerate("ggggbb", 3)]
    known = labels((0, 1, 0), (1, 1, 0), (4, 0, 0))
    found = {r["doc_id"]: r for r in quality_rules(documents(*enumerate(texts)), known).collect()}
    per = [np.bincount(grams(word_hashes(t.encode()), 16), minlength=1 << 16) for t in texts]
    ratios = log_ratios(sum(per), per[0] + per[1])
    for i, counts in enumerate(per):
        due = float((counts * ratios).sum() / counts.sum())
        assert math.isclose(found[i]["score"], due, rel_tol=1e-9)
    assert found[2]["score"] > found[5]["score"]


def test_separates_the_sample(spark, sample_dir):
    folder = sample_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality_rules(docs, known).join(known, "doc_id").where("NOT base_failed").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rows)
    assert right >= 0.95 * len(rows)
    assert all(r["kept"] for r in rows if r["quality"] == 1)


def test_edges(documents, labels):
    assert quality_rules(documents(), labels()).count() == 0
    text = " ".join(f"u{i}" for i in range(60))
    rows = quality_rules(documents((None, text), (1, text), (1, text)), labels()).collect()
    assert [(r["score"], r["kept"]) for r in rows] == [(0.0, True)] * 3
