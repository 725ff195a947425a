import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tideline.llm import exact
from tideline.llm.exact import exact_dedup, keep_first, names


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out, kept = [], set()
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        first = i == keep and (norm(t) not in kept)
        kept |= {norm(t)} if first else set()
        out.append((i, keep, len(ids), first, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def results(df):
    return sorted(
        [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
         for r in df.collect()], key=str
    )


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_against_brute_force(documents, block):
    rnd = random.Random(block)
    texts = ["".join(rnd.choices("ab \n", k=rnd.randrange(0, 9))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(100, "é👍x" * 7), (101, "é👍x" * 7), (102, "é👍x" * 6)]
    assert results(exact_dedup(documents(*rows), block_chars=block)) == brute(rows)


def test_many_blocks(documents):
    base = "".join(random.Random(5).choices("abcdefg", k=100_000))
    rows = [(3, base), (1, base), (2, base[:-1] + "z"), (4, base + "z"), (5, base[1:])]
    assert results(exact_dedup(documents(*rows), block_chars=100)) == brute(rows)


def test_edges(documents):
    rows = [
        (1, None), (2, ""), (3, " "), (4, "\n"), (5, "a"), (5, "a"), (5, "b"), (None, "a"),
        (None, "c"), (None, "c"),
    ]
    df = documents(*rows, more="id string, digest string, kept string, name string")
    assert results(exact_dedup(df)) == brute(rows)
    assert exact_dedup(documents()).count() == 0
    kept = keep_first(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, None), (3, " "), (5, "a"), (5, "b"), (None, "c")], key=str
    )


def test_blocks_with_one_hash(documents, monkeypatch):
    """Different blocks that share both hashes keep different names."""
    monkeypatch.setattr(exact.F, "xxhash64", lambda *c: exact.F.lit(7).cast("bigint"))
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "aabb"), (5, "bbaa"), (6, "aabb")]
    found = results(exact_dedup(documents(*rows), block_chars=2))
    monkeypatch.undo()
    assert found == brute(rows)


def test_names_are_packed(spark):
    words = F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: F.hex((F.col("id") * i) % 991))
    texts = spark.range(2000).select(F.array_join(words, " ").alias("block"))
    found = names(texts)
    assert found.select("name").distinct().count() == texts.distinct().count()
    assert all(".zstd." in file or ".zst." in file for file in found.inputFiles())
