"""Quality rules: text counts, and a likelihood ratio between trusted and raw text.

Words and word pairs are hashed to a fixed number of buckets. Two multinomials over the buckets
are counted: one over every document, one over a bounded sample of documents that a label calls
good. A document's score is the mean logarithm of their ratio over its n-grams: zero says that
it reads like the corpus, negative that the trusted text lacks what it is made of.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, token
from .words import mixed, utf8, window_hashes, word_hashes

BUCKET_BITS = 16
#: Labelled documents the trusted multinomial is counted from, at most: those of the smallest
#: hashed ids.
TRUSTED_ROWS = 20_000
#: Added to every bucket of both multinomials, in n-grams of the trusted text.
PSEUDO_COUNT = 30
#: In natural logarithms per n-gram.
MIN_SCORE = -0.06
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SPACES = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint"
)


def grams(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of all words and word pairs."""
    both = np.concatenate([mixed(hashes), window_hashes(hashes, 2)])
    return (both >> np.uint64(64 - bits)).astype(np.int64)


def text_counts(text: bytes, hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, and words in repeated windows."""
    packed = text.translate(None, _SPACES)
    bytes_ = np.frombuffer(packed, np.uint8)
    chars = len(packed) - int(np.count_nonzero((bytes_ & 0xC0) == 0x80))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    windows = window_hashes(hashes, 3)
    repeated = 0
    if len(windows) > 1:
        _, back, counts = np.unique(windows, return_inverse=True, return_counts=True)
        twice = counts[back] > 1
        if twice.any():
            covered = np.zeros(len(hashes), bool)
            for i in range(3):
                covered[i : i + len(windows)] |= twice
            repeated = int(covered.sum())
    return len(hashes), chars, symbols, len(lines) - len(set(lines)), repeated


def bucket_counts(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str,
    text_col: str,
    bits: int = BUCKET_BITS,
) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all documents, and over those whose id is in ``trusted``.

    ``trusted`` has one column of distinct ids and at most ``TRUSTED_ROWS`` rows, so it is
    broadcast. Tasks send at most one row per bucket, and as many rows come back in all.
    """
    ids = F.broadcast(trusted.toDF("known"))
    marked = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    marked = marked.join(ids, marked["id"] == ids["known"], "left").select(
        "text", F.col("known").isNotNull().alias("good")
    )

    def run(batches):
        totals = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            for text, good in zip(batch.column("text"), batch.column("good")):
                found = np.bincount(grams(word_hashes(utf8(text)), bits), minlength=1 << bits)
                totals[0] += found
                if good.as_py():
                    totals[1] += found
        some = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(totals[0][some]), pa.array(totals[1][some])],
            names=["bucket", "raw", "good"],
        )

    parts = marked.mapInArrow(run, "bucket bigint, raw bigint, good bigint")
    rows = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    found = rows.toPandas()
    raw, good = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
    raw[found["bucket"]], good[found["bucket"]] = found["raw"], found["good"]
    return raw, good


def log_ratios(raw: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Per bucket, the logarithm of its trusted count over the count that its raw share lets
    expect, with ``PSEUDO_COUNT`` added to both: what is rare in so small a trusted text says
    little. Without trusted text there is nothing to compare with, and all ratios are zero.
    """
    expected = raw * (good.sum() / max(1, raw.sum()))
    return np.log(good + PSEUDO_COUNT) - np.log(expected + PSEUDO_COUNT)


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    good: str = "quality = 1",
    trusted_rows: int = TRUSTED_ROWS,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """One row per row of ``docs``: its id, text counts, ``score``, ``base_failed``, ``kept``.

    ``labels`` holds ids and what ``good`` tests; at most ``trusted_rows`` of the good ids, those
    with the smallest hashes, make the trusted text. The raw counts cover every document.
    ``base_failed`` says fewer than 50 words, or over half of them in repeated windows; ``kept``
    that this is false and the score at least ``min_score``.

    A NULL or empty text has no words, score 0, and fails. A text of one word has one n-gram.
    Repeated rows and ids give a row each, and a NULL id is never labelled. Other columns are
    ignored, whatever their names. Empty ``docs`` give an empty result; without good labels all
    scores are 0.
    """
    spark = docs.sparkSession
    ship(spark)
    ids = labels.where(good).where(F.col(id_col).isNotNull()).select(id_col).distinct()
    ids = ids.orderBy(token(F.col(id_col)), id_col).limit(trusted_rows)
    bits = BUCKET_BITS
    ratios = spark.sparkContext.broadcast(
        log_ratios(*bucket_counts(docs, ids, id_col, text_col, bits))
    )
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def rows(texts) -> Iterator[tuple]:
        table = ratios.value
        for text in map(utf8, texts):
            hashes = word_hashes(text)
            found = grams(hashes, bits)
            score = float(table[found].sum() / len(found)) if len(found) else 0.0
            counts = text_counts(text, hashes)
            n, repeated = counts[0], counts[-1]
            failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
            yield *counts, failed, not failed and score >= min_score, score

    names = [*(c.split()[0] for c in COLUMNS.split(", ")), "base_failed", "kept", "score"]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]

    def run(batches):
        for batch in batches:
            columns = list(zip(*rows(batch.column("text")))) or [[]] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], names=[id_col, *names])

    return source.mapInArrow(
        run, f"`{id_col}` {kind}, {COLUMNS}, base_failed boolean, kept boolean, score double"
    )
