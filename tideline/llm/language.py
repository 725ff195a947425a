"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed character n-grams, weighted by TF-IDF and normalised. Each
language is described by the centroids of a few clusters of its labelled texts; a text gets the
language of the centroid with the largest cosine, and is rejected if even that is far away.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, ship, token
from .tokens import byte_slices
from .words import mixed

DIMENSION_BITS = 13
#: Labelled documents a language is learned from, at most: those of the smallest hashed ids.
ROWS_PER_LANGUAGE = 300
CLUSTERS = 4
ROUNDS = 12
#: A text is rejected if its cosine is below this share of what texts of the cluster reach ...
REJECT_SHARE = 0.35
#: ... where shorter texts are expected to reach less, by the square root of their n-grams
#: over this many.
FULL_NGRAMS = 600
UNKNOWN = "und"
#: Parts in which the rows of one label are looked through.
SLICES = 256
#: Bytes of texts whose rows are filtered, and sent back, at once.
SLICE_BYTES = 4 << 20

_SIZES = (1, 2, 3)
_alpha: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _alpha:
        _alpha.append(np.array([chr(c).isalpha() for c in range(0x110000)], bool))
    return _alpha[0]


def ngram_counts(text: str, bits: int = DIMENSION_BITS) -> np.ndarray:
    """Counts of hashed n-grams of the lower-case text, where anything but letters is one blank;
    all zero for a text without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found = letters()[points]
    if not found.any():
        return np.zeros(1 << bits, np.int64)
    points = np.where(found, points, 32).astype(np.uint64)
    blank = points == 32
    points = points[~(blank & np.concatenate([[False], blank[:-1]]))]
    points = np.concatenate([[32], points, [32]]).astype(np.uint64)
    total = np.zeros(1 << bits, np.int64)
    for size in _SIZES:
        count = len(points) - size + 1
        codes = np.full(count, size, np.uint64)
        for i in range(size):
            codes = codes * np.uint64(0x110001) + points[i : i + count]
        total += np.bincount(
            (mixed(codes) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits
        )
    return total


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The TF-IDF vector of length one, or zero where there is nothing."""
    vector = np.log1p(counts) * idf
    length = np.sqrt(vector @ vector)
    return vector / length if length else vector


@dataclass
class Centroids:
    """``centres`` has a row per centroid, of language ``names[owner]``; ``reach`` is the cosine
    that nearly all texts of the cluster have."""

    names: list[str]
    owner: np.ndarray
    centres: np.ndarray
    reach: np.ndarray
    idf: np.ndarray

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine, and whether the text is rejected."""
        counts = ngram_counts(text or "")
        total = int(counts.sum())
        if not total or not len(self.centres):
            return UNKNOWN, 0.0, True
        cosines = self.centres @ weighted(counts, self.idf).astype(np.float32)
        best = int(cosines.argmax())
        score = float(np.clip(cosines[best], 0.0, 1.0))
        due = REJECT_SHARE * self.reach[best] * min(1.0, (total / FULL_NGRAMS) ** 0.5)
        return self.names[self.owner[best]], score, score < due


def clusters(vectors: np.ndarray, count: int) -> np.ndarray:
    """Unit centroids by spherical k-means, started from rows far from one another."""
    centres = [vectors.mean(axis=0)]
    for _ in range(min(count, len(vectors)) - 1):
        near = np.max([vectors @ (c / (np.linalg.norm(c) or 1)) for c in centres], axis=0)
        centres.append(vectors[int(near.argmin())])
    found = np.array(centres)
    for _ in range(ROUNDS):
        found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
        nearest = (vectors @ found.T).argmax(axis=1)
        for k in range(len(found)):
            if (nearest == k).any():
                found[k] = vectors[nearest == k].mean(axis=0)
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)


def fit(samples: dict[str, list[np.ndarray]], bits: int = DIMENSION_BITS) -> Centroids:
    """Centroids of each language from the n-gram counts of its sample."""
    samples = {k: [c for c in v if c.any()] for k, v in sorted(samples.items())}
    samples = {k: v for k, v in samples.items() if v}
    rows = sum(map(len, samples.values()))
    seen = np.zeros(1 << bits)
    for counts in samples.values():
        for c in counts:
            seen += c > 0
    idf = (np.log((1 + rows) / (1 + seen)) + 1).astype(np.float32)
    owner, centres, reach = [], [], []
    for k, counts in enumerate(samples.values()):
        vectors = np.array([weighted(c, idf) for c in counts], np.float32)
        found = clusters(vectors, CLUSTERS)
        cosines = vectors @ found.T
        nearest = cosines.argmax(axis=1)
        for j in range(len(found)):
            if (mine := cosines[nearest == j, j]).size:
                owner.append(k)
                centres.append(found[j])
                reach.append(float(np.median(mine)))
    return Centroids(
        list(samples), np.array(owner, np.int64),
        np.array(centres, np.float32).reshape(-1, 1 << bits), np.array(reach), idf,
    )


def train(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str,
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> Centroids:
    """Centroids from a bounded sample of the labelled rows that are not held out.

    Ids and labels alone decide on the sample, and only as many are kept as it takes; so the
    ids are broadcast, and their n-grams counted where the texts are.
    """
    named = docs.select(docs[id_col].alias("id"), docs[lang_col].alias("lang"))
    named = named.where("lang IS NOT NULL AND id IS NOT NULL").where(~held_out(F.col("id")))
    named = named.withColumn("place", token(F.col("id")))
    # The first rows of every slice of the hash hold the first rows of all.
    slice_ = F.pmod("place", F.lit(SLICES))
    for part in (["lang", slice_], ["lang"]):
        first = Window.partitionBy(*part).orderBy("place", "id")
        named = named.withColumn("n", F.row_number().over(first))
        named = named.where(F.col("n") <= rows_per_language).drop("n")
    chosen = named
    chosen = chosen.select(F.col("id").alias("sample"), F.col("lang").alias("label")).distinct()
    texts = docs.select(docs[id_col].alias("id"), docs[lang_col].alias("lang"),
                        docs[text_col].alias("text"))
    match = (F.col("id") == F.col("sample")) & (F.col("lang") == F.col("label"))
    texts = texts.join(F.broadcast(chosen), match).select("lang", "text")

    def count(batches):
        for batch in batches:
            found = [ngram_counts(x.as_py() or "") for x in batch.column("text")]
            some = [np.flatnonzero(c) for c in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"), pa.array(some, pa.list_(pa.int32())),
                    pa.array([c[s] for c, s in zip(found, some)], pa.list_(pa.int32())),
                ],
                names=["lang", "at", "n"],
            )

    samples: dict[str, list[np.ndarray]] = {}
    rows = texts.mapInArrow(count, "lang string, at array<int>, n array<int>").toArrow()
    for lang, at, n in zip(*(rows.column(i) for i in range(3))):
        counts = np.zeros(1 << DIMENSION_BITS, np.int32)
        counts[at.values.to_numpy()] = n.values.to_numpy()
        samples.setdefault(lang.as_py(), []).append(counts)
    for found in samples.values():  # rows come in any order
        found.sort(key=lambda c: zlib.crc32(c.tobytes()))
    return fit(samples)


def held_out(ids):
    """Rows that nothing is learned from."""
    return F.pmod(F.crc32(F.coalesce(ids.cast("string"), F.lit(""))), F.lit(4)) == 2


def accepted(batches, centroids: Centroids, place: int):
    """The rows of Arrow batches whose text, the column ``place``, is not rejected.

    A batch comes back in parts of about ``SLICE_BYTES`` of text, so no second one is held.
    """
    for batch in batches:
        texts = batch.column(place)
        sizes = [len(x.as_buffer() or b"") if x.is_valid else 0 for x in texts]
        for a, b in byte_slices(sizes, SLICE_BYTES):
            good = [not centroids.classify(x.as_py())[2] for x in texts[a:b]]
            yield batch.slice(a, b - a).filter(pa.array(good, pa.bool_()))
            give_back()


def drop_rejected(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The rows of ``docs`` that ``identify_languages`` doesn't reject, with all their columns."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(
        train(docs, id_col, text_col, lang_col, ROWS_PER_LANGUAGE)
    )
    place = docs.columns.index(text_col)

    def run(batches):
        yield from accepted(batches, model.value, place)

    return docs.mapInArrow(run, docs.schema)


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``held_out``, ``lang_pred``, ``score``, ``rejected``.

    Centroids are learned from rows with an id and a label that aren't held out, at most
    ``rows_per_language`` of each label. A prediction sees the text alone. ``lang_pred`` is the
    language of the nearest centroid and ``score`` its cosine; ``rejected`` says that it is too
    far for the text's length. A text that is NULL or has no letter is ``und`` with score 0 and
    rejected; so is every text if there is nothing to learn from. Ties go to the language first
    by name. Repeated rows and ids give a row each, NULL ids too. Other columns are ignored,
    whatever their names. Empty ``docs`` give an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(
        train(docs, id_col, text_col, lang_col, rows_per_language)
    )
    source = docs.select(
        docs[id_col].alias("id"), held_out(docs[id_col]).alias("held_out"),
        docs[text_col].alias("text"),
    )
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        centroids = model.value
        for batch in batches:
            found = [centroids.classify(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("held_out"),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                    pa.array([x[2] for x in found], pa.bool_()),
                ],
                names=[id_col, "held_out", "lang_pred", "score", "rejected"],
            )

    return source.mapInArrow(
        run,
        f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double, rejected boolean",
    )
