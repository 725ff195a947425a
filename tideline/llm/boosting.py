"""A quality classifier: histogram gradient-boosted trees over document statistics.

Every document becomes a row of numbers that say nothing of its language or subject. Trees are
fitted to a bounded sample of labelled rows whose numbers are cut into at most 255 bins, so that
a split is a look at sums per bin. They are kept as flat arrays, a level after the other, and
all documents of a batch step through all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, token
from .tokens import byte_slices
from .words import utf8, window_hashes, word_hashes

#: Labelled documents that the trees are fitted to, at most: those of the smallest hashed ids.
SAMPLE_ROWS = 20_000
TREES = 80
DEPTH = 4
BINS = 255
RATE = 0.15
#: Added to the sum of second derivatives in a leaf, and the least such sum that a leaf has.
SHRINK = 1.0
LEAST = 1.0
#: Bytes of texts whose statistics are held at once.
SLICE_BYTES = 4 << 20

# --- document statistics ----------------------------------------------------------------------

#: Kinds of ASCII bytes whose shares are statistics.
KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digits": b"0123456789",
    "space": b" \t\r\x0b\x0c",
    "breaks": b"\n",
    "stops": b".",
    "commas": b",;:",
    "shouts": b"!?",
    "bars": b"|",
    "marks": b"#*$%&",
    "brackets": b"<>[]{}()",
    "signs": b"\"'/\\=+-_@~^`",
}
FEATURES = (
    "words", "bytes_per_word", "lines", "words_per_line", "short_lines", "dup_lines",
    "distinct_words", "top_word", "same_as_before", "repeated_3", "repeated_8", "byte_entropy",
    "wide", *KINDS,
)
_KIND_OF = np.full(256, len(KINDS), np.int64)
for _i, _set in enumerate(KINDS.values()):
    _KIND_OF[list(_set)] = _i


def _repeated(hashes: np.ndarray, size: int) -> float:
    """The share of windows of ``size`` words that stand more than once."""
    windows = window_hashes(hashes, size)
    if len(windows) < 2:
        return 0.0
    counts = np.unique(windows, return_counts=True)[1]
    return float(counts[counts > 1].sum()) / len(windows)


def statistics(text: bytes) -> list[float]:
    """The numbers of ``FEATURES``; all of them are zero for an empty text."""
    if not text:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_KIND_OF, weights=counts, minlength=len(KINDS) + 1) / len(text)
    some = counts[counts > 0] / len(text)
    hashes = word_hashes(text)
    n = len(hashes)
    lines = [x for x in map(bytes.strip, text.split(b"\n")) if x]
    each = np.unique(hashes, return_counts=True)[1] if n else np.zeros(1)
    return [
        np.log1p(n),
        (len(text) - int(counts[[9, 10, 11, 12, 13, 32]].sum())) / max(1, n),
        np.log1p(len(lines)),
        np.log1p(n / max(1, len(lines))),
        sum(len(x) < 40 for x in lines) / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        len(each) / max(1, n),
        float(each.max()) / max(1, n),
        float((hashes[1:] == hashes[:-1]).mean()) if n > 1 else 0.0,
        _repeated(hashes, 3),
        _repeated(hashes, 8),
        float(-(some * np.log2(some)).sum()),
        float(counts[128:].sum()) / len(text),
        *kinds[:-1].tolist(),
    ]


# --- trees ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Trees:
    """Full binary trees of one depth as arrays (trees, nodes) and (trees, leaves).

    Node ``i`` has the children ``2i + 1`` and ``2i + 2``; a row goes to the second one if its
    feature is above the threshold. A node that is not split sends all rows to the first.
    """

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of every row, stepping through all trees level by level."""
        trees, nodes = self.feature.shape
        out = np.full(len(rows), self.base)
        if not trees:
            return out
        each = np.arange(trees)[None, :]
        for a in range(0, len(rows), 4096):
            part = rows[a : a + 4096]
            at = np.zeros((len(part), trees), np.int64)
            row = np.arange(len(part))[:, None]
            while at[0, 0] < nodes:
                above = part[row, self.feature[each, at]] > self.threshold[each, at]
                at = 2 * at + 1 + above
            out[a : a + 4096] += self.value[each, at - nodes].sum(axis=1)
        return out

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rows), -500, 500)))


def bin_edges(rows: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Per feature, thresholds between neighbouring values, or between quantiles of many."""
    edges = []
    for column in rows.T:
        values = np.unique(column)
        if len(values) > bins:
            cuts = np.arange(1, bins) * len(column) // bins
            ranked = np.sort(column)
            edges.append(np.unique((ranked[cuts - 1] + ranked[cuts]) / 2))
        else:
            edges.append(values[:-1] + np.diff(values) / 2)
    return edges


def _best_splits(binned, grads, curves, node, count, bins, shrink, least):
    """Per node of a level: gain, feature and last bin of the first side of its best split."""
    width = binned.shape[1]
    size = count * bins
    sums = np.empty((width, 2, count, bins))
    for f in range(width):
        key = node * bins + binned[:, f]
        sums[f, 0] = np.bincount(key, grads, size).reshape(count, bins)
        sums[f, 1] = np.bincount(key, curves, size).reshape(count, bins)
    left = np.cumsum(sums, axis=3)
    total = left[..., -1:]
    right = total - left
    gain = (
        left[:, 0] ** 2 / (left[:, 1] + shrink)
        + right[:, 0] ** 2 / (right[:, 1] + shrink)
        - total[:, 0] ** 2 / (total[:, 1] + shrink)
    )
    gain = np.where((left[:, 1] >= least) & (right[:, 1] >= least), gain, 0)
    # Ties go to the earlier feature, then to the smaller threshold.
    flat = gain.transpose(1, 0, 2).reshape(count, -1)
    best = flat.argmax(axis=1)
    return flat[np.arange(count), best], best // bins, best % bins


def fit(
    rows: np.ndarray,
    good: np.ndarray,
    trees: int = TREES,
    depth: int = DEPTH,
    bins: int = BINS,
    rate: float = RATE,
    shrink: float = SHRINK,
    least: float = LEAST,
) -> Trees:
    """Trees for the logistic loss of ``good`` (0 or 1), by Newton steps.

    Without rows every margin is zero.
    """
    n = len(rows)
    base = float(np.log((good.sum() + 1) / (n - good.sum() + 1)))
    nodes, leaves = 2**depth - 1, 2**depth
    feature = np.zeros((trees, nodes), np.int64)
    threshold = np.full((trees, nodes), np.inf)
    value = np.zeros((trees, leaves))
    if not n:
        return Trees(base, feature, threshold, value)
    edges = bin_edges(rows, bins)
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, rows.T)], axis=1)
    margins = np.full(n, base)
    for t in range(trees):
        chance = 1 / (1 + np.exp(-margins))
        grads, curves = chance - good, chance * (1 - chance)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first = 2**level - 1
            gain, of, last = _best_splits(
                binned, grads, curves, node, 2**level, bins + 1, shrink, least
            )
            for i in np.flatnonzero(gain > 1e-9):
                feature[t, first + i] = of[i]
                threshold[t, first + i] = edges[of[i]][last[i]]
            above = rows[np.arange(n), feature[t, first + node]] > threshold[t, first + node]
            node = 2 * node + above
        sums = np.bincount(node, grads, leaves), np.bincount(node, curves, leaves)
        value[t] = -rate * sums[0] / (sums[1] + shrink)
        margins += value[t][node]
    return Trees(base, feature, threshold, value)


# --- the operator -----------------------------------------------------------------------------


def _measured(source: DataFrame) -> DataFrame:
    """The rows with ``stats`` instead of their text."""
    kept = [c for c in source.columns if c != "text"]
    fields = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches):
        for batch in batches:
            stats = [statistics(utf8(text)) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(stats, pa.list_(pa.float64()))],
                names=[*kept, "stats"],
            )

    return source.mapInArrow(run, f"{fields}, stats array<double>")


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    **options,
) -> Trees:
    """Trees for labelled documents: at most ``sample_rows`` ids, those of the smallest hashes.

    An id counts if its labels agree; 1 is good, 0 is not, others and NULL are no labels. Of
    several rows with one id the one with the smallest statistics is taken. What comes to the
    driver are numbers alone, one row an id.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    known = known.groupBy(F.col(id_col).alias("known")).agg(
        F.min(label_col).alias("good"), F.max(label_col).alias("most")
    )
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    # Ids without a document would use up the sample.
    known = known.where("good = most")
    known = known.join(source.select("id").distinct(), F.col("known") == F.col("id"), "semi")
    ids = known.orderBy(token(F.col("known")), "known").limit(sample_rows)
    chosen = source.join(F.broadcast(ids), F.col("id") == F.col("known"))
    rows = _measured(chosen.select("id", F.col("good").cast("int"), "text"))
    rows = rows.groupBy("id", "good").agg(F.min("stats").alias("stats"))
    rows = rows.orderBy(token(F.col("id")), "id").select("good", "stats").toArrow()
    stats = rows.column("stats").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return fit(stats, rows.column("good").to_numpy().astype(float), **options)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    held_out=None,
    sample_rows: int = SAMPLE_ROWS,
    **options,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``held_out``, ``score`` and ``predicted``.

    ``held_out`` is a condition on ids, of SQL text over the column ``id``; labels of such ids are
    not learned. By default none is. ``score`` is the chance that the label is 1, ``predicted`` 1
    from a half on. Only the text's own statistics are looked at.

    A NULL or empty text has statistics of zero and a score like any other. NULL ids are never
    learned from nor held out, and repeated ids give a row each. Labels that contradict each other
    are not used. Other columns are ignored, whatever their names. Without usable labels every
    score is a half. An empty table gives an empty result. Nothing but the sample is shuffled.
    """
    spark = docs.sparkSession
    ship(spark)
    out = F.coalesce(F.expr(held_out), F.lit(False)) if held_out else F.lit(False)
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    usable = usable.where(~out)
    model = spark.sparkContext.broadcast(
        train(
            docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), usable,
            "id", "text", "label", sample_rows, **options,
        )
    )
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    source = source.select("id", "text", out.alias("held_out"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model.value
        for batch in batches:
            column = batch.column("text")
            sizes = [len(x.as_buffer() or b"") if x.is_valid else 0 for x in column]
            for a, b in byte_slices(sizes, SLICE_BYTES):
                stats = [statistics(utf8(x)) for x in column.slice(a, b - a)]
                scores = trees.scores(np.array(stats))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(a, b - a),
                        batch.column("held_out").slice(a, b - a), pa.array(scores),
                        pa.array((scores >= 0.5).astype(np.int32)),
                    ],
                    names=[id_col, "held_out", "score", "predicted"],
                )

    return source.mapInArrow(
        run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int"
    )
