"""Embedding whitening: exact integer moments by Spark, eigenvectors refined from float32.

Vectors become integers, ``floor(scale * entry)``, so that counts, sums and products are exact
and don't depend on how rows are dealt out. A float32 decomposition of the covariance is only a
start: matrix multiplications in extended precision correct it (Ogita and Aishima), and where
eigenvalues lie too close together for that, the block that belongs to them is decomposed again
on its own, shifted to its mean, which widens its gaps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import ship

SCALE = 256
COMPONENTS = 4
#: Turns of refinement at most; each doubles the right digits, so that three or four do.
TURNS = 12
#: Bytes of vectors multiplied at once.
SLICE_BYTES = 4 << 20
#: Scaled entries are below this, so that differences from the mean are exact as doubles.
MOST = 1 << 40

_WIDE = np.longdouble


# --- eigenvectors -----------------------------------------------------------------------------


def _corrections(a: np.ndarray, x: np.ndarray):
    """What one turn adds to ``x``, the eigenvalues it implies, and how close counts as equal."""
    r = np.eye(x.shape[1], dtype=_WIDE) - x.T @ x
    s = x.T @ (a @ x)
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    top = float(np.abs(values).max())
    close = 2 * (np.linalg.norm(off.astype(float)) + top * np.linalg.norm(r.astype(float)))
    gaps = values[None, :] - values[:, None]
    apart = np.abs(gaps) > close
    steps = np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
    return steps, values, close


def _clusters(values: np.ndarray, close: float) -> list[np.ndarray]:
    """Places of eigenvalues each of which has another one within ``close``."""
    order = np.argsort(values, kind="stable")
    breaks = np.flatnonzero(np.diff(values[order]) > close) + 1
    return [part for part in np.split(order, breaks) if len(part) > 1]


def _sub_solve(a: np.ndarray, block: np.ndarray, depth: int) -> np.ndarray:
    """The vectors of one cluster turned within the space that they span."""
    gram = block.T @ block
    block = block + block @ ((np.eye(block.shape[1], dtype=_WIDE) - gram) / 2)
    small = block.T @ (a @ block)
    small = (small + small.T) / 2
    small = small - np.eye(len(small), dtype=_WIDE) * (np.trace(small) / len(small))
    width = np.abs(small).max()
    # Equal to the last bit: any basis of the space will do.
    if width <= np.abs(a).max() * np.finfo(_WIDE).eps * len(a):
        return block
    return block @ eigenvectors(small / width, depth + 1)


def eigenvectors(a: np.ndarray, depth: int = 0) -> np.ndarray:
    """Unit eigenvectors of the symmetric ``a`` as columns, in extended precision, any order."""
    a = np.asarray(a, _WIDE)
    if len(a) < 2 or not a.any():
        return np.eye(len(a), dtype=_WIDE)
    a = a / np.abs(a).max()
    start = np.linalg.eigh(a.astype(np.float32))[1]
    x = start.astype(_WIDE)
    split = False
    for _ in range(TURNS):
        steps, values, close = _corrections(a, x)
        x = x + x @ steps
        moved = float(np.abs(steps).max())
        if moved < 1e-7 and not split and depth < 4:
            # Vectors of different clusters are apart now; those within one are not yet.
            for part in _clusters(values, max(close, 1e-5)):
                x[:, part] = _sub_solve(a, x[:, part], depth)
            split = True
        elif moved < 1e-16:
            break
    x = x + x @ ((np.eye(len(a), dtype=_WIDE) - x.T @ x) / 2)
    return x / np.sqrt((x * x).sum(axis=0))


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with sums ``sums`` were fitted; ``vectors`` has a component a column."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def scales(self) -> np.ndarray:
        """What projections are multiplied by; not a number for components without variance."""
        floor = self.trace * len(self.sums) * np.finfo(float).eps
        good = self.values > floor
        return np.where(good, 1 / np.sqrt(np.where(good, self.values, 1)), np.nan)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums`` exactly: as 64-bit integers where they and their squares' sum fit."""
        top = max(int(np.abs(x).max(initial=0)), 1) * self.n
        top += max(map(abs, self.sums.tolist()), default=0)
        kind = np.int64 if top * top * max(1, x.shape[1]) < 1 << 63 else object
        return x.astype(kind) * self.n - self.sums.astype(kind)

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of squared deviations, and whitened rows.

        Rows are projected one dimension after the other, not by a matrix product, whose
        rounding depends on how many rows it has: equal vectors get equal results anywhere.
        """
        far = self.deviations(x)
        squares = (far * far).sum(axis=1)
        far = far.astype(float) / self.n
        columns = (self.vectors * self.scales).T
        return squares, np.stack([(far * c).sum(axis=1) for c in columns], axis=1)


def decompose(n: int, sums: np.ndarray, covariance: np.ndarray, components: int) -> Whitening:
    """The leading components; a vector's largest entry, the first of equal ones, is positive."""
    vectors = eigenvectors(covariance)
    values = (vectors * (covariance @ vectors)).sum(axis=0)
    order = np.argsort(-values, kind="stable")[:components]
    vectors, values = vectors[:, order], np.maximum(values[order], 0)
    if len(vectors):
        peak = np.abs(vectors.astype(float)).argmax(axis=0)
        vectors = vectors * np.where(vectors[peak, np.arange(len(order))] < 0, -1, 1)
    trace = float(np.trace(covariance)) if len(covariance) else 0.0
    return Whitening(n, sums, vectors.astype(float), values.astype(float), trace)


# --- moments ----------------------------------------------------------------------------------


def _matrices(batches, name: str = "x"):
    """The vectors of Arrow batches, a few megabytes at a time, with the rows they are."""
    for batch in batches:
        column = batch.column(name)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        rows = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
        step = max(1, SLICE_BYTES // max(1, 8 * rows.shape[1]))
        for a in range(0, len(rows), step):
            yield batch.slice(a, step), rows[a : a + step]


def _total(rows: DataFrame, name: str, partial, kind: str) -> np.ndarray:
    """The sum over all tasks of one array a task, added up place by place in Spark."""

    def run(batches):
        total = None
        for _, x in _matrices(batches):
            found = np.asarray(partial(x)).ravel()
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total])], names=[name])

    parts = rows.mapInArrow(run, f"{name} array<{kind}>")
    cells = parts.select(F.posexplode(name).alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
    found = {r["i"]: r["v"] for r in cells.collect()}
    return np.array([found[i] for i in range(len(found))])


def moments(fit: DataFrame, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, sums per dimension and covariance of the vectors in ``x``.

    Products are of differences from the nearest integer to the mean: whole numbers, exact in
    double precision as long as a sum of squares stays under 2**53. What the rounding of the
    mean adds is taken off at the end.
    """
    found = _total(fit, "s", lambda x: [len(x), *x.sum(axis=0)], "bigint")
    if not len(found):
        return 0, np.zeros(size, np.int64), np.zeros((size, size), _WIDE)
    n, sums = int(found[0]), found[1:].astype(np.int64)
    middle = (2 * sums + n) // (2 * n)

    def products(x):
        far = (x - middle).astype(float)
        return far.T @ far

    total = _total(fit, "p", products, "double").reshape(size, size).astype(_WIDE)
    rest = (sums - n * middle).astype(_WIDE) / n
    return n, sums, total / n - np.outer(rest, rest)


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the identity.

    Components without variance are left out; without any there is no such number.
    """
    good = np.flatnonzero(~np.isnan(model.scales))
    if not len(good):
        return None

    def first(x):
        return model.apply(x)[1][:, good].sum(axis=0)

    mean = _total(fit, "m", first, "double") / model.n

    def second(x):
        far = model.apply(x)[1][:, good] - mean
        return far.T @ far

    found = _total(fit, "c", second, "double").reshape(len(good), len(good)) / model.n
    return float(np.abs(found - np.eye(len(good))).max())


# --- the operator -----------------------------------------------------------------------------


def _scaled(vector: Column, scale: int) -> Column:
    """The integer vector; NULL without entries, or if one is NULL, infinite or not a number."""
    entries = vector.cast("array<double>")
    finite = F.forall(
        entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    )
    small = F.forall(entries, lambda c: F.abs(c * scale) < float(MOST))
    whole = F.transform(entries, lambda c: F.floor(c * scale).cast("bigint"))
    refused = F.raise_error(F.lit(f"a scaled entry is not below {MOST}")).cast("array<bigint>")
    return F.when(finite & (F.size(entries) > 0), F.when(small, whole).otherwise(refused))


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """A row per vector and leading component: its id, ``component`` from 1, ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    The fit covers every different vector once. ``deviation``, the squared distance from the
    mean times ``n * n``, is exact as ``decimal(38, 0)``. Vectors that are NULL, have no entry, or
    have one that is NULL, infinite or not a number give no row; all others must have one length,
    and scaled entries below ``MOST``, or an error says so. Ids are carried as they are: NULL and
    repeated ids give their rows each. Equal vectors get equal results. There are at most as many
    components as dimensions; those without variance have no ``whitened`` value, and vectors that
    are all equal leave ``identity_error`` NULL and ``explained`` 0. Other columns are ignored,
    whatever their names. An empty table gives an empty result.

    Tasks send back one partial sum or matrix each, which Spark adds up cell by cell; the driver
    holds matrices of the dimension, never rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(
        vectors[id_col].alias("id"), _scaled(vectors[vector_col], scale).alias("x")
    ).where("x IS NOT NULL")
    fit = stored(rows.select("x").distinct())
    sizes = [r[0] for r in fit.select(F.size("x")).distinct().limit(2).collect()]
    if len(sizes) > 1:
        raise ValueError(f"vectors of several lengths, {sizes[0]} and {sizes[1]} among them")
    size = sizes[0] if sizes else 0
    n, sums, covariance = moments(fit, size)
    model = decompose(n, sums, covariance, components)
    error = identity_error(fit, model) if n else None
    shares = model.values / model.trace if model.trace > 0 else np.zeros(len(model.values))
    kind = rows.schema["id"].dataType.simpleString()
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        k = len(shares)
        for batch, x in _matrices(batches):
            squares, whitened = model.apply(x)
            each = np.repeat(np.arange(len(x)), k)
            flat = whitened.ravel()
            squares = pa.array([int(v) for v in squares.tolist()], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), n, np.int64)),
                    squares.take(pa.array(each)),
                    pa.array(flat, mask=np.isnan(flat)),
                    pa.array(np.tile(shares, len(x))),
                    pa.array([error] * len(each), pa.float64()),
                ],
                names=names,
            )

    return rows.mapInArrow(
        run,
        f"`{id_col}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double",
    )
