"""What the training-data operators share: shipping, null-safe keys and stored tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of most contracts: runs of everything but ASCII white space, as ``bytes.split``
#: finds them.
SPACE = r"[\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package.

    Nothing happens where it is on their path already (``PYTHONPATH``, or the working folder of
    a local session). Elsewhere its sources travel with the application once.
    """
    root = Path(__file__).resolve().parents[2]
    sc = spark.sparkContext
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(":") if p]
    if any(Path(p).resolve() == root for p in [*paths, os.getcwd()]):
        return
    if sc.applicationId in _shipped:
        return
    package = root / __name__.split(".")[0]
    target = Path(tempfile.mkdtemp(prefix="tideline-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(root))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def give_back() -> None:
    """Return to the system what Arrow's pool keeps of batches that are gone.

    The pool keeps several times the largest batch, in every worker of an executor, and workers
    stay when their task is over. Called in a Python worker between slices of its batches.
    """
    pa.default_memory_pool().release_unused()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def equal_or_null(left: Column, right: Column) -> Column:
    """Equality under which NULL equals NULL, in a form that joins can hash and sort by."""
    return left.eqNullSafe(right)


def token(value: Column, seed: int = 0) -> Column:
    """A 64-bit hash that spreads rows; never used as proof of equality."""
    return F.xxhash64(F.lit(seed), value)


#: Bits that ids are marked in; 1,024 rows of 4 KB at most, whatever the number of ids.
MARK_BITS = 1 << 25


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(MARK_BITS)) + 1


def maybe_in(rows: DataFrame, key: Column, ids: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with ``_maybe``: false where ``key`` is surely not in ``ids``.

    Hashes of the ids are marked in a bit map of fixed size, which is broadcast. So only rows
    that may be among the ids have to travel to an exact join with them; the more ids there are
    for the map, the more rows may.
    """
    marks = ids.select(_place(F.col(id_col)).alias("_x"))
    marks = marks.groupBy(F.bitmap_bucket_number("_x").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_x")).alias("_bits")
    )
    place = _place(key)
    placed = rows.withColumns(
        {"_in": F.bitmap_bucket_number(place), "_at": F.bitmap_bit_position(place).cast("int")}
    )
    found = placed.join(F.broadcast(marks), F.col("_in") == F.col("_bucket"), "left")
    byte = F.conv(F.hex(F.substring("_bits", F.expr("_at div 8 + 1"), F.lit(1))), 16, 10)
    bit = F.expr("shiftleft(1, _at % 8)")
    test = byte.cast("int").bitwiseAND(bit) != 0
    return found.withColumn("_maybe", F.coalesce(test, F.lit(False))).drop(
        "_in", "_at", "_bucket", "_bits"
    )
