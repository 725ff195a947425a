"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed, stored

SALTS = 64
HOT_ROWS = 10_000_000
#: Rows of a key that one task counts and joins, if they all have to be sent to it.
SPREAD_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
#: Bits of the map that marks repeated keys: 16 MB, however many there are.
MARK_BITS = 1 << 27


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes; nested values count as long as their JSON text."""
    size = F.lit(8 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            text = F.octet_length(field.name)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.octet_length(F.to_json(F.struct(field.name)))
        else:
            continue
        size = size + F.coalesce(text, F.lit(0))
    return size.cast("bigint")


def fits(df: DataFrame) -> bool:
    """Whether all of ``df`` may be broadcast. It is read for that, so it should be stored."""
    total = df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]
    return total <= BROADCAST_BYTES


def _spread(df: DataFrame) -> Column:
    """A salt that a retried task gives a row again, and that equal rows don't all share."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.lit(SALTS)).cast("int")


def _in_map(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """The rows whose ``_hash`` may be among the ``hashes``, by a bit map of fixed size.

    The map is 4,096 rows of 4 KB at most. The more hashes there are, the more other rows pass.
    """

    def place(h: Column) -> Column:
        return F.pmod(h, F.lit(MARK_BITS)) + 1

    at = place(F.col("_hash"))
    marks = hashes.groupBy(F.bitmap_bucket_number(at).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits")
    )
    found = rows.withColumn("_in", F.bitmap_bucket_number(at)).join(
        F.broadcast(marks), F.col("_in") == F.col("_bucket")
    )
    bit = F.bitmap_bit_position(at).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    hit = F.getbit(byte.cast("int"), bit % 8) == 1
    return found.where(hit).drop("_in", "_bucket", "_bits")


def may_repeat(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key may occur more than once, with its ``_hash``; few others pass.

    Hashes of the keys are counted first, eight bytes and a number each. The hashes that repeat
    are broadcast while they are few, beyond that a bit map of them is, so no row travels.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    return _passing(hashed, _often(hashed))


def _often(hashed: DataFrame) -> DataFrame:
    """The hashes that repeat and the number ``_n`` of their rows."""
    counts = hashed.groupBy("_hash").agg(F.count("*").alias("_n"))
    return stored(counts.where("_n > 1"), "zstd")


def _passing(hashed: DataFrame, often: DataFrame) -> DataFrame:
    hashes = often.select("_hash")
    if fits(hashes):
        return hashed.join(F.broadcast(hashes), "_hash", "left_semi")
    return _in_map(hashed, hashes)


def rows_of_repeated_keys(df: DataFrame, keys: Sequence[str], row_id: Column) -> DataFrame:
    """Every row whose key occurs more than once, with ``key_rows``, the rows of that key.

    Only rows that pass ``may_repeat`` travel, and are stored for the exact count. There rows are
    counted per (key, salt). Keys of over ``SPREAD_ROWS`` rows are spread over ``SALTS`` tasks
    both in the counting and when their rows are joined back, and their totals see at most
    ``SALTS`` partial counts each. All others have one salt: a task counts such a key in one
    entry, and its rows end up next to each other. ``df`` is read twice.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    often = _often(hashed)
    # At most rows / SPREAD_ROWS of them.
    hot = often.where(F.col("_n") > SPREAD_ROWS).select("_hash", F.lit(True).alias("_hot"))
    passed = _passing(hashed, often).join(F.broadcast(hot), "_hash", "left")
    salt = F.pmod(F.xxhash64(row_id), F.lit(SALTS)).cast("int")
    salted = passed.withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0)).drop("_hot")
    salted = stored(salted, "zstd")
    # The hash in front makes the sorts of the join compare numbers instead of long keys.
    keys = ["_hash", *keys]
    parts = salted.groupBy(*keys, "_salt").agg(F.count("*").alias("_n"))
    totals = parts.groupBy(*keys).agg(
        F.sum("_n").alias("key_rows"), F.collect_list("_salt").alias("_salts")
    )
    repeated = totals.where("key_rows > 1").select(
        *keys, "key_rows", F.explode("_salts").alias("_salt")
    )
    return salted.join(repeated, [*keys, "_salt"]).drop("_hash", "_salt")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    skewed: bool = True,
    null_safe: bool = False,
    store: bool = True,
) -> DataFrame:
    """Inner or left join of ``rows`` to a lookup with one row per key, whatever the key skew.

    The lookup is computed once and measured, and a small one is broadcast. For a larger one the
    hot keys are counted out: there are at most rows / ``HOT_ROWS`` of them. Their rows spread
    over ``SALTS`` tasks, with their lookup rows repeated per salt; all other keys join as they
    are. Where keys are known to be unique among the rows too, ``skewed=False`` spares that, and
    ``store=False`` spares a lookup that is a plain scan of a stored table its second copy.

    With ``null_safe`` a NULL key equals a NULL key, and may be hot like any other; otherwise it
    matches nothing.
    """
    on = list(on)
    if store:
        lookup = checkpointed(lookup)
    if fits(lookup):
        return _join(rows, lookup, on, how, null_safe, F.broadcast)
    if not skewed:
        return _join(rows, lookup, on, how, null_safe)

    counts = rows.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > HOT_ROWS)
    hot = checkpointed(counts.select(*on, F.lit(True).alias("_hot")))
    loose = F.lit(False) if null_safe else reduce(or_, [F.col(c).isNull() for c in on])
    # Rows that match nothing may go anywhere.
    salted = _join(rows, hot, on, "left", null_safe, F.broadcast).withColumn(
        "_salt", F.when(F.col("_hot") | loose, _spread(rows)).otherwise(0)
    )
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1)))
    repeated = _join(lookup, hot, on, "left", null_safe, F.broadcast).withColumn(
        "_salt", F.explode(F.coalesce(salts, F.array(F.lit(0))))
    )
    return _join(
        salted.drop("_hot"), repeated.drop("_hot"), on, how, null_safe, also=["_salt"]
    ).drop("_salt")


def _join(rows, lookup, on, how, null_safe, side=lambda df: df, also=()) -> DataFrame:
    """The join by ``on`` and ``also``, the columns of ``on`` first, as a join by names has them."""
    if not null_safe:
        return rows.join(side(lookup), [*on, *also], how)
    theirs = {c: f"_key_{i}" for i, c in enumerate([*on, *also])}
    right = lookup.withColumnsRenamed(theirs)
    tests = [F.col(c).eqNullSafe(F.col(k)) for c, k in theirs.items()]
    others = [c for c in rows.columns if c not in on]
    added = [c for c in lookup.columns if c not in theirs]
    return rows.join(side(right), reduce(and_, tests), how).select(*on, *others, *added)
