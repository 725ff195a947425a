"""Dimension upserts and surrogate-key resolution."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import PROGRAM_KEY, PROVIDER_KEY, TERRITORY_KEY
from ..functions.keys import surrogate_id
from .skew import lookup_join


def _same_key(keys: Sequence[str]) -> Column:
    """NULL-safe equality of the keys of the sides aliased ``old`` and ``new``."""
    tests = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    return reduce(and_, tests)


def seen(
    staging: DataFrame, keys: Sequence[str], columns: Sequence[str], refresh: Sequence[str] = ()
) -> DataFrame:
    """Each dimension key of the staged files: ``columns`` from its first row, ``refresh`` from
    its first row in the last file that has it, and the times of these two files.

    ``staging`` has ``row_num``, unique and increasing in load order, and ``run_ts``, the load
    time of the file. The row numbers come from plain hash aggregates; their few results then
    pick their rows by number. Sorting all rows by key would cost far more.
    """
    per_file = staging.groupBy(*keys, "run_ts").agg(F.min("row_num").alias("n"))
    picks = F.array_distinct(F.array(F.min("n"), F.max_by("n", "run_ts")))
    numbers = per_file.groupBy(*keys).agg(picks.alias("n")).select(
        F.explode("n").alias("row_num")
    )
    wanted = list(dict.fromkeys([*keys, *columns, *refresh, "row_num", "run_ts"]))
    rows = lookup_join(staging.select(*wanted), numbers, ["row_num"], "inner", skewed=False)
    ends = rows.groupBy(*keys).agg(
        F.min_by(F.struct("run_ts", *columns), "row_num").alias("first"),
        F.max_by(F.struct("run_ts", *refresh), "row_num").alias("last"),
    )
    return ends.select(
        *keys, *[F.col(f"first.{c}") for c in columns], *[F.col(f"last.{c}") for c in refresh],
        F.col("first.run_ts").alias("seen_first"), F.col("last.run_ts").alias("seen_last"),
    )


def upsert(
    dim: DataFrame, incoming: DataFrame, keys: Sequence[str], id_column: str,
    refresh: Sequence[str],
) -> DataFrame:
    """The dimension after inserting new keys and refreshing some columns of the known ones.

    ``incoming`` comes from ``seen``. Keys compare NULL-safely, so a NULL key is one row however
    often it is loaded. All other attributes keep the value they were inserted with.
    """
    old = dim.alias("old")
    new = incoming.withColumn("_incoming", F.lit(True)).alias("new")
    both = old.join(new, _same_key(keys), "full_outer")
    known, arrived = F.col(f"old.{id_column}").isNotNull(), F.col("_incoming").isNotNull()
    made = surrogate_id(*[F.col(f"new.{k}") for k in keys])
    special = {
        id_column: F.coalesce(F.col(f"old.{id_column}"), made),
        "created_at": F.coalesce(F.col("old.created_at"), F.col("new.seen_first")),
        "updated_at": F.coalesce(F.col("new.seen_last"), F.col("old.updated_at")),
    }
    for name in dim.columns:
        if name not in special:
            mine, theirs = F.col(f"old.{name}"), F.col(f"new.{name}")
            fresh = F.when(arrived, theirs).otherwise(mine)
            special[name] = fresh if name in refresh else F.when(known, mine).otherwise(theirs)
    return both.select(*[special[name].alias(name) for name in dim.columns])


def insert_absent(
    dim: DataFrame, incoming: DataFrame, keys: Sequence[str], id_column: str
) -> DataFrame:
    """The dimension with the incoming keys it lacks added; known rows stay as they are."""
    fresh = incoming.alias("new").join(dim.alias("old"), _same_key(keys), "left_anti")
    made = fresh.withColumns(
        {
            id_column: surrogate_id(*[F.col(k) for k in keys]),
            "created_at": F.col("seen_first"),
            "updated_at": F.col("seen_first"),
        }
    )
    return dim.unionByName(made.select(*dim.columns))


def providers(dim: DataFrame, staging: DataFrame) -> DataFrame:
    """Providers; type and funding follow the latest file."""
    refresh = ["provider_type", "funding_type"]
    rows = seen(staging, PROVIDER_KEY, ["provider"], refresh)
    return upsert(dim, rows, PROVIDER_KEY, "provider_id", refresh)


def territories(dim: DataFrame, staging: DataFrame) -> DataFrame:
    """Territories with both parts known."""
    placed = staging.where("province_norm <> '' and canton_norm <> ''")
    rows = seen(placed, TERRITORY_KEY, ["province", "canton"])
    return insert_absent(dim, rows, TERRITORY_KEY, "territory_id")


def programs(dim: DataFrame, staging: DataFrame) -> DataFrame:
    rows = seen(staging, PROGRAM_KEY, ["program"])
    return insert_absent(dim, rows, PROGRAM_KEY, "program_id")


def resolve_ids(
    rows: DataFrame, provider: DataFrame, territory: DataFrame, program: DataFrame
) -> DataFrame:
    """Adds the three surrogate keys, NULL where a dimension has no such key.

    Dimensions are measured and joined as lookups, so rows don't travel while these are small,
    and a key that many rows have, or lack, doesn't gather in one task beyond that. Programs,
    which are most, come first: rows that travel for them don't carry the other identifiers yet.
    """
    added = ["provider_id", "territory_id", "program_id"]
    order = [*[c for c in rows.columns if c not in added], *added]
    rows = rows.drop(*added)
    for dim, keys, id_column in (
        (program, PROGRAM_KEY, "program_id"),
        (provider, PROVIDER_KEY, "provider_id"),
        (territory, TERRITORY_KEY, "territory_id"),
    ):
        rows = lookup_join(rows, dim.select(*keys, id_column), keys, null_safe=True)
    return rows.select(*order)


def resolved() -> Column:
    """True for rows that found all three dimensions."""
    return (
        F.col("provider_id").isNotNull()
        & F.col("territory_id").isNotNull()
        & F.col("program_id").isNotNull()
    )
