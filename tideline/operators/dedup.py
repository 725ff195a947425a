"""First, last and latest row per key, chosen by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], newest: bool) -> DataFrame:
    # A rank of one lets every map task drop all but its best row per key before the shuffle,
    # so a key holding much of the data sends one row per task. The hash in front makes the sort
    # compare numbers; long keys that begin alike would be compared letter by letter.
    ranked = [F.desc(c) if newest else F.asc(c) for c in order]
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*ranked)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest row of each key; NULL keys count as equal."""
    return _pick(df, keys, order, newest=False)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row of each key; NULL keys count as equal."""
    return _pick(df, keys, order, newest=True)


def latest_run(ledger: DataFrame) -> DataFrame:
    """The run ingested last."""
    return ledger.orderBy(F.desc("ingested_at"), F.desc("file_id")).limit(1)


def steps_of_latest_run(steps: DataFrame, ledger: DataFrame) -> DataFrame:
    """Steps of the run ingested last, in start order."""
    return steps.join(latest_run(ledger).select("file_id"), "file_id", "left_semi").orderBy(
        "started_at"
    )
