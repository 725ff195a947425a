"""Concentration and entropy of a category within groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diversity(df: DataFrame, group: str, category: str) -> DataFrame:
    """Herfindahl index and Shannon entropy (bits) of ``category`` per non-NULL ``group``.

    Both come from counts n with sum N in one pass: sum(n^2)/N^2 and log2(N) - sum(n log2 n)/N.
    NULL categories are left out; a group without any category gets zeros.
    """
    counts = (
        df.where(F.col(group).isNotNull())
        .groupBy(group, category)
        .agg(F.count(category).cast("double").alias("_n"))
    )
    total = F.nullif(F.sum("_n"), F.lit(0.0))
    weighted = F.sum(F.when(F.col("_n") > 0, F.col("_n") * F.log2("_n")).otherwise(0.0))
    return counts.groupBy(group).agg(
        F.coalesce(F.sum(F.col("_n") * F.col("_n")) / (total * total), F.lit(0.0)).alias("hhi"),
        F.coalesce(F.abs(F.log2(total) - weighted / total), F.lit(0.0)).alias("entropy"),
    )
