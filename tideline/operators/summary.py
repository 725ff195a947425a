"""A dataset summary as text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .marts import kpis

# How many entries each line of the summary lists.
SUMMARY_TOPS = {"status": 6, "modality": 6, "provider": 10, "province": 10, "canton": 10}


def top_counts(df: DataFrame, tops: Mapping[str, int]) -> DataFrame:
    """Per column the text ``a: 10, b: 7`` of its most frequent values, ``n/a`` without any.

    All columns are counted in one pass. Ranking keeps at most n values per column and map task
    before the shuffle, so nothing unbounded is gathered.
    """
    pairs = df.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("label"), F.col(c).alias("value")) for c in tops]
            )
        ).alias("p")
    ).select("p.*")
    counts = (
        pairs.where("value is not null").groupBy("label", "value").agg(F.count("*").alias("n"))
    )
    ranked = counts.withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "value")),
    ).where(F.col("rank") <= max(tops.values()))
    columns = []
    for name, n in tops.items():
        mine = (F.col("label") == name) & (F.col("rank") <= n)
        entry = F.struct("rank", F.concat_ws(": ", "value", F.col("n").cast("string")).alias("t"))
        texts = F.transform(
            F.array_sort(F.collect_list(F.when(mine, entry))), lambda e: e["t"]
        )
        text = F.array_join(texts, ", ")
        columns.append(F.when(text == "", F.lit("n/a")).otherwise(text).alias(f"top_{name}"))
    return ranked.agg(*columns)


def dataset_summary(df: DataFrame, first_day: str | None, last_day: str | None) -> DataFrame:
    """One row: the headline figures, the most frequent values and the whole as text."""
    parts = kpis(df).unionByName(top_counts(df, SUMMARY_TOPS), allowMissingColumns=True)
    whole = parts.agg(*[F.first(c, ignorenulls=True).alias(c) for c in parts.columns])
    days = f"{first_day} to {last_day}" if first_day and last_day else "n/a"
    # The lines of the summary.
    lines = [
        ("- Total active offers: ", F.col("offers").cast("string")),
        ("- Unique IES: ", F.col("providers").cast("string")),
        ("- Programs: ", F.col("programs").cast("string")),
        ("- Provinces covered: ", F.col("provinces").cast("string")),
        ("- Cantons covered: ", F.col("cantons").cast("string")),
        ("- Ingestion date range: ", F.lit(days)),
        ("- Offer status distribution (top): ", F.col("top_status")),
        ("- Modality distribution (top): ", F.col("top_modality")),
        ("- Top IES by offers: ", F.col("top_provider")),
        ("- Top provinces by offers: ", F.col("top_province")),
        ("- Top cantons by offers: ", F.col("top_canton")),
    ]
    text = F.concat_ws(
        "\n", F.lit("Dataset filtered summary"), *[F.concat(F.lit(a), b) for a, b in lines]
    )
    return whole.withColumn("summary", text)
