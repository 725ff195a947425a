"""The offer star and the tables computed from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import lookup_join

PROGRAM = ("program", "field", "level", "modality")


def star(
    offers: DataFrame,
    providers: DataFrame,
    territories: DataFrame,
    programs: DataFrame,
    ledger: DataFrame,
) -> DataFrame:
    """Current offers with their three dimensions and the time their last file came in.

    After a load nearly all offers have one last file, and a provider may hold a third of them:
    all four sides are measured and joined as lookups.
    """
    dims = {
        "provider_id": providers.select(
            "provider_id", F.col("provider_norm").alias("provider"), "provider_type",
            "funding_type",
        ),
        "territory_id": territories.select(
            "territory_id", F.col("province_norm").alias("province"),
            F.col("canton_norm").alias("canton"),
        ),
        "program_id": programs.select(
            "program_id", F.col("program_norm").alias("program"),
            F.col("field_norm").alias("field"), F.col("level_norm").alias("level"),
            F.col("modality_norm").alias("modality"),
        ),
    }
    rows = offers.where("is_current").select(
        "offer_id", *dims, F.col("status_norm").alias("status"), "is_current", "last_seen_at",
        "last_file_id",
    )
    for key, dim in dims.items():
        rows = lookup_join(rows, dim, [key], "inner")
    files = ledger.select(F.col("file_id").alias("last_file_id"), "ingested_at")
    return lookup_join(rows, files, ["last_file_id"]).drop(*dims, "last_file_id")


def offers_per_province(
    offers: DataFrame, territories: DataFrame, weight: str | None = None
) -> DataFrame:
    """Offers per province, counted per territory key before the dimension is joined.

    ``weight`` names a column of rows already counted.
    """
    count = F.count("*") if weight is None else F.sum(weight)
    counted = offers.groupBy("territory_id").agg(count.alias("_n"))
    return (
        counted.join(territories.select("territory_id", "province_norm"), "territory_id")
        .groupBy(F.col("province_norm").alias("province"))
        .agg(F.sum("_n").alias("offers"))
    )


def top(df: DataFrame, measure: str, n: int, ascending: bool = False) -> DataFrame:
    """The ``n`` rows with the greatest (or least) measure; ties go by the other columns."""
    others = [c for c in df.columns if c != measure]
    first = F.asc(measure) if ascending else F.desc(measure)
    return df.orderBy(first, *others).limit(n)


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per non-NULL value, largest first, optionally only the ``n`` largest."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("offers"))
    return counts if n is None else top(counts, "offers", n)


def _distinct_rows(*columns: str):
    # A struct is never NULL, so combinations with NULL members are counted too.
    return F.countDistinct(F.struct(*columns))


def kpis(df: DataFrame) -> DataFrame:
    """One row of headline figures; a program is a combination of its four attributes."""
    return df.agg(
        F.count("*").alias("offers"),
        F.countDistinct("provider").alias("providers"),
        _distinct_rows(*PROGRAM).alias("programs"),
        F.countDistinct("province").alias("provinces"),
        F.countDistinct("canton").alias("cantons"),
    )


def coverage(df: DataFrame, by: str = "province") -> DataFrame:
    """Offers and distinct fields per non-NULL region."""
    return (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.count("*").alias("offers"), F.countDistinct("field").alias("field_diversity"))
    )


def canton_drill(df: DataFrame, province: str) -> DataFrame:
    """Offers per canton of one province."""
    return value_counts(df.where(F.col("province") == province), "canton")


def provider_profile(df: DataFrame, n: int = 15) -> DataFrame:
    """Offers, distinct fields and distinct levels of the largest providers."""
    combos = (
        df.where(F.col("provider").isNotNull())
        .groupBy("provider", "field", "level")
        .agg(F.count("*").alias("_n"))
    )
    profile = combos.groupBy("provider").agg(
        F.sum("_n").alias("offers"),
        F.countDistinct("field").alias("unique_fields"),
        F.countDistinct("level").alias("unique_levels"),
    )
    return profile.orderBy(F.desc("offers"), "provider").limit(n)


def region_values(features: DataFrame, counts: DataFrame, name: str) -> DataFrame:
    """Map features with the figures of the region of the same folded name."""
    return features.join(counts.withColumnRenamed(name, "name_norm"), "name_norm", "left")


def status_history(staging: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows per file and raw status, in arrival order; a NULL status keeps its own row.

    Rows are counted per file first; only the counts meet the ledger.
    """
    counts = staging.groupBy("file_id", "status").agg(F.count("*").alias("rows"))
    return counts.join(ledger.select("file_id", "ingested_at"), "file_id").orderBy(
        "ingested_at", "status"
    )
