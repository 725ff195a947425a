"""Faceted filters, date ranges and facet options."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import in_day_range

# Facets offered on the offer star, in display order.
FACETS = (
    "province", "canton", "field", "level", "modality", "provider_type", "funding_type", "status",
)


@dataclass(frozen=True)
class Filters:
    """Values wanted per facet (no values: no restriction) and an optional day range."""

    facets: Mapping[str, Sequence[str]] = field(default_factory=dict)
    days: tuple[dt.date, dt.date] | None = None


def apply_filters(df: DataFrame, filters: Filters, time: str = "ingested_at") -> DataFrame:
    """Rows that satisfy all facets and the day range; the conditions reach the scans."""
    for facet, wanted in filters.facets.items():
        if wanted:
            df = df.where(F.col(facet).isin(list(wanted)))
    if filters.days:
        df = df.where(in_day_range(F.col(time), *filters.days))
    return df


def facet_options(
    df: DataFrame, facets: Sequence[str] = FACETS, provinces: Sequence[str] = ()
) -> DataFrame:
    """Distinct non-NULL values per facet, from one pass over the rows.

    With ``provinces`` chosen, cantons are limited to those provinces.
    """

    def option(facet: str) -> Column:
        value = F.col(facet)
        if facet == "canton" and provinces:
            value = F.when(F.col("province").isin(list(provinces)), value)
        return F.struct(F.lit(facet).alias("facet"), value.alias("value"))

    pairs = df.select(F.explode(F.array(*[option(f) for f in facets])).alias("o")).select("o.*")
    return pairs.where("value is not null").distinct().orderBy("facet", "value")


def date_extent(df: DataFrame, time: str = "ingested_at") -> DataFrame:
    return df.agg(F.min(time).alias("first_at"), F.max(time).alias("last_at"))


def missing_text(value: Column) -> Column:
    """NULL or the empty string."""
    return value.isNull() | (value == "")
