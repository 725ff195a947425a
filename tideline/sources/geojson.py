"""GeoJSON feature collections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import match_text

# Property names of the first and second administrative level.
PROVINCE, CANTON = "NAME_1", "NAME_2"
_FEATURE = "struct<type:string,properties:map<string,string>,geometry:string>"


def features(collections: DataFrame, name_key: str, text: str = "value") -> DataFrame:
    """One row per feature of JSON texts, with folded names.

    ``province_norm`` and ``canton_norm`` are NULL where a feature lacks the property. The
    geometry stays JSON text.
    """
    parsed = F.from_json(F.col(text), f"struct<features:array<{_FEATURE}>>")
    rows = collections.select(F.explode(parsed["features"]).alias("f")).select(
        "f.properties", "f.geometry"
    )

    def folded(key: str):
        return match_text(F.element_at("properties", F.lit(key)))

    def if_present(key: str):
        return F.when(F.map_contains_key("properties", F.lit(key)), folded(key))

    return rows.withColumns(
        {
            "name_norm": folded(name_key),
            "province_norm": if_present(PROVINCE),
            "canton_norm": if_present(CANTON),
        }
    )


def read_geojson(spark: SparkSession, path: str, name_key: str) -> DataFrame:
    return features(spark.read.text(path, wholetext=True), name_key)


def of_province(rows: DataFrame, province: str) -> DataFrame:
    """Features of one province (the canton view)."""
    return rows.where(F.col("province_norm") == province)
