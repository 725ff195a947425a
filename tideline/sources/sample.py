"""Offers, runs and services played by the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import natural_key, row_hash
from ..functions.text import normalize_value
from ..operators.skew import lookup_join
from ..session import spread

# Together these order all rows; the first two columns alone repeat.
ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
)


# Stated schemas spare a read of the file footers per scan.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def territories(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("territory_id"), F.col("r_name").alias("province"),
        F.col("n_name").alias("canton"), normalize_value(F.col("r_name")).alias("province_norm"),
        normalize_value(F.col("n_name")).alias("canton_norm"),
    )


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        "s_suppkey", "s_nationkey", F.col("s_name").alias("provider"),
        F.when(F.col("s_acctbal") >= 5000, "TYPE A").otherwise("TYPE B").alias("provider_type"),
        F.element_at(
            F.array(F.lit("PUBLIC"), F.lit("PRIVATE"), F.lit("MIXED")),
            (F.col("s_suppkey") % 3 + 1).cast("int"),
        ).alias("funding_type"),
        normalize_value(F.col("s_name")).alias("provider_norm"),
    )


def parts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey", F.col("p_name").alias("program"), F.col("p_type").alias("field"),
        F.col("p_brand").alias("level"), normalize_value(F.col("p_name")).alias("program_norm"),
        normalize_value(F.col("p_type")).alias("field_norm"),
        normalize_value(F.col("p_brand")).alias("level_norm"),
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """A ledger with one run per order year, taken from the orders of that year."""
    year = F.year("o_orderdate").cast("string")
    return table(spark, folder, "orders").groupBy(year.alias("file_id")).agg(
        F.max("o_orderdate").alias("ingested_at"), F.count("*").alias("orders")
    )


def offers(spark: SparkSession, folder: str) -> DataFrame:
    """Raw and normalised offers of all runs; names are normalised on the dimension rows."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("o_priority"),
        F.year("o_orderdate").cast("string").alias("file_id"),
        F.make_timestamp(
            F.year("o_orderdate"), F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)
        ).cast("timestamp_ntz").alias("run_ts"),
        normalize_value(F.col("o_orderstatus")).alias("status_norm"),
    )
    lines = spread(table(spark, folder, "lineitem"), "l_orderkey").select(
        *ORDER, F.col("l_returnflag").alias("modality"),
        normalize_value(F.col("l_returnflag")).alias("modality_norm"),
        # Increasing in (order, line); the price in cents tells the few repeated lines apart.
        (
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000_000
            + F.round(F.col("l_extendedprice") * 100).cast("bigint") % 1_000_000_000
        ).alias("row_num"),
    )
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts(spark, folder), F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers(spark, folder), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(territories(spark, folder), F.col("s_nationkey") == F.col("territory_id"))
    )


def with_key(rows: DataFrame) -> DataFrame:
    """Adds the natural key."""
    key = natural_key(
        *[
            F.col(f"{n}_norm")
            for n in ("provider", "program", "field", "level", "modality", "province", "canton")
        ]
    )
    return rows.withColumn("natural_key", key)


def with_hash(rows: DataFrame) -> DataFrame:
    """Adds the row hash of natural key and status."""
    return rows.withColumn("row_hash", row_hash(F.col("natural_key"), F.col("status_norm")))


def keyed(rows: DataFrame) -> DataFrame:
    """Adds natural key and row hash."""
    return with_hash(with_key(rows))


def star_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Offers with the columns the marts read."""
    return offers(spark, folder).select(
        *ORDER, "provider", "provider_type", "funding_type", "program", "field", "level",
        "modality", "province", "canton", "status", "file_id",
    )


def timed_star(spark: SparkSession, folder: str) -> DataFrame:
    """``star_rows`` with the arrival time of each run."""
    return lookup_join(star_rows(spark, folder), runs(spark, folder).drop("orders"), ["file_id"])


def spoiled_province(province: Column, number: Column) -> Column:
    """Province names as careless sources write them, five ways by number."""
    return (
        F.when(number % 5 == 0, province)
        .when(number % 5 == 1, F.lower(province))
        .when(number % 5 == 2, F.concat(F.lit("  "), province, F.lit(" ")))
        .when(
            number % 5 == 3,
            F.concat(F.substring(province, 1, 1), F.substring(province, 3, 1000)),
        )
        .otherwise("unknown")
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Provinces and cantons with their catalogue position."""
    return territories(spark, folder).select(
        "province_norm", "canton_norm", F.col("territory_id").alias("ordinal")
    )


def event_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Runs played by the event stream."""
    kind = F.col("event_type")
    number = F.col("event_id")
    return table(spark, folder, "events").select(
        number.cast("string").alias("file_id"), F.col("ts").alias("ingested_at"),
        F.when(kind == "error", "failed").when(kind == "signup", "running").otherwise("success")
        .alias("status"),
        (number % 1000).alias("rows_loaded"),
        F.when(number % 7 != 0, number % 13).alias("ingest_new"),
        (number % 5).alias("ingest_updated"),
        F.lit(None).cast("bigint").alias("ingest_unchanged"),
        F.when(number % 3 == 0, number % 2).alias("skipped_missing_dims"),
        F.col("value").alias("duration_seconds"), (F.col("user_id") * 1000).alias(
            "file_size_bytes"
        ),
    )


def event_steps(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("step_id"), F.col("user_id").cast("string").alias("file_id"),
        F.col("event_type").alias("step_name"), F.col("ts").alias("started_at"),
        F.col("value").alias("duration_seconds"),
    )


def event_health(spark: SparkSession, folder: str) -> DataFrame:
    """Service checks played by the event stream, with the answer code as received."""
    kind = F.col("event_type")
    code = (
        F.when(kind == "error", 503).when(kind == "view", 404).when(kind != "signup", 200)
    )
    return table(spark, folder, "events").select(
        F.col("event_id").alias("check_id"), F.col("user_id").alias("service_name"),
        F.col("ts").alias("created_at"), F.col("value").alias("latency_ms"), code.alias("code"),
    )
