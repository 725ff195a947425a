"""Service health followed as a stream: the latest check and the counts of every service."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contract import SERVICE_STATES, ddl
from ..sinks.tables import table_path
from ..sources.tables import or_none


def states(checks: DataFrame) -> DataFrame:
    """One row per service: its checks, how many found it in each state, and the latest one.

    Of checks at one moment the one with the greatest id, code and latency counts as the latest.
    The aggregates are of fixed size per service, so a stream keeps one row of state for each.
    """
    order = F.struct("created_at", "check_id", "status_code", "latency_ms")
    latest = F.struct("created_at", "endpoint", "status", "status_code", "latency_ms", "detail")
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in SERVICE_STATES]
    rows = checks.groupBy("service_name").agg(
        F.count("*").alias("checks"), *counts, F.max_by(latest, order).alias("latest")
    )
    return rows.select(*[c for c in rows.columns if c != "latest"], "latest.*")


def follow(
    spark: SparkSession, root: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Keep the states of all services up to date from the checks that are appended.

    The state lives in the stream's checkpoint, so a restart reads new checks alone. Every batch
    writes the services it changed to a folder of its own, which a repeated batch replaces;
    ``service_states`` reads the last row of each. With ``once`` the query stops when the present
    checks are read.
    """
    checks = spark.readStream.schema(ddl("ops/health")).parquet(table_path(root, "ops/health"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{_folder(root)}/batch={number}")

    writer = states(checks).writeStream.outputMode("update").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def service_states(spark: SparkSession, root: str) -> DataFrame | None:
    """The states as the last batch that changed each service left them; None before any."""
    rows = or_none(lambda: spark.read.parquet(_folder(root)))
    if rows is None:
        return None
    columns = [c for c in rows.columns if c not in ("service_name", "batch")]
    newest = F.max_by(F.struct(*columns), "batch").alias("s")
    return rows.groupBy("service_name").agg(newest).select("service_name", "s.*")


def _folder(root: str) -> str:
    return table_path(root, "ops/service_state")
