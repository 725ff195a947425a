"""Run, step and service monitoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import LOAD_METRICS, RECENT_CHECKS, RECENT_STEPS
from ..functions.structured import megabytes, metric_map, to_number
from ..functions.temporal import bucket_start
from .dedup import keep_last


def ingestion_series(ledger: DataFrame, bucket: str = "day") -> DataFrame:
    """Files and loaded, new, updated, unchanged and skipped rows per bucket of good runs."""
    sums = [
        F.coalesce(F.sum(F.col(name).cast("bigint")), F.lit(0)).alias(name)
        for name in LOAD_METRICS
    ]
    return (
        ledger.where("status = 'success'")
        .groupBy(bucket_start(bucket, F.col("ingested_at")).alias("period"))
        .agg(F.count("*").alias("files"), *sums)
        .orderBy("period")
    )


def pipeline_health(ledger: DataFrame) -> DataFrame:
    """Runs, per cent successful, mean seconds, and the mean of each run's rows per second."""
    seconds = F.col("duration_seconds")
    speed = F.when(seconds > 0, F.col("rows_loaded") / seconds)
    return ledger.agg(
        F.count("*").alias("runs"),
        (F.avg(F.when(F.col("status") == "success", 1.0).otherwise(0.0)) * 100).alias(
            "success_rate"
        ),
        F.avg(seconds).alias("avg_duration"),
        F.avg(speed).alias("avg_rows_per_second"),
    )


def file_sizes(ledger: DataFrame) -> DataFrame:
    """Source size in megabytes and duration per run, in arrival order."""
    return ledger.select(
        "file_id", "ingested_at", megabytes(F.col("file_size_bytes")).alias("file_size_mb"),
        "duration_seconds",
    ).orderBy("ingested_at")


def recent_steps(steps: DataFrame, limit: int = RECENT_STEPS) -> DataFrame:
    return steps.orderBy(F.desc("started_at"), "step_id").limit(limit)


def step_average(steps: DataFrame) -> DataFrame:
    """Mean seconds per step name, slowest first."""
    means = steps.groupBy("step_name").agg(F.avg("duration_seconds").alias("avg_seconds"))
    return means.orderBy(F.desc("avg_seconds"), "step_name")


def recent_checks(health: DataFrame, limit: int = RECENT_CHECKS) -> DataFrame:
    return health.orderBy(F.desc("created_at"), "check_id").limit(limit)


def service_latest(checks: DataFrame) -> DataFrame:
    """The last check of every service."""
    return keep_last(checks, ["service_name"], ["created_at", "check_id"])


def service_counts(checks: DataFrame) -> DataFrame:
    return checks.groupBy("service_name", "status").agg(F.count("*").alias("checks"))


def timeline(ledger: DataFrame, quality_runs: DataFrame) -> DataFrame:
    """Load figures per run and measure; figures the ledger lacks come from the quality run."""
    stored = metric_map(F.col("metrics"))
    measured = quality_runs.select(
        "file_id", *[F.element_at(stored, name).alias(f"_{name}") for name in LOAD_METRICS]
    )
    figures = ledger.join(measured, "file_id", "left").select(
        "file_id", "ingested_at",
        *[
            F.coalesce(to_number(F.col(name)), F.col(f"_{name}")).alias(name)
            for name in LOAD_METRICS
        ],
    )
    long = figures.unpivot(["file_id", "ingested_at"], list(LOAD_METRICS), "metric", "value")
    return long.where("value is not null")


def load_profile(rows: DataFrame, by: str = "file_id", *more: Column) -> DataFrame:
    """Rows, natural keys and distinct dimension members per file, and ``more`` aggregates."""
    return rows.groupBy(by).agg(
        F.count("*").alias("rows"),
        F.countDistinct("natural_key").alias("natural_keys"),
        F.countDistinct("provider_norm").alias("providers"),
        F.countDistinct(F.struct("province_norm", "canton_norm")).alias("territories"),
        F.countDistinct(
            F.struct("program_norm", "field_norm", "level_norm", "modality_norm")
        ).alias("programs"),
        *more,
    )


def dimension_counts(rows: DataFrame, by: str = "file_id") -> DataFrame:
    """Distinct dimension members per file; keys with NULL parts are members too."""
    return rows.groupBy(by).agg(
        F.countDistinct(F.struct("provider_norm")).alias("providers"),
        F.countDistinct(F.struct("province_norm", "canton_norm")).alias("territories"),
        F.countDistinct(
            F.struct("program_norm", "field_norm", "level_norm", "modality_norm")
        ).alias("programs"),
    )
