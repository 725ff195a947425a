"""Data-quality rules: a metric vector and an issue log per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import ISSUE_PREVIEW
from ..functions.keys import packed_digest, surrogate_id, unpacked_digest
from ..functions.structured import json_document
from ..session import scratch_scope, stored
from .filters import missing_text
from .skew import lookup_join, may_repeat, rows_of_repeated_keys

KEY = ("file_id", "natural_key")


def unmatched_territory() -> Column:
    return missing_text(F.col("province_norm")) | missing_text(F.col("canton_norm"))


def _mark_pairs(rows: DataFrame, catalog: DataFrame | None) -> DataFrame:
    """Adds ``bad_pair``: a matched territory the catalogue does not list."""
    if catalog is None:
        return rows.withColumn("bad_pair", F.lit(False))
    pairs = (
        catalog.select("province_norm", "canton_norm").distinct().withColumn("_ok", F.lit(True))
    )
    listed = lookup_join(rows, pairs, ["province_norm", "canton_norm"])
    return listed.withColumn(
        "bad_pair", F.col("_ok").isNull() & ~unmatched_territory()
    ).drop("_ok")


def duplicate_rows(rows: DataFrame) -> DataFrame:
    """All rows of keys that occur more than once in their file."""
    return rows_of_repeated_keys(rows, KEY, F.col("row_num"))


def conflicting_status(rows: DataFrame) -> DataFrame:
    """Keys with several non-NULL statuses, and these statuses in order of appearance."""
    states = (
        rows.where("status_norm is not null")
        .groupBy(*KEY, "status_norm")
        .agg(F.min("row_num").alias("first_row"))
    )
    listed = states.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("first_row", "status_norm"))).alias("s")
    )
    return listed.where(F.size("s") > 1).select(
        *KEY, F.transform("s", lambda x: x["status_norm"]).alias("states")
    )


def repeated_rows(rows: DataFrame) -> DataFrame:
    """What the key rules read of the rows whose key is repeated, stored for their several uses.

    Duplicates and conflicts of a key take at least two rows, so no other row matters to them.
    """
    packed = packed_digest(F.col("row_hash")).alias("row_hash")
    with scratch_scope(rows.sparkSession):
        found = duplicate_rows(rows.select(*KEY, "row_num", packed, "status_norm"))
        whole = found.withColumn("row_hash", unpacked_digest(F.col("row_hash")))
        return stored(whole, "zstd", keep=True)


def metrics(
    rows: DataFrame, catalog: DataFrame | None, repeated: DataFrame | None = None
) -> DataFrame:
    """One row per file and metric.

    Row rules are conditional counts of one pass. Key rules count per key, from partial counts of
    every task, so no key is gathered whole. They read ``repeated_rows`` if passed in, and
    otherwise the rows that may be such, which need not be singled out or joined back for that.
    """
    marked = _mark_pairs(rows, catalog)
    by_row = marked.groupBy("file_id").agg(
        F.count_if(unmatched_territory()).alias("invalid_territory"),
        F.count_if("bad_pair").alias("invalid_territory_pair"),
        F.count_if(F.col("provider").isNull()).alias("missing_NOMBRE_IES"),
        F.count_if(F.col("program").isNull()).alias("missing_NOMBRE_CARRERA"),
    )
    if repeated is None:
        # Rows of no file have no key to share.
        repeated = may_repeat(rows.select(*KEY, "status_norm").na.drop(subset=list(KEY)), KEY)
    else:
        repeated = repeated.withColumn("_hash", F.xxhash64(*KEY))
    per_key = repeated.groupBy("_hash", *KEY).agg(
        F.count("*").alias("n"), F.min("status_norm").alias("least"),
        F.max("status_norm").alias("greatest"),
    )
    by_key = per_key.where("n > 1").groupBy("file_id").agg(
        F.sum("n").alias("duplicates_in_file"),
        F.count_if(F.col("least") != F.col("greatest")).alias("conflicting_estado"),
    )
    # Both sides have one row per file.
    names = {c: F.lit(0) for c in ("duplicates_in_file", "conflicting_estado")}
    wide = lookup_join(by_row, by_key, ["file_id"], null_safe=True, skewed=False)
    wide = wide.withColumns({c: F.coalesce(F.col(c), zero) for c, zero in names.items()})
    return wide.unpivot(
        "file_id", [c for c in wide.columns if c != "file_id"], "metric", "value"
    )


def issues(
    rows: DataFrame, catalog: DataFrame | None, repeated: DataFrame | None = None
) -> DataFrame:
    """One row per finding, with a JSON detail.

    Row rules are read in one pass: each row carries its findings as an array. Duplicates and
    status conflicts come from ``repeated_rows``, which may be passed in.
    """
    nothing = F.lit(None).cast("struct<issue_type:string,detail:string>")

    def finding(condition: Column, kind: str, **detail: Column) -> Column:
        made = F.struct(
            F.lit(kind).alias("issue_type"), json_document(**detail).alias("detail")
        )
        return F.when(condition, made).otherwise(nothing)

    marked = _mark_pairs(rows, catalog)
    found = F.filter(
        F.array(
            finding(
                unmatched_territory(), "missing_territory_norm",
                provincia_original=F.col("province"), canton_original=F.col("canton"),
            ),
            finding(
                F.col("bad_pair"), "invalid_territory_pair",
                provincia_norm=F.col("province_norm"), canton_norm=F.col("canton_norm"),
            ),
            finding(
                F.col("provider").isNull(), "missing_nombre_ies", column=F.lit("NOMBRE_IES")
            ),
            finding(
                F.col("program").isNull(), "missing_nombre_carrera",
                column=F.lit("NOMBRE_CARRERA"),
            ),
        ),
        lambda f: f.isNotNull(),
    )
    by_row = (
        marked.select(*KEY, "row_num", F.explode(found).alias("f"))
        .select(*KEY, "row_num", "f.*")
    )
    repeated = repeated_rows(rows) if repeated is None else repeated
    duplicates = repeated.select(
        *KEY, "row_num", F.lit("duplicate_natural_key").alias("issue_type"),
        json_document(row_index=F.col("row_num") - 1, row_hash=F.col("row_hash")).alias("detail"),
    )
    conflicts = conflicting_status(repeated).select(
        *KEY, F.lit(None).cast("bigint").alias("row_num"),
        F.lit("conflicting_estado").alias("issue_type"),
        json_document(states=F.col("states")).alias("detail"),
    )
    return duplicates.unionByName(by_row).unionByName(conflicts)


def issue_log(found: DataFrame, run_id: Column, created_at: Column) -> DataFrame:
    """Issues with their identifiers and time, ready to be stored."""
    return found.select(
        surrogate_id(run_id, F.col("issue_type"), F.col("natural_key"), F.col("row_num")).alias(
            "issue_id"
        ),
        run_id.alias("run_id"), created_at.alias("created_at"), "issue_type", "natural_key",
        "detail", "file_id",
    )


def metric_document(long: DataFrame) -> DataFrame:
    """One JSON object of metrics per file."""
    pairs = F.array_sort(F.collect_list(F.struct("metric", "value")))
    return long.groupBy("file_id").agg(F.to_json(F.map_from_entries(pairs)).alias("metrics"))


def recent_issues(log: DataFrame, limit: int, types: list[str] | None = None) -> DataFrame:
    """The newest issues; a choice of types applies to those."""
    recent = log.orderBy(F.desc("created_at"), "issue_id").limit(limit)
    return recent.where(F.col("issue_type").isin(types)) if types else recent


def issue_types(log: DataFrame) -> DataFrame:
    kinds = log.where("issue_type is not null").select("issue_type").distinct()
    return kinds.orderBy("issue_type")


def preview(found: DataFrame) -> DataFrame:
    """The first issues of a report."""
    return found.orderBy("issue_type", "file_id", "natural_key", "row_num").limit(ISSUE_PREVIEW)
