"""The run ledger: appended events, reduced to one current row per file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import lookup_join

def current_state(events: DataFrame) -> DataFrame:
    """One row per file: every column holds the last non-NULL value its events wrote."""
    order = F.struct("event_at", "event_seq")
    columns = [c for c in events.columns if c not in ("file_id", "event_seq", "event_at")]
    return events.groupBy("file_id").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    )


def already_loaded(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose content a successful run has loaded, with that run's ``file_id``.

    Any number of files may share one content, so the ledger is joined as a measured lookup.
    """
    good = ledger.where("status = 'success'")
    done = good.groupBy("checksum").agg(F.min("file_id").alias("file_id"))
    return lookup_join(files, done, ["checksum"], "inner")


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose content no successful run has loaded; failed ones come up again."""
    done = ledger.where("status = 'success'").select("checksum").distinct()
    marked = lookup_join(files, done.withColumn("_done", F.lit(True)), ["checksum"])
    return marked.where("_done is null").drop("_done")


def run_states(ledger: DataFrame) -> DataFrame:
    counts = ledger.where("status is not null").groupBy("status")
    return counts.agg(F.count("*").alias("runs"))


def storage_states(ledger: DataFrame) -> DataFrame:
    """Runs by what became of their artefacts; a run that says nothing is ``unknown``."""
    state = F.coalesce("storage_status", F.lit("unknown")).alias("storage_status")
    return ledger.groupBy(state).agg(F.count("*").alias("runs"))
