"""Files loaded as they arrive in a landing folder."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import load_files

log = logging.getLogger(__name__)


def start(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    catalog_path: str | None = None,
    pattern: str = "*.csv",
    once: bool = True,
    files_per_load: int = 50,
) -> StreamingQuery:
    """Load each new file of ``landing`` as one run, in order of arrival.

    Files that wait together are settled together, ``files_per_load`` at most; the result is
    that of loading them one by one. A file without the required columns, or that cannot be read,
    is recorded as failed and the others are loaded; ``ingest.retry_failed`` offers it again.

    The stream only tells which files are new; it carries paths, not content. A file that comes
    up again after a crash is recognised by its checksum, so it is loaded exactly once. With
    ``once`` the query stops when the present files are loaded.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_load)
        .load(landing)
        .select("path", "modificationTime")
    )

    def load(batch: DataFrame, _: int) -> None:
        # At most files_per_load paths.
        paths = [r["path"] for r in batch.orderBy("modificationTime", "path").collect()]
        for result in load_files(batch.sparkSession, root, paths, catalog_path, strict=False):
            if result["status"] in ("unreadable", "failed"):
                log.warning("passed over a file: %s", result["error"])

    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
