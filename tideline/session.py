"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tideline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): str(v) for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only when nothing is named and the session itself is local.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tideline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: What ``stored`` and ``checkpointed`` wrote in each open ``scratch_scope``, the innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch_scope(spark: SparkSession):
    """Whatever the block puts into the scratch folder is deleted at its end.

    Frames made in the block must not be read after it, except what ``stored`` was told to keep.
    Files of shuffles go as soon as the query is over that made them, instead of when the driver
    happens to collect garbage.
    """
    mine: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), mine))
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        _SCOPES.reset(token)
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
        for path in mine:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            conf = spark.sparkContext._jsc.hadoopConfiguration()
            where.getFileSystem(conf).delete(where, True)


def _note(path: str, outer: bool = False) -> None:
    """Have ``path`` deleted with the innermost scope, or with the one around it."""
    scopes = _SCOPES.get()[: -1 if outer else None]
    if scopes:
        scopes[-1].append(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the scratch folder, with its lineage cut."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_dir(df.sparkSession))
    made = df.checkpoint()
    if _SCOPES.get():
        file = made._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            _note(file.get())
    return made


def stored(df: DataFrame, compression: str | None = None, keep: bool = False) -> DataFrame:
    """``df`` computed once as a Parquet table in the scratch folder, for rows read several times.

    Later reads fetch only the columns they need. ``compression`` is a codec for Parquet, the
    session's one by default. With ``keep`` the table outlives the ``scratch_scope`` it is made in.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/stored/{uuid.uuid4().hex}"
    _note(path, keep)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """A file scan with enough partitions for all cores.

    Large data has far more splits than there are cores and is left as it is. A few files, or
    one that cannot be split, would leave the work on them to a few tasks.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, *keys)
