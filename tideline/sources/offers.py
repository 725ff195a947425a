"""Published offer files: column check, header discovery, row numbers."""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import (
    DUPLICATE_COLUMNS, HEADER_SCAN, MISSING_TEXTS, REQUIRED, SOURCE_COLUMNS,
)
from ..functions.text import column_name, column_name_expr, to_ascii
from ..operators.skew import lookup_join
from ..session import spread, stored


def canonical_names(names: Sequence[str]) -> list[str]:
    """Canonical column names in order. It is an error if different columns get one name."""
    found = [column_name(name) for name in names]
    uses = Counter(found)
    clashing = [old for old, new in zip(names, found) if uses[new] > 1]
    if clashing:
        raise ValueError(f"{DUPLICATE_COLUMNS}: {', '.join(map(repr, clashing))}")
    return found


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*canonical_names(df.columns))


def missing_columns(names: Sequence[str], required: Sequence[str] = REQUIRED) -> list[str]:
    return [c for c in required if c not in names]


def _demand(names: Sequence[str], required: Sequence[str]) -> None:
    missing = missing_columns(names, required)
    if missing:
        raise ValueError(f"Missing columns: {missing}")


def find_header(
    cells: DataFrame, required: Sequence[str] = REQUIRED, max_scan: int = HEADER_SCAN
) -> tuple[int, list[str]] | None:
    """Position and cells of the first row, among the first ``max_scan``, that names all
    required columns.

    ``cells`` has ``pos`` (from 0) and text columns. Only the scanned rows are read out, and only
    the header row reaches the driver.
    """
    columns = [c for c in cells.columns if c != "pos"]
    row = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    wanted = F.array(*[F.lit(c) for c in required])
    found = (
        cells.where(F.col("pos") < max_scan)
        .select("pos", row.alias("row"))
        .where(F.size(F.array_except(wanted, F.transform("row", column_name_expr))) == 0)
        .orderBy("pos")
        .first()
    )
    return (found["pos"], list(found["row"])) if found else None


def rows_below_header(
    cells: DataFrame, required: Sequence[str] = REQUIRED, max_scan: int = HEADER_SCAN
) -> DataFrame:
    """Data rows of a cell table under its header row, named, with ``row_num`` from 1."""
    header = find_header(cells, required, max_scan)
    if header is None:
        raise ValueError(f"Missing columns: {list(required)}")
    pos, names = header
    columns = [c for c in cells.columns if c != "pos"]
    named = [(c, n) for c, n in zip(columns, names) if n]
    canonical = canonical_names([n for _, n in named])
    return cells.where(F.col("pos") > pos).select(
        (F.col("pos") - pos).alias("row_num"),
        *[F.col(c).alias(n) for (c, _), n in zip(named, canonical)],
    )


def drop_empty(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Without the rows that lack every required value; row numbers stay as they were."""
    return df.na.drop("all", subset=list(required))


def _preview(spark: SparkSession, path: str, sep: str, rows: int) -> list[list[str]]:
    """The first records that are not blank (a bounded read of the start of one file)."""
    lines = spark.read.text(path).limit(rows).collect()
    text = [f"{line['value']}\n".lstrip("\ufeff") for line in lines]
    return [cells for cells in csv.reader(text, delimiter=sep) if any(c.strip() for c in cells)]


def _header_cells(
    spark: SparkSession, path: str, sep: str, required: Sequence[str]
) -> list[str]:
    """The cells of a header: among the first records, or else in a part file further on."""
    preview = _preview(spark, path, sep, HEADER_SCAN)
    for cells in preview:
        if not missing_columns([column_name(c) for c in cells], required):
            return cells
    named = F.transform(F.split("value", re.escape(sep)), column_name_expr)
    wanted = F.array(*[F.lit(c) for c in required])
    # Names are made of cells only where a line holds all their words; hardly any other does.
    folded = F.upper(to_ascii(F.col("value")))
    words = dict.fromkeys(w for name in required for w in re.findall("[A-Z0-9]+", name))
    lines = spark.read.text(path).where(reduce(and_, [folded.contains(w) for w in words]))
    lines = lines.where(F.size(F.array_except(wanted, named)) == 0)
    if line := lines.first():
        return next(csv.reader([line["value"]], delimiter=sep))
    first = preview[0] if preview else []
    missing = missing_columns([column_name(c) for c in first], required)
    raise ValueError(f"Missing columns: {missing}")


def file_offsets(counts: DataFrame) -> DataFrame:
    """``_file`` and ``_above``, the rows of all files before it by path. ``counts`` has a row
    per file with its rows ``_n``."""
    return counts.select("_file", _before("_n", Window.orderBy("_file")).alias("_above"))


def number_cells(read: DataFrame) -> DataFrame:
    """The records of ``read`` stored once, with their ``_file`` and ``_pos`` in it from 0.

    Records are counted per file block in parallel; only the block counts are summed up and
    joined back, so no sort or single task sees the records themselves. Counts and records come
    from the one stored table: how the files were split up while it was written doesn't matter
    to anything that reads it. A record without an offset is an error, never left out.
    """
    block = ["_file", "_block"]
    cells = spread(
        stored(
            read.select(
                F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_block_start").alias("_block"),
                F.monotonically_increasing_id().alias("_id"),
                "*",
            ),
            "zstd",
        ),
        "_id",
    )
    blocks = cells.groupBy(*block).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    in_file = Window.partitionBy("_file").orderBy("_block")
    offsets = blocks.select(*block, (_before("_n", in_file) - F.col("_first")).alias("_offset"))
    placed = lookup_join(cells, offsets, block)
    found = F.coalesce("_offset", F.raise_error(F.lit("a record has no place in its file")))
    return placed.withColumn("_pos", found + F.col("_id")).drop("_block", "_id", "_offset")


def _before(value: Column | str, order: WindowSpec) -> Column:
    """Sum of ``value`` over the earlier rows."""
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def read_records(
    spark: SparkSession, path: str, names: Sequence[str], sep: str, multiline: bool
) -> DataFrame:
    """All records of delimited files as text columns, and ``_corrupt`` for those that are not
    as wide as ``names``. A quote inside a quoted cell is doubled."""
    kinds = [T.StructField(n, T.StringType()) for n in [*names, "_corrupt"]]
    options = {
        "header": False, "sep": sep, "quote": '"', "escape": '"', "multiLine": multiline,
        "columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE",
    }
    return spark.read.schema(T.StructType(kinds)).options(**options).csv(path)


def read_csv(
    spark: SparkSession, path: str, required: Sequence[str] = REQUIRED, sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """Delimited files as canonical text columns plus ``row_num``, numbered through by path.

    Each file's header is the first of its leading records that names all required columns; what
    stands above is left out. A file without a header, as part files have, loses nothing. Files
    with different headers are an error, and so is any record below the header that isn't as
    wide as it: nothing is cut or filled up. Cells with line breaks need ``multiline``, which
    reads each file in one task; without it their records are of the wrong width, and reported.
    Empty cells are NULL.
    """
    raw = _header_cells(spark, path, sep, required)
    names = canonical_names([n if n else f"unnamed {i}" for i, n in enumerate(raw)])
    cells = number_cells(read_records(spark, path, names, sep, multiline))

    # One row per file: its header, if it has one.
    first_cells = [F.regexp_replace(F.coalesce(n, F.lit("")), "^\ufeff", "") for n in names]
    row = F.transform(F.array(*first_cells), column_name_expr)
    wanted = F.array(*[F.lit(c) for c in required])
    top = cells.select("_file", "_pos", row.alias("_row"))
    # In one condition: names alone would be looked for in every record, before it has its place.
    named = F.when(F.col("_pos") < HEADER_SCAN, F.size(F.array_except(wanted, F.col("_row"))) == 0)
    headers = top.where(named).groupBy("_file").agg(F.min(F.struct("_pos", "_row")).alias("_head"))
    counts = cells.groupBy("_file").agg(F.count("*").alias("_all"))
    files = counts.join(headers, "_file", "left").select(
        "_file", "_head._row", F.coalesce("_head._pos", F.lit(-1)).alias("_header"),
        (F.col("_all") - F.coalesce("_head._pos", F.lit(-1)) - 1).alias("_n"),
    )
    files = stored(files)
    if files.where("_row IS NOT NULL").isEmpty():
        raise ValueError(f"Missing columns: no header in the first {HEADER_SCAN} records")
    due = F.array(*[F.lit(column_name(c)) for c in raw])
    other = files.where(F.col("_row").isNotNull() & (F.col("_row") != due)).first()
    if other:
        raise ValueError(f"{other['_file']} has another header: {other['_row']}")
    above = files.select("_file", "_header").join(file_offsets(files), "_file")
    placed = lookup_join(cells, above, ["_file"]).where(F.col("_pos") > F.col("_header"))
    wrong = placed.where("_corrupt IS NOT NULL").select("_file", "_pos", "_corrupt").first()
    if wrong:
        raise ValueError(
            f"{wrong['_file']}: record {wrong['_pos']} has not {len(names)} cells; cells with "
            f"line breaks need multiline=True: {wrong['_corrupt']!r}"
        )
    return placed.select(
        (F.col("_above") + F.col("_pos") - F.col("_header")).alias("row_num"),
        *[F.when(~F.col(n).isin(*MISSING_TEXTS), F.col(n)).alias(n) for n in names],
    )


def read_parquet(
    spark: SparkSession, path: str, required: Sequence[str] = REQUIRED
) -> DataFrame:
    """Parquet files as canonical columns plus ``row_num``, numbered through by path."""
    df = spark.read.parquet(path)
    names = canonical_names(df.columns)
    _demand(names, required)
    renamed = [F.col(f"`{old}`").alias(new) for old, new in zip(df.columns, names)]
    # The format itself numbers the rows of a file.
    located = df.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_pos"),
        *renamed,
    )
    counts = located.groupBy("_file").agg(F.count("*").alias("_n"))
    placed = lookup_join(located, file_offsets(counts), ["_file"])
    return placed.select((F.col("_above") + F.col("_pos") + 1).alias("row_num"), *names)


def read_offers(
    spark: SparkSession,
    path: str,
    required: Sequence[str] = REQUIRED,
    sep: str = ",",
    format: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """The required columns of a published file under their neutral names, with ``row_num``.

    ``format`` is ``csv`` or ``parquet``, by default told from the name; ``multiline`` is for
    delimited files whose cells hold line breaks. Extra columns are
    dropped, and so are rows that lack every required value.
    """
    kind = format or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if kind == "parquet":
        df = read_parquet(spark, path, required)
    else:
        df = read_csv(spark, path, required, sep, multiline)
    return drop_empty(df, required).select(
        F.col("row_num").cast("bigint").alias("row_num"),
        *[F.col(c).cast("string").alias(SOURCE_COLUMNS.get(c, c)) for c in required],
    )
