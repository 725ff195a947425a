"""Exact deduplication by deterministic block naming.

Texts are cut into blocks of a fixed size. The distinct blocks are sorted, and each gets an
integer name; then each pair of adjacent names is named in the same way, and so on until every
document has one name. Two texts of as many blocks are equal exactly when their names are: a
name stands for one content, whatever hashes do. Hashes only deal out the work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import SPACE, maybe_in

BLOCK_CHARS = 4096
_KEY = ("id", "digest")


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def names(values: DataFrame) -> DataFrame:
    """A stored table with a ``name`` from 1 on for every distinct row of ``values``.

    Equal rows meet in one task, combined before they travel; there the distinct ones are sorted
    and numbered. A task that is run again sorts the same rows, so it gives the same names.
    The table holds every text once and stays, so it is packed tightly.
    """
    sorted_ = values.distinct().sortWithinPartitions(*values.columns)
    return stored(sorted_.withColumn("name", F.monotonically_increasing_id() + 1), "zstd")


def block_names(blocks: DataFrame) -> DataFrame:
    """Key, place and name of every block. ``blocks`` has the key, ``at`` and ``block``.

    Only hashes of the occurrences travel to the names. Should two different blocks have the
    same pair of hashes, those are joined by content.
    """
    hashes = {"h": F.xxhash64("block"), "g": F.xxhash64(F.lit(1), F.reverse("block"))}
    known = names(blocks.select("block")).withColumns(hashes)
    shared = known.groupBy("h", "g").agg(F.count("*").alias("n"), F.max("name").alias("name"))
    shared = stored(shared)
    keys = blocks.withColumns(hashes)
    found = keys.select(*_KEY, "at", "h", "g").join(
        shared.where("n = 1").select("h", "g", "name"), ["h", "g"]
    )
    found = found.select(*_KEY, "at", "name")
    if not (clash := shared.where("n > 1").select("h", "g")).isEmpty():
        of_both = known.join(clash, ["h", "g"]).select("h", "g", "block", "name")
        exact = keys.join(of_both, ["h", "g", "block"])
        found = found.unionByName(exact.select(*_KEY, "at", "name"))
    return found


def paired(state: DataFrame) -> DataFrame:
    """The next level: every document's names two by two, named again."""
    half = F.expr("sequence(0, cast((size(names) - 1) div 2 as int))")
    pairs = state.select(
        *_KEY,
        F.explode(
            F.transform(
                half,
                lambda i: F.struct(
                    i.alias("at"), F.get("names", 2 * i).alias("a"),
                    F.coalesce(F.get("names", 2 * i + 1), F.lit(0)).alias("b"),
                ),
            )
        ).alias("pair"),
    ).select(*_KEY, "pair.*")
    return pairs.join(names(pairs.select("a", "b")), ["a", "b"]).select(*_KEY, "at", "name")


def gathered(found: DataFrame) -> DataFrame:
    """Per key its names in order; repeated rows name the same blocks at the same places."""
    return found.groupBy(*_KEY).agg(
        F.count_if(F.col("at") == 0).alias("copies"),
        F.transform(
            F.array_sort(F.collect_set(F.struct("at", "name"))), lambda x: x["name"]
        ).alias("names"),
    )


def identities(docs: DataFrame, id_col: str, text_col: str, block_chars: int) -> DataFrame:
    """``id``, ``digest``, ``copies`` (equal rows) and the identity ``n_blocks``, ``name``."""
    texts = docs.select(docs[id_col].alias("id"), normalised(docs[text_col]).alias("text"))
    blocks = texts.select(
        "id", F.sha2("text", 256).alias("digest"),
        F.posexplode(
            F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(
                F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
            )
        ).alias("at", "block"),
    )
    state = stored(gathered(block_names(blocks)).withColumn("n_blocks", F.size("names")))
    done = state.where("n_blocks = 1")
    level, longest = state, state.agg(F.coalesce(F.max("n_blocks"), F.lit(0))).first()[0]
    while longest > 1:
        level = level.where(F.size("names") > 1)
        found = gathered(paired(level)).drop("copies")
        kept = level.select("id", "digest", "copies", "n_blocks")
        level = stored(
            kept.join(
                found.withColumnsRenamed({"id": "_id", "digest": "_digest"}),
                F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")),
            ).select(*kept.columns, "names")
        )
        done = done.unionByName(level.where(F.size("names") == 1))
        longest = (longest + 1) // 2
    return done.select(*kept_columns(), F.get("names", F.lit(0)).alias("name"))


def kept_columns() -> list[str]:
    return ["id", "digest", "copies", "n_blocks"]


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are after each run of ASCII white space became one blank. Of equal
    texts the row with the smallest id stays; NULL ids come last. A NULL text equals an empty one.
    Of rows that agree in id and text one stays, and each gives a row. Other columns are ignored,
    whatever their names. An empty table gives an empty result.

    A group's rows are counted before they travel, and the group is joined back by its name, so
    no task holds the rows of a large group.
    """
    rows = stored(identities(docs, id_col, text_col, block_chars))
    # As a table of its own the join's other side can be split where a group is large.
    groups = stored(
        rows.groupBy("n_blocks", "name").agg(
            F.min("id").alias("keep_id"), F.sum("copies").alias("group_size")
        )
    )
    found = rows.join(groups, ["n_blocks", "name"])
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))
    return found.withColumn("copy", copy).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_first(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns.

    Of rows that agree in id and text any one stays.
    """
    decided = stored(exact_dedup(docs, id_col, text_col))
    rows = decided.groupBy(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_digest")).agg(
        F.count("*").alias("copies"), F.max("kept").alias("kept")
    )
    # All but few documents stay as they are, and those need not travel.
    changed = stored(rows.where("NOT kept OR copies > 1").withColumn("_key", _row_key("_id", "_digest")))
    marked = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[id_col].alias("id"),
        F.sha2(normalised(docs[text_col]), 256).alias("digest"),
    )
    marked = maybe_in(marked, _row_key("id", "digest"), changed, "_key")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    doubtful = marked.where("_maybe").join(changed, same, "left")
    alone = doubtful.where("kept IS NULL").select("row")
    one = doubtful.where("kept").select("id", "digest", "row").dropDuplicates(["id", "digest"])
    found = marked.where("NOT _maybe").select("row").unionByName(alone)
    return found.unionByName(one.select("row")).select("row.*")


def _row_key(id_col: str, digest: str):
    return F.xxhash64(id_col, digest)
