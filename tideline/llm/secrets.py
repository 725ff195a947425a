"""Secret scans by corpus-wide ownership.

Candidates are found by patterns, and every candidate's hash is counted over the whole corpus:
by how many owners, and in how many of their repositories, it is used. A value that many owners
have is an example that was copied; one that few have looks live. Values that look live are
also found where no pattern of a credential names them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import equal_or_null

#: Fixed forms of candidates; the group is the value, and shorter ones fail.
KINDS = {
    "assign": (
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
#: Runs with a digit, from the start of the run.
BARE = r"(?<![A-Za-z0-9+_-])[A-Za-z+_-]*+[0-9][A-Za-z0-9+_-]*+"
BARE_CHARS = 16
#: Characters a bare run must have in different, unless a pattern found its value elsewhere.
BARE_DISTINCT = 12
#: A value with more owners than this is a copied example.
MAX_OWNERS = 2
SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


def matches(text: Column, pattern: str, group: int, rank: int) -> Column:
    """All leftmost matches that don't overlap, as (start, rank, end, value), in code points.

    What lies between the matches and the matches themselves alternate, so their lengths add up
    to positions.
    """
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    lengths = F.arrays_zip(
        F.transform(gaps, F.char_length).alias("gap"),
        F.transform(whole, F.char_length).alias("n"), value.alias("value"),
    )
    found = F.aggregate(
        F.filter(lengths, lambda x: x["n"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans")),
        lambda state, x: F.struct(
            (state["at"] + x["gap"] + x["n"]).alias("at"),
            F.concat(
                state["spans"],
                F.array(
                    F.struct(
                        (state["at"] + x["gap"]).alias("start"),
                        F.lit(rank).alias("rank"),
                        (state["at"] + x["gap"] + x["n"]).alias("end"),
                        x["value"].alias("value"),
                    )
                ),
            ).alias("spans"),
        ),
        lambda state: state["spans"],
    )
    # Most texts hold none, and one search that fails is all they cost.
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def long_enough(spans: Column, chars: int) -> Column:
    return F.filter(spans, lambda x: F.char_length(x["value"]) >= chars)


def of_rank(spans: Column, rank: int) -> Column:
    return F.filter(spans, lambda x: x["rank"] == rank)


def candidates(text: Column) -> tuple[Column, Column]:
    """Spans by the fixed forms, and spans of bare runs that touch none of those."""
    base = []
    for rank, (pattern, group, least) in enumerate(KINDS.values()):
        base.append(long_enough(matches(text, pattern, group, rank), least))
    bare = long_enough(matches(text, BARE, 0, len(KINDS)), BARE_CHARS)
    bare = F.filter(bare, lambda x: x["value"].rlike("[A-Za-z]"))
    return F.concat(*base), bare


def ownership(found: DataFrame) -> DataFrame:
    """Per hash its owners, its repositories, and whether a fixed form found it.

    ``found`` has ``hash``, ``owner``, ``repo`` and ``fixed``. Each step combines before rows
    travel, so a value copied everywhere stays a few rows.
    """
    each = found.groupBy("hash", "owner", "repo").agg(F.max("fixed").alias("fixed"))
    owners = each.groupBy("hash", "owner").agg(
        F.count("*").alias("repos"), F.max("fixed").alias("fixed")
    )
    return owners.groupBy("hash").agg(
        F.count("*").alias("n_owners"),
        F.sum("repos").alias("n_repos"),
        F.max("fixed").alias("fixed"),
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in [*KINDS, "live"]])
    parts = F.transform(
        F.array_sort(F.transform(spans, lambda x: F.struct(x["start"], x["rank"], x["end"]))),
        lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"], x["end"]),
    )
    return F.array_join(parts, ",")


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str = "doc_id",
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_assign``, ``n_access``, ``n_hex``,
    ``base_spans``, ``spans``, ``n_copied`` and ``n_live``.

    ``base_spans`` and ``spans`` are arrays of (start, rank, end, value), ``rank`` being the place
    in ``KINDS``. ``spans`` has the base ones and, of rank ``len(KINDS)``, bare runs of at least
    ``BARE_CHARS`` characters with a letter and a digit whose value has at most ``max_owners``
    owners, and either was found by a fixed form somewhere or has ``BARE_DISTINCT`` different
    characters. ``n_copied`` and ``n_live`` count the base spans by the owners of their value.

    A NULL text is empty. A NULL owner is an owner of its own. Equal rows count once as a
    repository and give a row each. Other columns are ignored, whatever their names. An empty
    table gives an empty result. Values leave a document only as hashes.
    """
    rows = docs.select(
        docs[id_col].alias("id"), docs[owner_col].alias("owner"), docs[repo_col].alias("repo"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )
    base, bare = candidates(F.col("text"))
    rows = rows.select(
        "id", "owner", "repo", F.xxhash64("text").alias("h"), F.char_length("text").alias("n"),
        base.alias("base"), bare.alias("bare"),
    ).withColumn(
        "bare",
        F.filter(
            "bare",
            lambda x: ~F.exists(
                "base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])
            ),
        ),
    )
    rows = stored(rows)
    key = ["id", "owner", "repo", "h", "n"]
    each = rows.where("size(base) + size(bare) > 0").distinct()
    found = each.select(*key, F.explode(F.concat("base", "bare")).alias("span")).withColumns(
        {
            "hash": F.sha2("span.value", 256),
            "fixed": F.col("span.rank") < len(KINDS),
        }
    )
    judged = found.join(ownership(found).withColumnRenamed("fixed", "known"), "hash")
    few = F.col("n_owners") <= max_owners
    diverse = F.size(F.array_distinct(F.split("span.value", ""))) >= BARE_DISTINCT
    verdicts = judged.groupBy(*key).agg(
        F.count_if(F.col("fixed") & ~few).alias("n_copied"),
        F.count_if(F.col("fixed") & few).alias("n_live"),
        F.collect_list(
            F.when(~F.col("fixed") & few & (F.col("known") | diverse), F.col("span"))
        ).alias("more"),
    ).withColumnsRenamed({c: f"_{c}" for c in key})
    same = reduce(Column.__and__, [equal_or_null(F.col(c), F.col(f"_{c}")) for c in key])
    nothing = F.array().cast(SPAN)
    count = {
        f"n_{kind}": F.size(of_rank(F.col("base"), rank)).cast("bigint")
        for rank, kind in enumerate(KINDS)
    }
    return rows.join(verdicts, same, "left").select(
        F.col("id").alias(id_col),
        *[c.alias(name) for name, c in count.items()],
        F.col("base").alias("base_spans"),
        F.concat("base", F.coalesce("more", nothing)).alias("spans"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
    )
