"""Mixing sources to target weights by a proportionally fair schedule.

Documents of a source are put in an order that depends on their ids alone and cut into blocks.
A source of weight w, out of all weights W, has its j-th block released at slot
floor((j - 1) W / w) and due by ceil(j W / w); at every slot the released block with the earliest
deadline goes out. Weights that sum up to one share of the slots always meet all deadlines, so
at any time each source has sent less than one block more or less than its share.

The schedule repeats after W slots, when each source has sent w blocks. So only these W slots
are scheduled, by a fold in SQL, and every block of a table of any size finds its slot by
arithmetic. Where a source has ended, its slots are left out and the others keep their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import token

BLOCK_DOCS = 64
#: The sum of all weights, at most; the schedule of one period has as many rows.
MAX_PERIOD = 10_000
#: Documents that are numbered together in one range of the order, about.
NUMBERED_ROWS = 100_000


def schedule(spark: SparkSession, weights: list[int]) -> DataFrame:
    """One period: a row per slot with ``k`` (the source), ``nth`` (its block, from 0),
    ``slot``, ``release``, ``deadline`` and ``before``, each source's blocks in earlier slots."""
    period, count = sum(weights), len(weights)
    if not 0 < period <= MAX_PERIOD or min(weights) <= 0:
        raise ValueError(f"weights must be positive and sum up to {MAX_PERIOD} at most")
    share = F.array(*[F.lit(w) for w in weights])

    def due(sent: Column, t: Column) -> Column:
        """The most urgent block that is released, as (deadline, source, release)."""

        def block(k: Column) -> Column:
            w, done = F.get(share, k), F.get(sent, k)
            release = F.floor(done * period / w).cast("int")
            deadline = F.ceil((done + 1) * period / w).cast("int")
            ready = (done < w) & (release <= t)
            return F.when(
                ready,
                F.struct(deadline.alias("deadline"), k.alias("k"), release.alias("release")),
            )

        return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), block))

    def step(state: Column, t: Column) -> Column:
        # The list of one element makes the choice once, however often it is used.
        return F.get(
            F.transform(
                F.array(due(state["sent"], t)),
                lambda pick: F.struct(
                    F.transform(
                        state["sent"], lambda n, k: n + F.when(k == pick["k"], 1).otherwise(0)
                    ).alias("sent"),
                    F.concat(
                        state["picks"],
                        F.array(
                            F.struct(
                                t.alias("slot"), pick["k"].alias("k"),
                                F.get(state["sent"], pick["k"]).alias("nth"),
                                pick["release"].alias("release"),
                                pick["deadline"].alias("deadline"),
                                state["sent"].alias("before"),
                            )
                        ),
                    ).alias("picks"),
                ),
            ),
            0,
        )

    empty = (
        "array<struct<slot:int,k:int,nth:int,release:int,deadline:int,before:array<int>>>"
    )
    start = F.struct(
        F.array_repeat(F.lit(0), count).alias("sent"), F.array().cast(empty).alias("picks")
    )
    slots = F.sequence(F.lit(0), F.lit(period - 1))
    one = spark.range(1, numPartitions=1)
    return one.select(F.inline(F.aggregate(slots, start, step)["picks"]))


def order_key(docs: DataFrame, id_col: str) -> Column:
    """What documents of a source are ordered by: a digest of the id; without one, of the row."""
    others = [docs[c] for c in docs.columns if c != id_col]
    return F.md5(F.coalesce(docs[id_col].cast("string"), F.hex(F.xxhash64(*others))))


def placed(docs: DataFrame, weights: dict[str, int], other: int, block_docs: int,
           id_col: str, source_col: str) -> DataFrame:
    """Every row of ``docs`` as ``row``, with its block and its place in the mixture."""
    spark = docs.sparkSession
    shares = [*weights.values(), other]
    source = F.lit(len(weights))
    for k, name in enumerate(weights):
        source = F.when(docs[source_col] == name, k).otherwise(source)
    keyed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[id_col].alias("id"),
        source.alias("k"),
        order_key(docs, id_col).alias("key"),
    )
    # Ranges of the key, 256 or more, hold NUMBERED_ROWS rows of all sources together at most.
    total, digits = docs.count(), 2
    while total / 16**digits > NUMBERED_ROWS:
        digits += 1
    keyed = keyed.withColumn("part", F.substring("key", 1, digits))
    sizes = stored(keyed.groupBy("k", "part").agg(F.count("*").alias("n")))
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("k", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("k", "part").orderBy("key", "id", token(F.col("row")))
    numbered = keyed.withColumn("in_part", F.row_number().over(within) - 1).join(
        starts, ["k", "part"]
    )
    nth = F.col("start") + F.col("in_part")

    # One number per source of the weights.
    ends = {r["k"]: r["n"] for r in sizes.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    period = sum(shares)
    share = F.array(*[F.lit(w) for w in shares])
    numbered = numbered.withColumns({"block": F.floor(nth / block_docs), "offset": nth % block_docs})
    numbered = numbered.withColumns(
        {
            "round": F.floor(F.col("block") / F.get(share, F.col("k"))),
            "nth": (F.col("block") % F.get(share, F.col("k"))).cast("int"),
        }
    )
    slots = F.broadcast(schedule(spark, shares))
    found = numbered.join(slots, ["k", "nth"])
    sent = F.lit(0).cast("bigint")
    for k, w in enumerate(shares):
        blocks = F.col("round") * w + F.get("before", F.lit(k))
        sent = sent + F.least(F.lit(ends.get(k, 0)), blocks * block_docs)
    base = F.col("round") * period
    return found.select(
        "row", "k", "block",
        (base + F.col("release")).alias("release"),
        (base + F.col("deadline")).alias("deadline"),
        (base + F.col("slot")).alias("slot"),
        (sent + F.col("offset")).cast("bigint").alias("position"),
    )


def mix_sources(
    docs: DataFrame,
    weights: dict[str, int],
    other: int,
    block_docs: int = BLOCK_DOCS,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: its id and source, ``block`` (counted from 0 in its source),
    ``release``, ``deadline`` and ``slot`` of that block, and ``position`` in the whole mixture.

    ``weights`` names sources; all others, NULL included, share the weight ``other`` as one
    source. Positions count from 0 without gaps, in the order of slots. Nothing is dropped: when
    a source ends early, the mixture goes on without it. Ties in the order of ids go by the row's
    content; equal rows get neighbouring positions. NULL ids are ordered by the row's content.
    Texts may be anything. Other columns are ignored, whatever their names. An empty table gives
    an empty result.
    """
    found = placed(
        docs.select(id_col, source_col), weights, other, block_docs, id_col, source_col
    )
    return found.select(
        F.col(f"row.`{id_col}`"), F.col(f"row.`{source_col}`"), "block", "release", "deadline",
        "slot", "position",
    )


def mixed(
    docs: DataFrame,
    weights: dict[str, int],
    other: int,
    block_docs: int = BLOCK_DOCS,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """All rows and columns of ``docs``, sorted as ``mix_sources`` places them."""
    found = placed(docs, weights, other, block_docs, id_col, source_col)
    return found.orderBy("position").select("row.*")
