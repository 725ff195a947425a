"""Joining documents by the Jaccard similarity of their word shingles.

Two sets of similarity t share at least one of their first n - ceil(t n) + 1 tokens under any
order of all tokens. Here there are three orders. Each puts tokens that many documents have at
the end, and breaks ties by a hash of its own. A pair is a candidate if it shares a token in the
prefixes of the first order, which is a join by token, and in those of the other two, which bit
maps of these prefixes tell before any set moves; what is left is verified on the whole sets.

Documents per token are counted exactly, over all tokens of all documents: tasks send sorted
runs of tokens in three bytes each, dealt out by range. The most frequent ones, a fixed number,
are known to everybody.

Under one order, the tokens up to the end of the prefix that ends first are all in both prefixes.
So besides what the prefixes share, a pair shares at most what is left of that set, and a pair
whose prefixes share too few tokens for that to reach the similarity is no candidate.

Equal sets are one class from the start. Links are found in two turns. In the first, the
documents with a token are compared with one of them only, the same one for most tokens of a
group of near copies. In the second, all pairs that share a token are compared which the links of
the first turn have not connected yet. So no link between components is missed, and a group of
near copies doesn't turn into all of its pairs.

The second turn looks at places too. What a pair shares starts at the first token that both have
under the first order, so neither may have less left from there on than the similarity asks for.
Documents that only share a passage, however many, have spent too many of their own rarer tokens
when they come to it, and are not even paired. The pairs that are left have their prefixes' common
tokens counted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import give_back, maybe_in, ship
from .components import components
from .tokens import byte_slices
from .words import mixed, utf8, window_hashes, word_hashes

SHINGLE_WORDS = 5
MIN_PERCENT = 75
#: Tokens whose frequency everybody knows, at most: the most frequent ones. About 9 MB.
FREQUENT = 1 << 20
#: Documents that a token has to be in to be one of them.
LEAST = 16
#: Tokens that a task counts before it sends them, and bytes of text that make a range of tokens.
RUN_TOKENS = 1 << 22
RANGE_BYTES = 32 << 20
#: Bytes of texts whose sets are held at once.
SLICE_BYTES = 4 << 20
ORDERS = 3

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted set of hashed shingles; a shorter text is one shingle, an empty one none."""
    words = word_hashes(text.translate(_LOWER))
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(words, min(size, len(words))))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


#: Tokens are counted by their upper bits; which ones share them is the same for everybody.
_BITS = 40
_RUN = "range int, width int, gaps binary, at binary, more binary"


def encode_run(short: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Sorted numbers below 2**40 as the width and bytes of the gaps between the distinct ones,
    and the places and further copies of those that stand several times."""
    distinct, counts = np.unique(short, return_counts=True)
    gaps = np.diff(distinct, prepend=np.uint64(0)).astype("<u8")
    # The first gap is the range's offset, so it has all five bytes by itself.
    width = 3 if len(gaps) and int(gaps[1:].max(initial=0)) < 1 << 24 else 5
    packed = gaps.view(np.uint8).reshape(-1, 8)
    head = packed[:1, :5].tobytes()
    at = np.flatnonzero(counts > 1)
    more = (counts[at] - 1).astype("<u4")
    return width, head + packed[1:, :width].tobytes(), at.astype("<u4").tobytes(), more.tobytes()


def decode_run(width: int, gaps: bytes, at: bytes, more: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of a run, and how often each stands."""
    body = np.frombuffer(gaps, np.uint8, offset=5).reshape(-1, width)
    wide = np.zeros((len(body) + 1, 8), np.uint8)
    wide[0, :5] = np.frombuffer(gaps, np.uint8, count=5)
    wide[1:, :width] = body
    counts = np.ones(len(wide), np.int64)
    counts[np.frombuffer(at, "<u4")] += np.frombuffer(more, "<u4")
    return np.cumsum(wide.view("<u8").ravel()), counts


def _slices(batches, name: str = "text"):
    """Parts of Arrow batches of about ``SLICE_BYTES`` of text each, with their texts."""
    for batch in batches:
        column = batch.column(name)
        sizes = [len(x.as_buffer() or b"") if x.is_valid else 0 for x in column]
        for a, b in byte_slices(sizes, SLICE_BYTES):
            yield batch.slice(a, b - a), [*map(utf8, column.slice(a, b - a))]
            give_back()


def frequent(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens by their upper bits, sorted, and the logarithm of how many
    documents have each.

    A task sorts runs of tokens and sends a row per run and range; a token that many documents
    have is one entry of a run. There are as many ranges as keep one small.
    """
    total = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    ranges = max(8, int(total // RANGE_BYTES)).bit_length()
    shift = np.uint64(_BITS - ranges)

    def send(parts):
        short = np.concatenate(parts)
        parts.clear()
        short >>= np.uint64(64 - _BITS)
        short.sort()
        cuts = np.flatnonzero(np.diff(short >> shift)) + 1
        rows = [(int(x[0] >> shift), *encode_run(x)) for x in np.split(short, cuts)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(c, k) for c, k in
                zip(zip(*rows), (pa.int32(), pa.int32(), *[pa.binary()] * 3))
            ],
            names=["range", "width", "gaps", "at", "more"],
        )

    def run(batches):
        parts, held = [], 0
        for _, texts in _slices(batches):
            for text in texts:
                parts.append(shingles(text, size))
                held += len(parts[-1])
                if held >= RUN_TOKENS:
                    yield send(parts)
                    held = 0
        if held:
            yield send(parts)

    def count(runs: pa.Table) -> pa.Table:
        found, often, copies = [], [], []
        for row in zip(*map(runs.column, ("width", "gaps", "at", "more"))):
            tokens, counts = decode_run(*(x.as_py() for x in row))
            found.append(tokens)
            often.append(tokens[counts > 1])
            copies.append(counts[counts > 1] - 1)
        tokens = np.concatenate(found)
        del found
        tokens.sort()
        heads = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        # How many runs have each, and the further copies within runs, which few have.
        sums = np.diff(heads, append=len(tokens))
        tokens = tokens[heads]
        np.add.at(sums, np.searchsorted(tokens, np.concatenate(often)), np.concatenate(copies))
        some = sums >= LEAST
        return pa.table({"t": tokens[some].view(np.int64), "n": sums[some]})

    parts = docs.select("text").mapInArrow(run, _RUN)
    counts = parts.groupBy("range").applyInArrow(count, "t bigint, n bigint")
    top = counts.orderBy(F.desc("n"), "t").limit(FREQUENT).toArrow()
    tokens = top.column("t").to_numpy().astype(np.uint64)
    order = np.argsort(tokens)
    levels = np.log2(np.maximum(top.column("n").to_numpy(), 1)).astype(np.uint8)
    return tokens[order], levels[order]


def level_of(tokens: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How frequent tokens are, in powers of two; zero for those that are not known."""
    short, levels = known
    if not len(short):
        return np.zeros(len(tokens), np.uint64)
    mine = tokens >> np.uint64(64 - _BITS)
    at = np.minimum(np.searchsorted(short, mine), len(short) - 1)
    return np.where(short[at] == mine, levels[at], 0).astype(np.uint64)


def prefix(tokens: np.ndarray, level: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first tokens of a sorted set under one of the orders, in that order; ``level`` says how
    frequent each is."""
    count = prefix_length(len(tokens), percent)
    if not count:
        return tokens
    rank = mixed(tokens + np.uint64(order)) >> np.uint64(6)
    rank |= np.minimum(level, np.uint64(63)) << np.uint64(58)
    first = np.sort(np.argpartition(rank, count - 1)[:count])
    return tokens[first[np.argsort(rank[first], kind="stable")]]


def sketches(docs: DataFrame, level, size: int, percent: int, prefixes: bool) -> DataFrame:
    """``id``, ``n`` (the set's size) and ``key`` (a digest of the set); with ``prefixes`` also
    ``p0``, the prefix under the first order."""
    ids = docs.schema["id"].dataType.simpleString()

    def run(batches):
        import xxhash

        for batch, texts in _slices(batches):
            sets = [shingles(x, size) for x in texts]
            columns = {
                "id": batch.column("id"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "key": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
            }
            if prefixes:
                known = level.value
                found = [prefix(s, level_of(s, known), 0, percent).view(np.int64) for s in sets]
                columns["p0"] = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)

    more = ", p0 array<bigint>" if prefixes else ""
    return docs.mapInArrow(run, f"id {ids}, n bigint, key binary{more}")


def signature(tokens: np.ndarray) -> bytes:
    """A bit map of hashed tokens, about four bits a token; a power of two of them."""
    bits = max(6, int(4 * len(tokens) - 1).bit_length())
    marks = np.zeros(1 << bits, np.uint8)
    marks[(mixed(tokens) >> np.uint64(64 - bits)).astype(np.int64)] = 1
    return np.packbits(marks).tobytes()


def most_shared(a: bytes, b: bytes, n: int, m: int) -> int:
    """What two sets of ``n`` and ``m`` tokens share at most, by their signatures: a bit that
    only one of them has stands for a token that the other lacks."""
    one, two = (np.unpackbits(np.frombuffer(x, np.uint8)) for x in (a, b))
    size = min(len(one), len(two))
    one, two = (x.reshape(size, -1).any(axis=1) for x in (one, two))
    return min(n - int((one & ~two).sum()), m - int((two & ~one).sum()))


def common_bit(a: bytes, b: bytes) -> bool:
    """Whether two signatures have a bit in common, as those of sets with a common token do."""
    one, two = (np.unpackbits(np.frombuffer(x, np.uint8)) for x in (a, b))
    size = min(len(one), len(two))
    one, two = (x.reshape(size, -1).any(axis=1) for x in (one, two))
    return bool((one & two).any())


def whole_sets(docs: DataFrame, level, size: int, percent: int) -> DataFrame:
    """``rep``, the set's ``tokens``, how many they are (``n``), their ``signature``, and
    ``orders``: the signatures of the prefixes under all orders but the first."""

    def run(batches):
        known = level.value
        for batch, texts in _slices(batches):
            sets = [shingles(x, size) for x in texts]
            levels = [level_of(s, known) for s in sets]
            orders = [
                [signature(prefix(s, v, i, percent)) for i in range(1, ORDERS)]
                for s, v in zip(sets, levels)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rep"),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(list(map(signature, sets)), pa.binary()),
                    pa.array(orders, pa.list_(pa.binary())),
                ],
                names=["rep", "tokens", "n", "signature", "orders"],
            )

    return docs.select("rep", "text").mapInArrow(
        run,
        "rep bigint, tokens array<bigint>, n bigint, signature binary, orders array<binary>",
    )


def least_shared(percent: int) -> Column:
    """How many tokens similar sets of ``n`` and ``m`` have in common at least."""
    return F.ceil(percent * (F.col("n") + F.col("m")) / (100 + percent))


def sizes_fit(percent: int) -> Column:
    return 100 * F.least("n", "m") >= percent * F.greatest("n", "m")


def enough_left(percent: int) -> Column:
    """Whether sets of ``n`` and ``m`` tokens may be similar if the first token that both have is
    at place ``i`` of the one and ``j`` of the other."""
    left = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))
    return sizes_fit(percent) & (left >= least_shared(percent))


def plausible(counts: DataFrame, percent: int) -> DataFrame:
    """Pairs that share enough tokens of their prefixes: ``a``, ``b`` and ``c``, how many.

    ``counts`` has ``c`` and the sizes ``n`` of ``a`` and ``m`` of ``b``.
    """
    left = F.ceil(percent * F.greatest("n", "m") / 100) - 1
    enough = F.col("c") + left >= least_shared(percent)
    return counts.where(sizes_fit(percent) & enough).select("a", "b", "c")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets are similar enough."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are similar enough.

    The small signatures travel first, and whole sets only for pairs that those leave.
    """
    pairs = _by_signature(pairs.select("a", "b"), sets, percent)
    one = sets.select(F.col("rep").alias("a"), F.col("tokens").alias("x"))
    two = sets.select(F.col("rep").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")

    def run(batches):
        for batch in batches:
            x, y = (batch.column(c) for c in ("x", "y"))
            good = [
                similar(
                    p.values.to_numpy().view(np.uint64), q.values.to_numpy().view(np.uint64),
                    percent,
                )
                for p, q in zip(x, y)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            give_back()

    return both.mapInArrow(run, "a bigint, b bigint")


def _by_signature(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose prefixes may meet under every order, and whose signatures let them share
    enough."""
    small = sets.select("rep", "n", "signature", "orders")
    both = pairs.join(small.toDF("a", "n", "x", "p"), "a").join(small.toDF("b", "m", "y", "q"), "b")

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("x", "y", "n", "m", "p", "q"))
            good = [
                all(map(common_bit, p, q))
                and (100 + percent) * most_shared(x, y, n, m) >= percent * (n + m)
                for x, y, n, m, p, q in zip(*columns)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            give_back()

    found = both.select("a", "b", "x", "y", "n", "m", "p", "q").mapInArrow(
        run, "a bigint, b bigint"
    )
    return stored(found.distinct())


def _prefixes_meet(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs with ``c``, how many tokens their prefixes under the first order share."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct())
    heads = maybe_in(reps.select("rep", "p0"), F.col("rep"), wanted, "rep").where("_maybe")
    heads = heads.select("rep", "p0")
    both = pairs.join(heads.toDF("a", "p"), "a").join(heads.toDF("b", "q"), "b")
    return both.withColumn("c", F.size(F.array_intersect("p", "q"))).drop("p", "q")


def linked(
    reps: DataFrame, docs: DataFrame, extra: DataFrame, level, size: int, percent: int
) -> DataFrame:
    """``node`` and ``component`` of all representatives that have a link.

    ``reps`` has ``rep``, ``n`` and ``p0``; ``docs`` has ``rep`` and ``text``; ``extra`` has links
    known beforehand.
    """
    tokens = reps.select("rep", "n", F.posexplode("p0").alias("i", "t"))
    # The pivot of a token: the smallest representative that has it.
    repeated = tokens.groupBy("t").agg(F.count("*").alias("c"), F.min("rep").alias("pivot"))
    repeated = stored(repeated.where("c > 1").select("t", "pivot"))
    rows = stored(tokens.join(repeated, "t"))
    sizes = reps.select("rep", F.col("n").alias("size"))

    def with_sets(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("rep")).unionByName(
            pairs.select(F.col("b").alias("rep"))
        )
        wanted = stored(wanted.distinct())
        texts = maybe_in(docs, F.col("rep"), wanted, "rep").where("_maybe").drop("_maybe")
        texts = texts.join(wanted, "rep", "left_semi")
        return verified(pairs, stored(whole_sets(texts, level, size, percent)), percent)

    with_pivot = rows.where("pivot < rep").groupBy(
        F.col("pivot").alias("a"), F.col("rep").alias("b"), F.col("n").alias("m")
    ).agg(F.count("*").alias("c"))
    with_pivot = with_pivot.join(sizes.toDF("a", "n"), "a")
    # The pivot with which most tokens are shared is enough here; the second turn has the rest.
    first = plausible(with_pivot, percent).groupBy("b").agg(F.max_by("a", F.struct("c", "a")))
    first = stored(first.toDF("b", "a").select("a", "b"))
    links = stored(with_sets(first).unionByName(extra))
    group = stored(components(links))

    # What has a token in common across components, and was not compared yet.
    named = rows.join(group, F.col("rep") == F.col("node"), "left").select(
        "t", "rep", "n", "i", "pivot", F.coalesce("component", "rep").alias("g")
    )
    of_pivot = group.select(F.col("node").alias("pivot"), F.col("component").alias("pg"))
    strange = named.join(of_pivot, "pivot", "left").where("g != coalesce(pg, pivot)")
    across = stored(strange.select("t").distinct())
    open_ = stored(named.join(across, "t", "left_semi").drop("pivot"))
    one, two = (
        open_.select("t", *(F.col(c).alias(d) for c, d in zip(("rep", "n", "i", "g"), names)))
        for names in (("a", "n", "i", "ga"), ("b", "m", "j", "gb"))
    )
    paired = one.join(two, "t").where(F.expr("a < b AND ga != gb") & enough_left(percent))
    paired = stored(paired.select("a", "b", "n", "m").distinct())
    counted = _prefixes_meet(paired, reps)
    second = plausible(counted, percent).select("a", "b").distinct()
    second = stored(second.join(first, ["a", "b"], "left_anti"))
    return components(links.unionByName(with_sets(second)))


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    percent: int = MIN_PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` and ``component_id``.

    Words are runs without ASCII white space, A to Z in lower case. A document's set are its
    distinct shingles of ``size`` words; with fewer words it is the whole sequence, and without
    any it is empty and linked with nothing. Documents link when 100 times what their sets share
    is at least ``percent`` times what they have together; ``component_id`` is the smallest id
    that links lead to, its own included.

    Ids are integers. Rows with equal ids are parts of one document, and a link of any part is
    one of the document. Rows with a NULL id take part in nothing and have a NULL component.
    Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text"))
    level = spark.sparkContext.broadcast(frequent(source, size))
    sketch = stored(sketches(source, level, size, percent, prefixes=False))

    # Equal sets are one class, and its smallest id stands for it.
    full = sketch.where("n > 0 AND id IS NOT NULL")
    classes = stored(full.groupBy("key", "n").agg(F.min("id").alias("rep")))
    member = full.join(classes, ["key", "n"]).select("id", "rep")
    several = member.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z"))
    several = several.where("a != z").select("id", "a")
    extra = member.join(several, "id").select("a", F.col("rep").alias("b")).where("a != b")

    known = source.where("id IS NOT NULL")
    reps = sketches(known, level, size, percent, prefixes=True).where("n > 0")
    reps = stored(
        reps.groupBy("key", "n").agg(F.min("id").alias("rep"), F.any_value("p0").alias("p0")).drop(
            "key"
        )
    )
    texts = known.withColumnRenamed("id", "rep")
    found = linked(reps, texts, extra, level, size, percent)

    by_class = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        "key", "n", F.coalesce("component", "rep").alias("component")
    )
    named = sketch.join(by_class, ["key", "n"], "left")
    return named.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is their component's, with all their columns.

    Rows without an id stay, as they are in no component.
    """
    found = stored(jaccard_join(docs, id_col, text_col))
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_id"))
    gone = stored(gone.distinct())
    key = docs[id_col].cast("bigint")
    marked = maybe_in(docs.select(F.struct(*docs.columns).alias("row"), key.alias("key")),
                      F.col("key"), gone, "_id")
    doubtful = marked.where("_maybe").join(gone, F.col("key") == F.col("_id"), "left_anti")
    return marked.where("NOT _maybe").unionByName(doubtful).select("row.*")
