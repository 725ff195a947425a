"""Substring deduplication with suffix automata of reference shards.

A window of words is removed wherever its words start somewhere else too. Every window has an
anchor: of the shorter word sequences inside it, the one with the smallest hash. Equal windows
have equal anchors, so the windows of a document with the same anchor in a row make a segment,
and only segments with one anchor can hold equal windows. An anchor that the corpus has once
settles its segment at once, and segments that are all equal are settled as well.

What is left is the reference. It is dealt out by anchor into shards of bounded size; each shard
becomes a suffix automaton, and its segments are streamed through it for their matching
statistics: the longest suffix that ends at two places of the corpus. Equal segments are one, and
weigh as many places as they stand at. Where that is as long as a
window, the window is removed. Sending the automata to all documents instead would make every
document meet every shard, which grows with the square of the corpus.

An anchor with very many different segments is no shard but counted: its windows' hashes are
summed before they travel, so that no task holds them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import equal_or_null, maybe_in, ship
from .words import mixed, utf8, window_hashes, word_hashes

WINDOW_WORDS = 35
ANCHOR_WORDS = 16
#: Words of the segments in one automaton, at most, but for a single anchor's.
SHARD_WORDS = 50_000
#: Different segments of one anchor that are more than this are counted by window.
COUNTED_CONTENTS = 2_000

SPANS = "array<struct<first:int,last:int>>"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class SuffixAutomaton:
    """All substrings of several sequences, and how often each occurs."""

    def __init__(self):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, source: int, symbol: int, target: int) -> int:
        """A state for the part of ``target`` that ``source`` extends to by ``symbol``."""
        step, link = self.step, self.link
        twin = self._state(self.length[source] + 1, dict(step[target]), link[target])
        link[target] = twin
        while source != -1 and step[source].get(symbol) == target:
            step[source][symbol] = twin
            source = link[source]
        return twin

    def _extend(self, last: int, symbol: int) -> int:
        step, link, length = self.step, self.link, self.length
        target = step[last].get(symbol)
        if target is not None:
            return target if length[target] == length[last] + 1 else self._split(
                last, symbol, target
            )
        new = self._state(length[last] + 1, {}, 0)
        while last != -1 and symbol not in step[last]:
            step[last][symbol] = new
            last = link[last]
        if last != -1:
            target = step[last][symbol]
            near = length[target] == length[last] + 1
            link[new] = target if near else self._split(last, symbol, target)
        return new

    def add(self, sequence: list[int], times: int) -> None:
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)
            self.count[last] += times

    def finish(self) -> None:
        """Sum occurrences; call once, after all sequences are added."""
        count, link = self.count, self.link
        for state in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            if link[state] > 0:
                count[link[state]] += count[state]

    def statistics(self, sequence: list[int]) -> Iterator[int]:
        """At each place of an added sequence, the longest suffix that occurs twice or more."""
        state, step, link, count = 0, self.step, self.link, self.count
        for symbol in sequence:
            # A whole suffix that occurs once has no longer extension that occurs twice.
            while symbol not in step[state]:
                state = link[state]
            state = step[state][symbol]
            while state and count[state] < 2:
                state = link[state]
            yield self.length[state]


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each segment, and its anchor."""
    count = len(hashes) - window + 1
    if count <= 0:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int64)
    size = min(ANCHOR_WORDS, window)
    grams = window_hashes(hashes, size)
    inside = np.lib.stride_tricks.sliding_window_view(grams, window - size + 1)
    place = inside.argmin(axis=1) + np.arange(count)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], count) - 1
    return first.astype(np.int32), last.astype(np.int32), grams[place[first]].view(np.int64)


def contents(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, window: int) -> np.ndarray:
    """A hash of the words of each segment."""
    powers = np.cumprod(np.full(len(hashes), _BASE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers)])
    end = last + window
    # The inverse powers make a sum the same wherever its words stand.
    moved = (sums[end] - sums[first]) * np.cumprod(np.full(len(hashes), _INVERSE))[first]
    return mixed(moved + (end - first).astype(np.uint64)).view(np.int64)


def shard_runs(rows: list[tuple], window: int) -> Iterator[tuple]:
    """Anchor, content, and first and last window in it, of every run of repeated windows in a
    shard. ``rows`` are (g, c, times, words), one per content; ``words`` the bytes of its hashes.
    """
    automaton = SuffixAutomaton()
    sequences = [np.frombuffer(w, np.uint64).tolist() for *_, w in rows]
    for (_, _, times, _), sequence in zip(rows, sequences):
        automaton.add(sequence, times)
    automaton.finish()
    for (g, c, _, _), sequence in zip(rows, sequences):
        long = np.fromiter(automaton.statistics(sequence), np.int64, len(sequence)) >= window
        edges = np.flatnonzero(np.diff(np.concatenate([[0], long[window - 1 :], [0]])))
        for a, b in edges.reshape(-1, 2).tolist():
            yield g, c, a, b - 1


def _segments(docs: DataFrame, window: int, places: bool) -> DataFrame:
    """A row per segment: its anchor ``g``, the hash ``c`` of its words, and with ``places``
    where it is."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                hashes = word_hashes(utf8(text))
                first, last, anchor = anchors(hashes, window)
                if not len(first):
                    continue
                found = contents(hashes, first, last, window)
                columns, names = [pa.array(anchor), pa.array(found)], ["g", "c"]
                if places:
                    here = pa.array(np.full(len(first), i))
                    ids, h = (batch.column(c).take(here) for c in ("id", "h"))
                    columns += [ids, h, pa.array(first), pa.array(last)]
                    names += ["id", "h", "first", "last"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    def gathered(batches):
        # Few large batches; a document alone would make a small one.
        held, rows = [], 0
        for batch in run(batches):
            held.append(batch)
            rows += batch.num_rows
            if rows >= 50_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    more = f", id {kind}, h binary, first int, last int" if places else ""
    return docs.mapInArrow(gathered, f"g bigint, c bigint{more}")


def _words_of(docs: DataFrame, lists: DataFrame, window: int) -> DataFrame:
    """The words of listed contents: ``g``, ``c``, ``times``, ``words``; of anchors to be counted,
    a row per window instead, with its place ``at``, its hash ``w`` and no words."""
    some = maybe_in(docs, _row_key(), lists, "key").where("_maybe").drop("_maybe")
    wanted = _joined(some, lists.drop("key"), "inner").select("text", "listed")

    def run(batches):
        kinds = [pa.int64()] * 3 + [pa.int32(), pa.int64(), pa.binary()]
        for batch in batches:
            for text, listed in zip(batch.column("text"), batch.column("listed")):
                hashes = word_hashes(utf8(text))
                windows, rows = None, []
                for seg in listed.as_py():
                    first, last = seg["first"], seg["last"]
                    head = (seg["g"], seg["c"], seg["times"])
                    if seg["counted"]:
                        if windows is None:
                            windows = window_hashes(hashes, window).view(np.int64)
                        found = windows[first : last + 1].tolist()
                        rows += [(*head, at, w, None) for at, w in enumerate(found)]
                    else:
                        rows.append((*head, None, None, hashes[first : last + window].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    names=["g", "c", "times", "at", "w", "words"],
                )

    return wanted.mapInArrow(
        run, "g bigint, c bigint, times bigint, at int, w bigint, words binary"
    )


def _in_shards(segments: DataFrame, window: int) -> DataFrame:
    """Runs of repeated windows, by an automaton per shard. An anchor's contents are in one
    partition next to each other, and a shard takes whole anchors."""

    def run(batches):
        shard: list[tuple] = []
        size, anchor = 0, None
        names, kinds = ["g", "c", "a", "b"], [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

        def done():
            runs = list(zip(*shard_runs(shard, window))) or [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(runs, kinds)], names=names
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("g", "c", "times", "words")]
            for row in zip(*columns):
                if row[0] != anchor and size >= SHARD_WORDS:
                    yield done()
                    shard, size = [], 0
                anchor = row[0]
                shard.append(row)
                size += len(row[3]) // 8
        if shard:
            yield done()

    placed = segments.repartition("g").sortWithinPartitions("g", "c")
    return placed.mapInArrow(run, "g bigint, c bigint, a int, b int")


def _joined(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``docs`` with what ``found`` has for their key."""
    found = found.withColumnsRenamed({"id": "_id", "h": "_h"})
    key = equal_or_null(F.col("id"), F.col("_id")) & (F.col("h") == F.col("_h"))
    return docs.join(found, key, how).drop("_id", "_h")


def _row_key():
    return F.xxhash64("id", "h")


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """``id``, ``h`` and ``runs``, first and last windows that occur elsewhere too; several rows
    for a document."""
    occurring = _segments(docs.select("id", "h", "text"), window, places=False).groupBy("g").agg(
        F.count("*").alias("n"), (F.min("c") == F.max("c")).alias("equal")
    )
    several = stored(occurring.where("n > 1"))
    places = _segments(docs.select("id", "h", "text"), window, places=True)
    found = stored(places.join(several, "g"))

    whole = F.array(F.struct("first", "last"))
    settled = found.where("equal").select("id", "h", whole.alias("runs"))
    open_ = found.where("NOT equal").drop("n", "equal")

    # Each content is looked at once, where it stands first, and weighs as often as it occurs.
    kinds = stored(
        open_.groupBy("g", "c").agg(
            F.count("*").alias("times"), F.min(F.struct("id", "h", "first", "last")).alias("one")
        )
    )
    counted = stored(kinds.groupBy("g").agg((F.count("*") > COUNTED_CONTENTS).alias("counted")))
    lists = kinds.join(counted, "g").groupBy("one.id", "one.h").agg(
        F.collect_list(
            F.struct("g", "c", "times", "one.first", "one.last", "counted")
        ).alias("listed")
    )
    lists = stored(lists.withColumn("key", _row_key()))
    words = stored(_words_of(docs, lists, window))
    by_shard = _in_shards(words.where("words IS NOT NULL"), window)
    windows = words.where("words IS NULL").select("g", "c", "at", "w", "times")
    twice = stored(
        windows.groupBy("w").agg(F.sum("times").alias("n")).where("n > 1").select("w")
    )
    by_count = windows.join(twice, "w", "left_semi").select(
        "g", "c", F.col("at").alias("a"), F.col("at").alias("b")
    )
    runs = by_shard.unionByName(by_count).groupBy("g", "c").agg(
        F.collect_list(F.struct("a", "b")).alias("runs")
    )
    moved = F.transform(
        "runs",
        lambda x: F.struct(
            (F.col("first") + x["a"]).alias("first"), (F.col("first") + x["b"]).alias("last")
        ),
    )
    judged = open_.join(stored(runs), ["g", "c"]).select("id", "h", moved.alias("runs"))
    return settled.unionByName(judged)


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``n_removed``, ``removed``, ``kept``.

    Words are runs without ASCII white space. A word is removed if a window of ``window`` words
    covers it whose words also start anywhere else in the table, the same document included, by
    the table as it is. ``removed`` lists the maximal removed spans as (start, end) in words, end
    exclusive; ``kept`` is what is left, joined by blanks.

    A NULL text has no words and an empty ``kept``; so has an empty one. Texts shorter than a
    window lose nothing. Equal rows repeat each other, so all their windows go. Ids may be NULL
    or repeated. Other columns are ignored, whatever their names. An empty table gives an empty
    result.
    """
    ship(docs.sparkSession)
    text = docs[text_col]
    source = docs.select(
        docs[id_col].alias("id"),
        # Rows of one id and digest have one text, so what holds for one holds for all of them.
        F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("h"),
        text.alias("text"),
    )
    kind = source.schema["id"].dataType.simpleString()
    spans = repeated_windows(source, window).groupBy("id", "h").agg(
        F.flatten(F.collect_list("runs")).alias("spans")
    )
    spans = stored(spans.withColumn("key", _row_key()))
    # Most documents have nothing repeated, and need not travel.
    marked = maybe_in(source, _row_key(), spans, "key")
    whole = marked.where("NOT _maybe").select("text", "id", F.lit(None).cast(SPANS).alias("spans"))
    some = _joined(marked.where("_maybe"), spans.drop("key"), "left")
    marked = whole.unionByName(some.select("text", "id", "spans"))

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                rows = [_cut(*x, window) for x in zip(part.column("text"), part.column("spans"))]
                columns = list(zip(*rows)) or [[], [], [], []]
                pairs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                kinds = [pa.int64(), pa.int64(), pairs, pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    names=[id_col, "n_words", "n_removed", "removed", "kept"],
                )

    return marked.mapInArrow(
        run,
        f"`{id_col}` {kind}, n_words bigint, n_removed bigint, "
        "removed array<struct<start:int,end:int>>, kept string",
    )


def _cut(text, spans, window: int) -> tuple[int, int, list[dict], str]:
    words = utf8(text).split()
    if not spans.is_valid:
        return len(words), 0, [], b" ".join(words).decode()
    change = np.zeros(len(words) + 1, np.int64)
    both = spans.values
    np.add.at(change, both.field("first").to_numpy(), 1)
    np.add.at(change, both.field("last").to_numpy() + window, -1)
    gone = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]))).reshape(-1, 2)
    kept = b" ".join(words[i] for i in np.flatnonzero(~gone))
    removed = [{"start": a, "end": b} for a, b in edges.tolist()]
    return len(words), int(gone.sum()), removed, kept.decode()
