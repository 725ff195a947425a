"""Periodic runs of words, by internal pattern matching over dyadic blocks.

A run repeats its first ``q`` words at least ``exponent`` times. Blocks of 4, 8, 16, ... words at
every half block ask for their next occurrence: the smallest position after their own among the
suffixes that begin with the block, which stand next to each other in a suffix array and are
searched by a wavelet matrix. A block of at least ``q`` words inside a run occurs next exactly
``q`` words later, so distances between half a block and a whole one are the candidate periods,
and the blocks of one run form a progression. Every run of four periods holds such a block, and
the period that it gives is the smallest one.

Documents are treated many at a time. Suffixes that share no block with another one of their
document can answer no query, so they never enter the array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship
from .tokens import byte_slices
from .words import utf8

#: Words of the smallest block; with blocks at every second word it finds periods up to four.
BLOCK = 4
MIN_LENGTH = 6
EXPONENT = 4
#: Bytes of texts that are treated together; a longer text is treated alone.
SLICE_BYTES = 1 << 20

RUN = "array<struct<start:bigint, length:bigint, period:bigint>>"


class WaveletMatrix:
    """Distinct values below ``2**bits``, answering many range queries at once.

    A level keeps one bit a value, with counts before every 64 of them.
    """

    def __init__(self, values: np.ndarray, bits: int):
        self.levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        for shift in range(bits - 1, -1, -1):
            ones = (values >> shift) & 1 != 0
            packed = np.zeros(8 * (len(values) // 64 + 1), np.uint8)
            small = np.packbits(ones, bitorder="little")
            packed[: len(small)] = small
            words = packed.view("<u8")
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            zeros = len(values) - int(ones.sum())
            self.levels.append((shift, words, before, zeros))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        word = at >> 6
        return before[word] + np.bitwise_count(words[word] & mask)

    def successors(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Per query, the smallest value of at least ``least`` in places ``low`` to ``high``.

        -1 where there is none.
        """
        rank = np.zeros(len(low), np.int64)
        a, b = low.copy(), high.copy()
        for shift, words, before, zeros in self.levels:
            ones_a, ones_b = self._ones(words, before, a), self._ones(words, before, b)
            up = (least >> shift) & 1 != 0
            # Values with a zero here are smaller than one whose bit is set.
            rank += np.where(up, (b - a) - (ones_b - ones_a), 0)
            a = np.where(up, zeros + ones_a, a - ones_a)
            b = np.where(up, zeros + ones_b, b - ones_b)
        found = rank < high - low
        rank, a, b = rank[found], low[found], high[found]
        value = np.zeros(len(rank), np.int64)
        for shift, words, before, zeros in self.levels:
            ones_a, ones_b = self._ones(words, before, a), self._ones(words, before, b)
            smaller = (b - a) - (ones_b - ones_a)
            up = rank >= smaller
            value |= np.where(up, 1 << shift, 0)
            rank = np.where(up, rank - smaller, rank)
            a = np.where(up, zeros + ones_a, a - ones_a)
            b = np.where(up, zeros + ones_b, b - ones_b)
        out = np.full(len(low), -1, np.int64)
        out[found] = value
        return out


def _groups(keys: np.ndarray) -> np.ndarray:
    """Numbers that are equal where the keys are, in the order of the keys."""
    return np.unique(keys, return_inverse=True)[1]


def _paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _groups(first * (int(second.max(initial=0)) + 1) + second)


def _repeated_blocks(words: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose ``BLOCK`` words occur again in their document, and the blocks' numbers."""
    n = len(words) - BLOCK + 1
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = _paired(words[:-1], words[1:])
    inside = np.flatnonzero(docs[:n] == docs[BLOCK - 1 :])
    # Pairs that stand once in the whole slice can't be part of a repeated block.
    often = np.bincount(pairs) > 1
    inside = inside[often[pairs[inside]] & often[pairs[inside + 2]]]
    blocks = _paired(docs[inside], _paired(pairs[inside], pairs[inside + 2]))
    again = np.bincount(blocks)[blocks] > 1
    return inside[again], _groups(blocks[again])


def _suffixes(places: np.ndarray, blocks: np.ndarray, n: int):
    """The suffix array of these places, and for each block size the groups that it falls into.

    Sizes double as long as some group has two places. Numbers of a size are the places in the
    array at which the groups begin, so that sorting goes on within groups alone.
    """
    order = np.argsort(blocks, kind="stable")
    group = np.empty(len(places), np.int64)
    firsts = np.flatnonzero(np.diff(blocks[order], prepend=-1))
    group[order] = np.repeat(firsts, np.diff(firsts, append=len(order)))
    # What follows a place is -1 beyond the places kept: nothing like it stands elsewhere.
    of_place = np.full(n + 1, -1, np.int64)
    stages, size = [], BLOCK
    while len(places):
        ends = np.bincount(group, minlength=len(places))
        stages.append((size, group.copy(), group + ends[group]))
        open_ = np.flatnonzero(ends[group] > 1)
        if not len(open_):
            break
        of_place[places] = group
        after = np.minimum(places[open_] + size, n)
        follow = of_place[after]
        by = np.lexsort((follow, group[open_]))
        slots = np.sort(group[open_], kind="stable")
        # The slots of open groups, counted within each group.
        fresh = np.diff(slots, prepend=-1) != 0
        starts = np.flatnonzero(fresh)
        slots = slots + np.arange(len(slots)) - np.repeat(starts, np.diff(starts, append=len(slots)))
        # -1 means a follower that occurs once: such places differ from one another as well.
        f = follow[by]
        new = fresh | (np.diff(f, prepend=-2) != 0) | (f == -1)
        heads = np.flatnonzero(new)
        group[open_[by]] = np.repeat(slots[heads], np.diff(heads, append=len(slots)))
        order[slots] = open_[by]
        size *= 2
    return order, stages


def _stretch(words, docs, start, end, period):
    """Stretches with a period, extended to both sides as far as it holds."""
    n = len(words)
    start, end = start.copy(), end.copy()
    live = np.arange(len(start))
    while len(live):
        at = start[live] - 1
        ok = at >= 0
        at = np.maximum(at, 0)
        ok &= (words[at] == words[at + period[live]]) & (docs[at] == docs[start[live]])
        live = live[ok]
        start[live] -= 1
    live = np.arange(len(start))
    while len(live):
        at = end[live]
        ok = at < n
        at = np.minimum(at, n - 1)
        ok &= (words[at] == words[at - period[live]]) & (docs[at] == docs[start[live]])
        live = live[ok]
        end[live] += 1
    return start, end


def runs(words: np.ndarray, docs: np.ndarray, min_length: int, exponent: int) -> np.ndarray:
    """Columns start, length and period of all runs, by start and period.

    ``words`` are numbers that are equal where the words are, below the square root of 2**63;
    ``docs`` rises from document to document.
    """
    places, blocks = _repeated_blocks(words, docs)
    found = [np.zeros((0, 3), np.int64)]
    if len(places):
        order, stages = _suffixes(places, blocks, len(words))
        matrix = WaveletMatrix(places[order], max(1, len(words).bit_length()))
        for size, low, high in stages:
            step = size // 2
            ask = np.flatnonzero((places % step == 0) & (high - low > 1))
            at = places[ask]
            next_ = matrix.successors(low[ask], high[ask], at + 1)
            period = next_ - at
            good = (next_ >= 0) & (period <= size) & ((period > step) | (size == BLOCK))
            at, period = at[good], period[good]
            if not len(at):
                continue
            # Neighbouring blocks with one period lie in the same stretch.
            by = np.lexsort((at, period))
            at, period = at[by], period[by]
            new = (np.diff(period, prepend=-1) != 0) | (np.diff(at, prepend=-1) > step)
            new[0] = True
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(at)) - 1
            q = period[heads]
            start, end = _stretch(words, docs, at[heads], at[tails] + size + q, q)
            length = end - start
            long = length >= np.maximum(min_length, exponent * q)
            found.append(np.stack([start, length, q], axis=1)[long])
    every = np.unique(np.concatenate(found), axis=0)
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def collapsed(words: list, found: np.ndarray) -> list:
    """The words without those that stand in a run after its first period."""
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, found[:, 0] + found[:, 2], 1)
    np.add.at(marks, found[:, 0] + found[:, 1], -1)
    drop = np.cumsum(marks[:-1]) > 0
    return [w for w, gone in zip(words, drop.tolist()) if not gone]


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    exponent: int = EXPONENT,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``runs`` and ``collapsed``.

    Words are runs of everything but ASCII white space, numbered from 0 within a document.
    ``runs`` holds every longest stretch of words whose smallest period fits into it ``exponent``
    times (four at least) and that has ``min_length`` words (six at least), by start and period;
    ``collapsed`` is the text's words, joined by one space, without those that stand in a run after
    its first period. A NULL or empty text has no words and no runs. Runs never cross documents.
    Repeated and NULL ids give a row each. Other columns are ignored, whatever their names. An
    empty table gives an empty result. Nothing is shuffled; a task holds one slice of texts of
    ``slice_bytes``, or one longer text.
    """
    if min_length < 6 or exponent < 4:
        raise ValueError("blocks of four words miss runs of under six words or four periods")
    ship(docs.sparkSession)
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    run_type = pa.list_(
        pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    )

    def treat(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        split = [t.split() for t in texts]
        counts = np.array([len(w) for w in split], np.int64)
        starts = np.concatenate([[0], np.cumsum(counts)])
        known: dict[bytes, int] = {}
        number = known.setdefault
        words = np.fromiter(
            (number(w, len(known)) for ws in split for w in ws), np.int64, int(starts[-1])
        )
        found = runs(words, np.repeat(np.arange(len(texts)), counts), min_length, exponent)
        cuts = np.searchsorted(found[:, 0], starts)
        found[:, 0] -= starts[np.searchsorted(starts, found[:, 0], side="right") - 1]
        left = [
            b" ".join(collapsed(w, found[a:b]) if b > a else w)
            for w, a, b in zip(split, cuts, cuts[1:])
        ]
        structs = pa.StructArray.from_arrays([*map(pa.array, found.T.copy())], fields=list(run_type.value_type))
        return pa.RecordBatch.from_arrays(
            [
                ids, pa.array(counts),
                pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), structs, type=run_type),
                pa.array(left, pa.binary()).cast(pa.string()),
            ],
            names=[id_col, "n_words", "runs", "collapsed"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            sizes = [len(x.as_buffer() or b"") if x.is_valid else 0 for x in column]
            for a, b in byte_slices(sizes, slice_bytes):
                yield treat(batch.column("id").slice(a, b - a), [*map(utf8, column.slice(a, b - a))])

    return source.mapInArrow(
        run, f"`{id_col}` {kind}, n_words bigint, runs {RUN}, collapsed string"
    )
