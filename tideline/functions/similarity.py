"""Normalised insert/delete similarity of two strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Positions that fit a signed 64-bit word with room for one carry.
_WORD = 62


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _bits(width: Column) -> Column:
    """As many low bits set; at most ``_WORD``."""
    one = F.lit(1).cast("bigint")
    return F.call_function("shiftleft", one, width) - one


def _masks(chars: Column, words: Column) -> Column:
    """Per distinct character its positions: bit ``j`` of word ``w`` for place ``62 w + j``."""
    zero = F.lit(0).cast("bigint")

    def mask(char: Column, word: Column) -> Column:
        part = F.slice(chars, word * _WORD + 1, F.lit(_WORD))
        # Horner's rule over the reversed word: the first character ends up in the lowest bit.
        return F.aggregate(
            F.reverse(part), zero,
            lambda m, c: m * 2 + F.when(c == char, F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
        )

    return F.map_from_entries(
        F.transform(
            F.array_distinct(chars),
            lambda char: F.struct(
                char, F.transform(F.sequence(F.lit(0), words - 1), lambda w: mask(char, w))
            ),
        )
    )


def _advance(state: Column, hits: Column, words: Column) -> Column:
    """One step of the bit-parallel recurrence over all words, with the carry between them."""
    zero = F.lit(0).cast("bigint")

    def word(acc: Column, i: Column) -> Column:
        s = F.get(state, i)
        hit = s.bitwiseAND(F.get(hits, i))
        total = s + hit + acc["carry"]
        kept = total.bitwiseAND(F.lit((1 << _WORD) - 1)).bitwiseOR(s - hit)
        return F.struct(
            F.call_function("shiftright", total, F.lit(_WORD)).alias("carry"),
            F.array_append(acc["words"], kept).alias("words"),
        )

    start = F.struct(
        zero.alias("carry"), F.array().cast("array<bigint>").alias("words")
    )
    return F.aggregate(
        F.sequence(F.lit(0), words - 1), start, word, lambda acc: acc["words"]
    )


def _lcs_words(a: Column, b: Column) -> Column:
    """Longest common subsequence of any two non-empty strings.

    The positions of the characters of ``b`` are tabled once. Each character of ``a`` then takes
    one step per 62 characters of ``b``.
    """
    full = F.lit((1 << _WORD) - 1).cast("bigint")

    def run(table: Column, words: Column) -> Column:
        def step(state: Column, char: Column) -> Column:
            hits = F.element_at(table, char)
            return F.when(hits.isNull(), state).otherwise(_advance(state, hits, words))

        ones = F.aggregate(F.split(a, ""), F.array_repeat(full, words), step)
        # Bits beyond the end of b are never hit, so they stay set.
        zeros = F.aggregate(ones, F.lit(0), lambda n, w: n + _WORD - F.bit_count(w))
        return zeros

    words = F.ceil(F.char_length(b) / _WORD).cast("int")
    return _once(
        F.split(b, ""),
        lambda chars: _once(_masks(chars, words), lambda table: run(table, words)),
    )


def _lcs_word(a: Column, b: Column) -> Column:
    """The same for ``b`` of at most ``_WORD`` characters, whose state is one number."""

    def step(state: Column, hits: Column) -> Column:
        # Where a character is not in b, nothing is hit.
        hit = state.bitwiseAND(hits)
        return (state + hit).bitwiseOR(state - hit).bitwiseAND(F.lit((1 << _WORD) - 1))

    def run(table: Column) -> Column:
        hits = F.transform(
            F.split(a, ""), lambda c: F.coalesce(F.get(F.element_at(table, c), F.lit(0)), F.lit(0))
        )
        full = F.lit((1 << _WORD) - 1).cast("bigint")
        return F.lit(_WORD) - F.bit_count(F.aggregate(hits, full, step))

    return _once(
        F.split(b, ""), lambda chars: _once(_masks(chars, F.lit(1)), run)
    )


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two strings.

    The work grows with the length of the longer one times the words of the shorter one.
    """
    swap = F.char_length(a) < F.char_length(b)
    pair = F.struct(
        F.when(swap, b).otherwise(a).alias("long"), F.when(swap, a).otherwise(b).alias("short")
    )

    def of(p: Column) -> Column:
        long, short = p["long"], p["short"]
        return (
            F.when(short == "", F.lit(0))
            .when(F.char_length(short) <= _WORD, _lcs_word(long, short))
            .otherwise(_lcs_words(long, short))
        )

    return _once(pair, of)


def indel_ratio(a: Column, b: Column) -> Column:
    """Similarity from 0 to 100: one minus insertions and deletions over the summed lengths."""
    total = F.char_length(a) + F.char_length(b)
    distance = total - F.lit(2) * lcs_length(a, b)
    return F.when(total == 0, F.lit(100.0)).otherwise((F.lit(1.0) - distance / total) * 100)
