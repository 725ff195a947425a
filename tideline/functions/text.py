"""Accent folding, value normalisation and column names."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of ASCII whitespace, as Python's str.split() knows it, other than a lone space.
_SPACE_RUN = r"[\t-\r\x1c-\x1f][\t-\r\x1c-\x20]*| [\t-\r\x1c-\x20]+"


def _ascii_of(char: str) -> str:
    return unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Code points that fold to one ASCII character, and those that fold to several.

    Compatibility decomposition works per code point and the reordering it does only concerns
    combining marks, which are dropped anyway; so a per-character table is exact.
    """
    source, target, wide = [], [], {}
    for point in range(0x80, 0x110000):
        char = chr(point)
        if not unicodedata.decomposition(char):
            continue
        folded = _ascii_of(char)
        if len(folded) == 1:
            source.append(char)
            target.append(folded)
        elif folded:
            wide[char] = folded
    return "".join(source), "".join(target), wide


def _expand_wide(text: Column) -> Column:
    """Replace characters that fold to several ASCII characters (½ to 12, … to ...).

    Only the distinct non-ASCII characters of a value are looked up.
    """
    _, _, wide = _fold_tables()
    known, meanings = F.lit("".join(wide)), F.split(F.lit("\n".join(wide.values())), "\n")
    foreign = F.array_distinct(F.split(F.regexp_replace(text, r"[\x00-\x7F]+", ""), ""))
    present = F.filter(foreign, lambda c: (c != "") & (F.instr(known, c) > 0))
    return F.aggregate(
        present,
        text,
        lambda acc, c: F.replace(acc, c, F.element_at(meanings, F.instr(known, c))),
    )


def to_ascii(text: Column) -> Column:
    """Compatibility-decompose and keep the ASCII characters."""
    source, target, _ = _fold_tables()
    folded = F.regexp_replace(
        F.translate(_expand_wide(text), source, target), r"[^\x00-\x7F]+", ""
    )
    # A value whose byte and character counts agree is ASCII already.
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(folded)


def fold_text(text: Column) -> Column:
    """Accent-free, lower-case, single-spaced text; NULL stays NULL."""
    squeezed = F.regexp_replace(F.lower(to_ascii(text)), _SPACE_RUN, " ")
    return F.trim(squeezed)


def match_text(text: Column) -> Column:
    """Folded text for territory matching, where a missing name counts as empty."""
    return F.coalesce(fold_text(text), F.lit(""))


def normalize_value(value: Column) -> Column:
    """Folded text; NULL and the empty string give NULL, blank text gives the empty string."""
    text = value.cast("string")
    return F.when(text != "", fold_text(text))


def column_name(name: object) -> str:
    """Canonical upper-case name of a source column (driver-side metadata)."""
    return re.sub(r"[^A-Z0-9]+", "_", _ascii_of(str(name)).upper()).strip("_")


def column_name_expr(cell: Column) -> Column:
    """``column_name`` over the cells of a column."""
    return F.btrim(
        F.regexp_replace(F.upper(to_ascii(cell.cast("string"))), "[^A-Z0-9]+", "_"), F.lit("_")
    )
