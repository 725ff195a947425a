"""Natural keys, change hashes and deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything Python's str.strip() removes.
_SPACES = "".join(chr(p) for p in range(0x3001) if chr(p).isspace())
_JSON_SPECIAL = r"[\\\"]|[^ -~]"
_JSON_SHORT = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r", '"': '\\"'}


def key_part(value: Column) -> Column:
    """Trimmed text, the empty string for NULL."""
    text = value.cast("string")
    # Visible ASCII at both ends, as normalised values have, leaves nothing to trim.
    clean = F.ascii(text).between(33, 126) & F.ascii(F.substring(text, -1, 1)).between(33, 126)
    trimmed = F.when(clean, text).otherwise(F.btrim(text, F.lit(_SPACES)))
    return F.coalesce(trimmed, F.lit(""))


def natural_key(*parts: Column) -> Column:
    """Parts joined by bars; a missing part keeps its bars."""
    return F.concat_ws("|", *[key_part(p) for p in parts])


def _unicode_escape(char: Column) -> Column:
    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))

    code = F.ascii(char)
    above = code - 0x10000
    pair = F.concat(
        unit(F.shiftright(above, 10) + 0xD800), unit(above.bitwiseAND(F.lit(0x3FF)) + 0xDC00)
    )
    return F.when(code < 0x10000, unit(code)).otherwise(pair)


def json_escape(text: Column) -> Column:
    """``text`` escaped as an ASCII-only JSON string body."""
    short = F.create_map(*[F.lit(x) for pair in _JSON_SHORT.items() for x in pair])
    chars = F.array_distinct(F.regexp_extract_all(text, F.lit(r"([\"]|[^ -~])"), F.lit(1)))
    escaped = F.aggregate(
        chars,
        F.replace(text, F.lit("\\"), F.lit("\\\\")),
        lambda acc, c: F.replace(acc, c, F.coalesce(F.element_at(short, c), _unicode_escape(c))),
    )
    return F.when(F.rlike(text, F.lit(_JSON_SPECIAL)), escaped).otherwise(text)


def row_hash(key: Column, status: Column) -> Column:
    """SHA-256 of the JSON document holding the status and the natural key.

    Fixed format, shared with hashes stored earlier: members in name order, ``", "`` and ``": "``
    as separators, a missing status written as the empty string.
    """
    return F.sha2(
        F.concat(
            F.lit('{"estado_norm": "'),
            json_escape(F.coalesce(status, F.lit(""))),
            F.lit('", "natural_key": "'),
            json_escape(key),
            F.lit('"}'),
        ),
        256,
    )


def packed_digest(text: Column) -> Column:
    """``text`` as bytes of which a SHA-256 in lower-case hex takes half; any other text stays
    as it is, under another first byte. ``unpacked_digest`` gives it back."""
    digest = F.rlike(text, F.lit("^[0-9a-f]{64}$")) & (F.char_length(text) == 64)
    return F.when(digest, F.concat(F.lit(b"\x00"), F.unhex(text))).otherwise(
        F.concat(F.lit(b"\x01"), text.cast("binary"))
    )


def unpacked_digest(packed: Column) -> Column:
    body = F.substring(packed, 2, 1 << 30)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x00"), F.lower(F.hex(body))).otherwise(
        body.cast("string")
    )


def surrogate_id(*parts: Column) -> Column:
    """Identifier that depends only on its parts, so a retried task writes the same rows.

    NULL and the empty string give different ids.
    """
    return F.sha2(
        F.concat_ws(
            "\x1f",
            *[
                F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("~"))
                for p in parts
            ],
        ),
        256,
    )
