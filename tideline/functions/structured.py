"""JSON text, coercing casts, service status and artefact addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_document(**members: Column) -> Column:
    """JSON object with every member written, NULL ones included."""
    return F.to_json(
        F.struct(*[v.alias(k) for k, v in members.items()]), {"ignoreNullFields": "false"}
    )


def metric_map(document: Column) -> Column:
    """A JSON object of numbers as a map; anything unreadable gives an empty map."""
    empty = F.create_map().cast("map<string,double>")
    return F.coalesce(F.from_json(document, "map<string,double>"), empty)


def artifact_map(document: Column) -> Column:
    """A JSON object of ``{path, url}`` objects as a map; anything unreadable is empty."""
    kind = "map<string,struct<path:string,url:string>>"
    return F.coalesce(F.from_json(document, kind), F.create_map().cast(kind))


def to_number(value: Column) -> Column:
    """Number, or NULL where the text is not one."""
    return value.try_cast("double")


def to_instant(value: Column) -> Column:
    """Timestamp, or NULL where the text is not one."""
    return value.try_cast("timestamp")


def megabytes(size: Column) -> Column:
    return size / (1024 * 1024)


def availability(code: Column) -> Column:
    """``up`` for an answer below 500, ``down`` for the rest and for no answer."""
    return F.when(code < 500, F.lit("up")).otherwise(F.lit("down"))


def status_code(code: Column) -> Column:
    return F.coalesce(code, F.lit(0))


# Where published artefacts live.
PUBLIC_PREFIX = "/storage/v1/object/public/"


def object_path(kind: str, file_id: Column, name: Column) -> Column:
    """Deterministic object name ``<kind>/<file id>/<file name>``."""
    return F.concat_ws("/", F.lit(kind), file_id, name)


def public_url(base: Column, bucket: str, path: Column) -> Column:
    """Public address of an object; NULL when no base address is set."""
    trimmed = F.rtrim(base, F.lit("/"))
    return F.when(trimmed != "", F.concat(trimmed, F.lit(f"{PUBLIC_PREFIX}{bucket}/"), path))
