"""A content-addressed archive of web pages.

Payload bytes are stored once, under their SHA-256; record headers are stored exactly as they
stand in a WARC file, with the digest that leads to the payload. Joining both gives the records
back, and every digest is computed again when that happens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32; five hexadecimal digits are four of these."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), _HEX32, _BASE32)


def _record_id(*values: Column) -> Column:
    text = F.md5(F.concat_ws("/", *(F.coalesce(v.cast("string"), F.lit("")) for v in values)))
    parts = [F.substring(text, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for NULL. Line ends inside a value are percent-encoded."""
    value = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"),
                      F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _field(headers: Column, name: str) -> Column:
    found = F.regexp_extract(headers, rf"\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def _checked(good: Column, value: Column, message: str) -> Column:
    return F.when(F.coalesce(good, F.lit(False)), value).otherwise(F.raise_error(F.lit(message)))


def write_archive(
    pages: DataFrame,
    path: str,
    date: str = "1970-01-01T00:00:00Z",
    min_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """Write ``path/payloads`` and ``path/headers`` for one record per row of ``pages``.

    Of records with equal payloads of at least ``min_bytes``, the one with the largest id is a
    response, and the others revisit it; a NULL id is smaller than any other, the larger URL
    decides among equal ids, and one of several equal rows is the response. A NULL page is an
    empty payload. A NULL URL has no line in the header. Other columns are ignored, whatever
    their names. Without pages both tables are empty.
    """
    payload = F.encode(F.coalesce(pages[html_col], F.lit("")), "UTF-8")
    rows = pages.select(
        pages[id_col].alias("id"), pages[url_col].alias("url"), payload.alias("payload")
    ).withColumn("sha256", F.sha2("payload", 256))
    rows.select("sha256", "payload").dropDuplicates(["sha256"]).write.mode("overwrite").parquet(
        f"{path}/payloads"
    )

    # Equal rows are counted, so that each can be told from the others.
    facts = {"bytes": F.octet_length("payload"), "sha1": base32_sha1(F.col("payload"))}
    rows = rows.withColumns(facts).groupBy("id", "url", "sha256", "bytes", "sha1").count()
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "count")))
    top = rows.groupBy("sha256").agg(
        F.max(F.struct("id", "url")).alias("top"),
        (F.min("sha1") == F.max("sha1")).alias("one_sha1"),
        (F.min("bytes") == F.max("bytes")).alias("one_size"),
    )
    rows = rows.join(top, "sha256")
    large = F.col("bytes") >= min_bytes
    first = (
        (F.col("copy") == 1)
        & F.col("id").eqNullSafe(F.col("top.id"))
        & F.col("url").eqNullSafe(F.col("top.url"))
    )
    revisit = large & ~first
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit("\r\n\r\n"),
    )
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    headers = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("id"), F.col("url"), F.col("copy"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line(
            "WARC-Refers-To",
            F.when(revisit, _record_id(F.col("top.id"), F.col("top.url"), F.lit(1))),
        ),
        _line("X-Page-ID", F.col("id")),
        _line("X-Refers-To-Page-ID", F.when(revisit, F.col("top.id"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block_bytes),
        F.lit("\r\n"),
    )
    sound = F.col("one_sha1") & F.col("one_size")
    rows.select(
        _checked(sound, F.col("sha256"), "different payloads have one digest").alias("sha256"),
        headers.alias("headers"),
        http.alias("http"),
    ).write.mode("overwrite").parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archive: ``headers``, ``record_type``, ``page_id``, ``refers_to``,
    ``payload``, ``payload_digest`` and ``record``, the bytes of the record in a WARC file.

    The payload is the whole one for revisits too. It is an error if a payload is missing, or if
    a digest or length computed from it differs from what is stored.
    """
    stored = spark.read.parquet(f"{path}/payloads")
    stored = stored.select(
        _checked(
            F.sha2("payload", 256) == F.col("sha256"), F.col("sha256"),
            "a stored payload does not have its digest",
        ).alias("sha256"),
        "payload",
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )
    records = spark.read.parquet(f"{path}/headers").join(stored, "sha256", "left")
    kind = _field(F.col("headers"), "WARC-Type")
    sha1 = _field(F.col("headers"), "WARC-Payload-Digest")
    body = F.when(kind == "revisit", F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    block = F.concat(F.encode("http", "UTF-8"), body)
    length = _field(F.col("headers"), "Content-Length").cast("long")
    good = (sha1 == F.concat(F.lit("sha1:"), F.col("payload_digest"))) & (
        length == F.octet_length("http") + F.octet_length(body)
    )
    return records.select(
        "headers",
        kind.alias("record_type"),
        _field(F.col("headers"), "X-Page-ID").cast("long").alias("page_id"),
        _field(F.col("headers"), "X-Refers-To-Page-ID").cast("long").alias("refers_to"),
        "payload",
        _checked(good, F.col("payload_digest"), "a record does not match its payload").alias(
            "payload_digest"
        ),
        F.concat(
            F.encode("headers", "UTF-8"), block, F.encode(F.lit("\r\n\r\n"), "UTF-8")
        ).alias("record"),
    )
