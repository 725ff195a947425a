import base64
import hashlib

import pytest

from tideline.llm.warc import read_archive, write_archive


@pytest.fixture
def pages(spark):
    return lambda *rows: spark.createDataFrame(
        list(rows), "page_id bigint, url string, html string, count string, sha256 string"
    )


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


ROWS = [
    (1, "http://a/", "<p>é</p>"), (5, "http://b/", "<p>é</p>"), (3, None, "<p>é</p>"),
    (4, "http://c/\r\nX: y", None), (2, "http://d/", ""), (7, "http://e/", "x" * 200_000),
]


def test_round_trip(spark, pages, tmp_path):
    df = pages(*[(*r, "clash", "clash") for r in ROWS])
    write_archive(df, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/payloads").count() == 3
    rows = {r["page_id"]: r for r in read_archive(spark, str(tmp_path)).collect()}
    assert set(rows) == {r[0] for r in ROWS}
    for page, _, html in ROWS:
        r = rows[page]
        assert bytes(r["payload"]) == (html or "").encode()
        assert r["payload_digest"] == digest(html)
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert int(fields["Content-Length"]) == len(rest) - 4
        assert fields["WARC-Payload-Digest"] == f"sha1:{digest(html)}"
        body = rest[:-4].partition(b"\r\n\r\n")[2]
        assert body == (b"" if r["record_type"] == "revisit" else (html or "").encode())
    assert {p: (r["record_type"], r["refers_to"]) for p, r in rows.items()} == {
        1: ("revisit", 5), 3: ("revisit", 5), 5: ("response", None), 4: ("response", None),
        2: ("revisit", 4), 7: ("response", None),
    }


def test_least_bytes(spark, pages, tmp_path):
    write_archive(pages(*[(*r, "", "") for r in ROWS]), str(tmp_path), min_bytes=9)
    rows = read_archive(spark, str(tmp_path)).collect()
    kinds = {r["page_id"]: r["record_type"] for r in rows}
    assert kinds == {1: "revisit", 3: "revisit", 5: "response", 4: "response", 2: "response",
                     7: "response"}


def test_equal_rows(spark, pages, tmp_path):
    write_archive(
        pages((1, "u", "a", "", ""), (1, "u", "a", "", ""), (None, "u", "a", "", "")),
        str(tmp_path),
    )
    rows = read_archive(spark, str(tmp_path)).collect()
    assert sorted(r["record_type"] for r in rows) == ["response", "revisit", "revisit"]
    assert {r["refers_to"] for r in rows if r["record_type"] == "revisit"} == {1}


def test_damage_is_found(spark, pages, tmp_path):
    path = str(tmp_path)
    write_archive(pages((1, "u", "a", "", "")), f"{path}/one")
    write_archive(pages((1, "u", "b", "", "")), f"{path}/two")
    headers = spark.read.parquet(f"{path}/one/headers")
    headers.write.mode("overwrite").parquet(f"{path}/two/headers")
    with pytest.raises(Exception, match="does not match"):
        read_archive(spark, f"{path}/two").collect()


def test_empty(spark, pages, tmp_path):
    write_archive(pages(), str(tmp_path))
    assert read_archive(spark, str(tmp_path)).count() == 0
