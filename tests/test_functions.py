import hashlib
import json
import random
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.functions import structured, temporal
from tideline.functions.keys import natural_key, row_hash, surrogate_id
from tideline.functions.similarity import _lcs_words, indel_ratio, lcs_length
from tideline.functions.text import column_name, column_name_expr, fold_text, normalize_value
from tideline.sources.offers import canonical_names

LOOSE = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def python_fold(text):
    text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    return " ".join(text.lower().split())


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_column_names(spark):
    cases = {"NIVEL FORMACIÓN": "NIVEL_FORMACION", "CANTÓN": "CANTON",
             "  campo  amplio ": "CAMPO_AMPLIO", "¿a½?": "A12"}
    assert {k: column_name(k) for k in cases} == cases
    found = values(spark, [(k,) for k in cases], "s string", "s", column_name_expr(F.col("s")))
    assert found == list(cases.items())


def test_colliding_columns():
    with pytest.raises(ValueError, match="Duplicate columns"):
        canonical_names(["NOMBRE IES", "NOMBRE_IES"])


def test_every_character_folds_like_python(spark):
    chars = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c <= 0xDFFF]
    rows = [("x" + "".join(chars[i:i + 16]) + " Y",) for i in range(0, len(chars), 16)]
    for text, folded in values(spark, rows, "s string", "s", fold_text(F.col("s"))):
        assert folded == python_fold(text)


def test_normalize_value(spark):
    rows = [(None,), ("",), (" ",), ("Á  b\tC",), ("a b\x1cc",)]
    found = values(spark, rows, "s string", normalize_value(F.col("s")))
    assert [v for (v,) in found] == [None, None, "", "a b c", "a b c"]


@LOOSE
@given(st.lists(st.text(max_size=30), min_size=1, max_size=50))
def test_fold_is_idempotent(spark, texts):
    folded = fold_text(F.col("s"))
    for once, twice in values(spark, [(t,) for t in texts], "s string", folded, fold_text(folded)):
        assert once == twice


def test_natural_key(spark):
    parts = "a string, b string, c string"
    key = natural_key(F.col("a"), F.col("b"), F.col("c"))
    found = values(spark, [("uni a", " x ", "quito"), ("p", "q", None), (None,) * 3], parts, key)
    assert [k for (k,) in found] == ["uni a|x|quito", "p|q|", "||"]


def python_hash(key, status):
    body = json.dumps({"natural_key": key, "estado_norm": status or ""}, sort_keys=True)
    return hashlib.sha256(body.encode()).hexdigest()


def test_row_hash_golden(spark):
    key = ("escuela politecnica nacional|maestria en automatizacion y control electronico "
           "industrial|ingenieria, industria y construccion|cuarto nivel o posgrado|presencial|"
           "pichincha|quito")
    rows = [("a|b|c|d|e|f|g", "activa"),
            (key, "no vigente habilitado para registro de titulos")]
    found = values(spark, rows, "k string, s string", row_hash(F.col("k"), F.col("s")))
    assert [h for (h,) in found] == [
        "7c549b3596e669090c9247834d1acf5ab64b46008ca80d87356d19f4bb7d5da8",
        "0bbdd25bfa56559182934da8497c11eac35a3d377d403d51412293101a2c40c7",
    ]


def test_row_hash_escapes(spark):
    chars = [chr(c) for c in [*range(1, 0x300), *range(0x1F600, 0x1F640)]]
    rows = [(f'a{c}\\"{c}', None if i % 2 else c) for i, c in enumerate(chars)]
    found = values(
        spark, rows, "k string, s string", "k", "s", row_hash(F.col("k"), F.col("s"))
    )
    assert all(h == python_hash(k, s) for k, s, h in found)


def test_surrogate_id_tells_null_from_empty(spark):
    rows = [("a", None), ("a", ""), ("a", "~"), (None, "a")]
    found = values(spark, rows, "a string, b string", surrogate_id(F.col("a"), F.col("b")))
    assert len(set(found)) == 4


def python_lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


@LOOSE
@given(st.lists(st.tuples(st.text("abé ñ", max_size=70), st.text("abé ñ", max_size=70)),
                min_size=1, max_size=40))
def test_lcs_against_python(spark, pairs):
    found = values(
        spark, pairs, "a string, b string", "a", "b", lcs_length(F.col("a"), F.col("b")),
        F.when((F.col("a") != "") & (F.col("b") != ""), _lcs_words(F.col("a"), F.col("b"))),
    )
    for a, b, length, by_words in found:
        assert length == python_lcs(a, b)
        assert by_words in (None, length)


def test_lcs_of_long_strings(spark):
    """Lengths around whole words of 62 characters, runs that carry through words, any script."""
    rnd = random.Random(11)
    pairs = [("a" * 300, "a" * 249), ("ab" * 100, "ba" * 100), ("x" * 124, "y" * 125)]
    for n in (61, 62, 63, 124, 125, 186, 187, 400):
        for letters in ("ab", "abcdéfgh ñ", "👍ñ✓"):
            a = "".join(rnd.choice(letters) for _ in range(n))
            b = "".join(c for c in a if rnd.random() < 0.9) + "".join(rnd.sample(letters, 2))
            pairs += [(a, b), (b, a[::-1])]
    found = values(spark, pairs, "a string, b string", "a", "b", lcs_length(F.col("a"), F.col("b")))
    for a, b, length in found:
        assert length == python_lcs(a, b)


def test_indel_ratio(spark):
    cases = [("quito", "quit", 88.8889), ("el oro", "eloro", 90.9091),
             ("santo domingo de los tsachilas", "santodomingodelostsachilas", 92.8571),
             ("nation_x", "nation_0", 87.5), ("", "", 100.0), ("a", "", 0.0)]
    found = values(
        spark, cases, "a string, b string, e double", "e",
        F.round(indel_ratio(F.col("a"), F.col("b")), 4),
    )
    assert all(e == r for e, r in found)


def test_buckets(spark):
    ts = F.lit("2024-05-16 13:45:10").cast("timestamp_ntz")
    expected = {"hour": "2024-05-16 13", "day": "2024-05-16 00", "week": "2024-05-13 00",
                "month": "2024-05-01 00", "year": "2024-05-16 00", "DAY": "2024-05-16 00"}
    row = spark.range(1).select(
        *[F.date_format(temporal.bucket_start(b, ts), "yyyy-MM-dd HH").alias(b + "_")
          for b in expected]
    ).first()
    assert list(row) == list(expected.values())


def test_service_status(spark):
    code = F.col("c")
    found = values(spark, [(200,), (404,), (500,), (None,)], "c int",
                   structured.availability(code), structured.status_code(code))
    assert found == [("up", 200), ("up", 404), ("down", 500), ("down", 0)]


def test_documents_and_casts(spark):
    rows = [('{"a": 1, "b": 2.5}', "12"), ("{broken", "x"), (None, None)]
    found = values(spark, rows, "d string, n string", structured.metric_map(F.col("d")),
                   structured.to_number(F.col("n")))
    assert found == [({"a": 1.0, "b": 2.5}, 12.0), ({}, None), ({}, None)]


def test_public_url(spark):
    url = structured.public_url(F.col("b"), "bkt", F.lit("a/b"))
    found = values(spark, [("https://x.org//",), ("",), (None,)], "b string", url)
    assert found == [("https://x.org/storage/v1/object/public/bkt/a/b",), (None,), (None,)]
