"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under the byte-level vocabulary."""
    from .tokens import count_tokens

    return count_tokens(
        table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), limit=1024
    )


@query
def op3_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again under the vocabulary with word ends."""
    from .bpe import bpe_round_trip

    path = tokenizer_file("word_bpe_49k.json")
    return bpe_round_trip(table(spark, folder, "documents"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Text counts and the verdict on every document."""
    from .quality import quality_rules

    return quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document."""
    from .language import identify_languages

    return identify_languages(table(spark, folder, "documents"))


@query
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents are equal, and which one of each group stays."""
    from .exact import exact_dedup

    return exact_dedup(table(spark, folder, "documents"))


ORACLE["op5_exact_dedup"] = r"""
WITH t AS (
    SELECT doc_id,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
    FROM documents)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(body) AS text_sha256
FROM t
WINDOW same AS (PARTITION BY body)
"""


@query
def op8_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written as a WARC record, and what the archive gives back."""
    from .warc import read_archive, write_archive

    path = f"{scratch_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
    write_archive(table(spark, folder, "pages"), path)
    return read_archive(spark, path).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        "payload_digest", "record_type", "refers_to",
    )


ORACLE["op8_warc_archive"] = r"""
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS hex
    FROM pages),
q AS (
    SELECT *, max(page_id) OVER (PARTITION BY body) AS top FROM p),
d AS (
    SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substr(hex, CAST(5 * i + 1 AS INT), 5))::INT)
              AS parts
    FROM q)
SELECT page_id,
       CAST(octet_length(body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((parts[i // 4 + 1] >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)), '')
           AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""


#: Of a thousand slots, what each source is to fill; all other sources share the rest.
MIXTURE = {f"src{i}": 60 - 2 * i for i in range(10)}
MIXTURE_OTHER = 1000 - sum(MIXTURE.values())
MIXTURE_BLOCK = 64


@query
def op2_source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place in a mixture of the sources by weight."""
    from .mixing import mix_sources

    docs = table(spark, folder, "documents")
    return mix_sources(docs, MIXTURE, MIXTURE_OTHER, MIXTURE_BLOCK)


ORACLE["op2_source_mixture"] = f"""
WITH RECURSIVE w AS (
    SELECT {[*MIXTURE.values(), MIXTURE_OTHER]} AS share, {[*MIXTURE]} AS names),
run AS (
    SELECT 0 AS t, list_transform(share, lambda x: 0) AS sent, NULL::INT AS pick FROM w
    UNION ALL
    SELECT t + 1, list_transform(sent, lambda n, i: n + CASE WHEN i = best THEN 1 ELSE 0 END), best
    FROM (
        SELECT t, sent, CAST(list_min(list_transform(sent, lambda n, i:
            CASE WHEN n < share[i] AND n * 1000 // share[i] <= t
                 THEN ((n + 1) * 1000 + share[i] - 1) // share[i] * 100 + i END)) % 100 AS INT)
            AS best
        FROM run, w WHERE t < 1000)),
plan AS (
    SELECT a.t - 1 AS slot, a.pick AS k, b.sent AS before, b.sent[a.pick] AS nth
    FROM run a JOIN run b ON b.t = a.t - 1),
docs AS (
    SELECT doc_id, source, coalesce(list_position(names, source), len(share)) AS k, share
    FROM documents, w),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY md5(CAST(doc_id AS VARCHAR))) - 1 AS n
    FROM docs),
blocks AS (SELECT *, n // {MIXTURE_BLOCK} AS block, n % {MIXTURE_BLOCK} AS place FROM numbered),
sizes AS (
    SELECT list(coalesce(c, 0) ORDER BY i) AS ends
    FROM (SELECT unnest(range(1, len(share) + 1)) AS i FROM w)
    LEFT JOIN (SELECT k, count(*) AS c FROM docs GROUP BY k) ON k = i)
SELECT doc_id, source, block,
       block // share[b.k] * 1000 + nth * 1000 // share[b.k] AS release,
       block // share[b.k] * 1000 + ((nth + 1) * 1000 + share[b.k] - 1) // share[b.k] AS deadline,
       block // share[b.k] * 1000 + slot AS slot,
       CAST(place + list_sum(list_transform(share, lambda x, i: least(
           ends[i], (block // share[b.k] * x + before[i]) * {MIXTURE_BLOCK}))) AS BIGINT)
           AS position
FROM blocks b JOIN plan ON plan.k = b.k AND plan.nth = block % share[b.k], sizes
"""


@query
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets in every document, and which of them their owners alone have."""
    from .secrets import listed, scan_secrets

    found = scan_secrets(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        "n_copied", "n_live",
    )


ORACLE["op7_secret_scan"] = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS body FROM documents),
forms(kind, rank, pattern, part, least) AS (VALUES
    ('assign', 0, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    ('access', 1, 'AKIA[A-Z0-9]+', 0, 20),
    ('hex', 2, '[0-9a-f]+', 0, 24),
    ('live', 3, '[A-Za-z0-9+_-]+', 0, 16)),
parts AS (
    SELECT doc_id, source, 'assign' AS kind,
           unnest(string_split_regex(body, (SELECT pattern FROM forms WHERE rank = 0))) AS gap,
           unnest(regexp_extract_all(body, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)) AS hit,
           unnest(regexp_extract_all(body, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)) AS value,
           unnest(range(1, 2 + len(regexp_extract_all(body, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)))) AS i
    FROM d
    UNION ALL
    SELECT doc_id, source, 'access', unnest(string_split_regex(body, 'AKIA[A-Z0-9]+')),
           unnest(regexp_extract_all(body, 'AKIA[A-Z0-9]+')),
           unnest(regexp_extract_all(body, 'AKIA[A-Z0-9]+')),
           unnest(range(1, 2 + len(regexp_extract_all(body, 'AKIA[A-Z0-9]+'))))
    FROM d
    UNION ALL
    SELECT doc_id, source, 'hex', unnest(string_split_regex(body, '[0-9a-f]+')),
           unnest(regexp_extract_all(body, '[0-9a-f]+')),
           unnest(regexp_extract_all(body, '[0-9a-f]+')),
           unnest(range(1, 2 + len(regexp_extract_all(body, '[0-9a-f]+'))))
    FROM d
    UNION ALL
    SELECT doc_id, source, 'live', unnest(string_split_regex(body, '[A-Za-z0-9+_-]+')),
           unnest(regexp_extract_all(body, '[A-Za-z0-9+_-]+')),
           unnest(regexp_extract_all(body, '[A-Za-z0-9+_-]+')),
           unnest(range(1, 2 + len(regexp_extract_all(body, '[A-Za-z0-9+_-]+'))))
    FROM d),
ends AS (
    SELECT doc_id, source, kind, value, length(hit) AS n,
           sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop
    FROM parts WHERE hit IS NOT NULL),
spans AS (
    SELECT doc_id, source, e.kind, rank, value, CAST(stop - n AS BIGINT) AS start,
           CAST(stop AS BIGINT) AS stop
    FROM ends e JOIN forms f ON f.kind = e.kind
    WHERE length(value) >= least
      AND (rank < 3 OR regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]'))),
cands AS (
    SELECT * FROM spans s
    WHERE rank < 3 OR NOT EXISTS (
        SELECT 1 FROM spans b
        WHERE b.rank < 3 AND b.doc_id = s.doc_id AND b.start < s.stop AND s.start < b.stop)),
freq AS (
    SELECT value, count(DISTINCT coalesce(source, '(none)')) AS owners, bool_or(rank < 3) AS known
    FROM cands GROUP BY value),
judged AS (
    SELECT c.*, owners <= 2 AS few
    FROM cands c JOIN freq f USING (value)
    WHERE rank < 3
       OR owners <= 2 AND (known OR len(list_distinct(string_split(value, ''))) >= 12)),
sums AS (
    SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
           count(*) FILTER (rank = 2) AS n_hex,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)
               FILTER (rank < 3) AS base,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
           count(*) FILTER (rank < 3 AND NOT few) AS n_copied,
           count(*) FILTER (rank < 3 AND few) AS n_live
    FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_copied, 0) AS n_copied,
       coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN sums USING (doc_id)
"""


@query
def op9_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents are near copies of one another, by links of any length."""
    from .jaccard import jaccard_join

    return jaccard_join(table(spark, folder, "documents"))


ORACLE["op9_ngram_jaccard"] = r"""
WITH RECURSIVE t AS (
    SELECT doc_id, list_filter(
               string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
               lambda w: w <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3),
                                          lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s
    FROM t),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n
    HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""


@query
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without passages that stand elsewhere too."""
    from .substrings import dedup_substrings

    found = dedup_substrings(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


ORACLE["op1_substring_dedup"] = r"""
WITH t AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda w: w <> '') AS w
    FROM documents),
windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 33)) AS s,
           unnest(list_transform(range(1, len(w) - 33),
                                 lambda i: md5(array_to_string(w[i:i + 34], ' ')))) AS h
    FROM t WHERE len(w) >= 35),
repeated AS (
    SELECT doc_id, s FROM windows
    WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS i FROM repeated),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM t),
sums AS (
    SELECT doc_id, count(gone.i) AS n_removed,
           string_agg(word, ' ' ORDER BY i) FILTER (gone.i IS NULL) AS kept
    FROM words LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN sums USING (doc_id)
"""


@query
def op11_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """How good every document is, by trees over its statistics."""
    from .boosting import score_quality

    return score_quality(
        table(spark, folder, "documents"), table(spark, folder, "labels"),
        held_out="crc32(CAST(id AS STRING)) % 3 = 1",
    )


@query
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding on the four leading components, whitened."""
    from .whitening import whiten

    found = whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document, some documents made periodic beforehand."""
    from .periodic import periodic_runs

    runs = periodic_runs(_made_periodic(table(spark, folder, "documents")))
    # The longest run first; of equal ones the smallest start, then period.
    best = F.array_max(
        F.transform(
            "runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))
        )
    )["run"]
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return runs.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length",
        "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _made_periodic(docs: DataFrame) -> DataFrame:
    """Every document whose id's checksum ends in 0 with its words repeated from some place on."""
    words = docs.select(
        "doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h")
    ).withColumn("w", F.when(F.col("h") % 10 == 0, F.expr(
        r"filter(split(text, '[\\x20\\x09-\\x0D]+'), x -> x <> '')"
    )))
    planned = words.withColumns({"n": F.size("w"), "g": F.expr("h div 10")})
    planned = planned.withColumn("a", F.expr("IF(n > 0, g % n, 0)"))
    planned = planned.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    moved = F.expr(
        "array_join(transform(w, (x, i) -> IF(i < a, x, w[CAST(a + (i - a) % p AS INT)])), ' ')"
    )
    return planned.select("doc_id", F.when(F.col("n") > 0, moved).otherwise(F.col("text")).alias("text"))


#: Blocks of up to so many words are ranked in SQL: enough for every text of 65,536 words.
_SQL_BLOCKS = [4 << i for i in range(13)]


def _ranked(half: int) -> str:
    """A table of the blocks of twice ``half`` words, numbered in each document."""
    return f"""b{2 * half} AS MATERIALIZED (
    SELECT doc_id, i, dense_rank() OVER (PARTITION BY doc_id ORDER BY r, f) AS r
    FROM (SELECT *, lead(r, {half}) OVER (PARTITION BY doc_id ORDER BY i) AS f FROM b{half})
    WHERE f IS NOT NULL),
"""


def _distances(size: int) -> str:
    least = 1 if size == 4 else size // 2 + 1
    return f"""SELECT doc_id, d
    FROM (SELECT doc_id, lead(i) OVER (PARTITION BY doc_id, r ORDER BY i) - i AS d FROM b{size})
    WHERE d BETWEEN {least} AND {size}"""


ORACLE["op13_periodic_runs"] = rf"""
WITH t AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda w: w <> '') AS w,
           xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''),
                                          lambda c: ord(c)::BIGINT),
               lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda x, y: xor(x >> 1, (x & 1) * 3988292384)), 4294967295::BIGINT),
               4294967295::BIGINT) AS h
    FROM documents),
planned AS (
    SELECT *, CAST((h // 10) % len(w) AS INT) AS a,
           CAST(1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) AS INT) AS p
    FROM t WHERE len(w) > 0),
texts AS (
    SELECT doc_id, CASE WHEN h % 10 <> 0 THEN w ELSE list_transform(range(0, len(w)),
           lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) END AS w
    FROM planned),
words AS MATERIALIZED (
    SELECT doc_id, unnest(range(0, len(w))) AS i, unnest(w) AS word FROM texts),
b1 AS MATERIALIZED (
    SELECT doc_id, i, dense_rank() OVER (PARTITION BY doc_id ORDER BY word) AS r FROM words),
{"".join(map(_ranked, [1, 2, *_SQL_BLOCKS[:-1]]))}periods AS MATERIALIZED (
    {" UNION ".join(map(_distances, _SQL_BLOCKS))}),
equal AS (
    SELECT x.doc_id, d, x.i
    FROM periods JOIN words x USING (doc_id)
    JOIN words y ON y.doc_id = x.doc_id AND y.i = x.i + d AND y.word = x.word),
stretches AS (
    SELECT doc_id, d AS period, min(i) AS start, count(*) + d AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM equal)
    GROUP BY doc_id, d, island
    HAVING count(*) + d >= greatest(6, 4 * d)),
runs AS MATERIALIZED (
    SELECT * FROM stretches s
    WHERE NOT EXISTS (
        SELECT 1 FROM stretches z
        WHERE z.doc_id = s.doc_id AND z.period < s.period AND z.start <= s.start
          AND z.start + z.length >= s.start + s.length)),
sums AS (
    SELECT doc_id, count(*) AS n_runs,
           arg_max({{'start': start, 'length': length, 'period': period}},
                   {{'l': length, 's': -start, 'p': -period}}) AS best,
           string_agg(start || ',' || length || ',' || period || chr(10), ''
                      ORDER BY start, period) AS listed
    FROM runs GROUP BY doc_id),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body
    FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length,
       best.period AS period, 1000 * best.length // best.period AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM t LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
