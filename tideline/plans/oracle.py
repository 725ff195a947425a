"""The registered queries once more, as SQL over the same tables."""

from __future__ import annotations

_OFFERS = """
base AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
    s_name AS provider, CASE WHEN s_acctbal >= 5000 THEN 'TYPE A' ELSE 'TYPE B' END AS provider_type,
    CASE s_suppkey % 3 WHEN 0 THEN 'PUBLIC' WHEN 1 THEN 'PRIVATE' ELSE 'MIXED' END AS funding_type,
    p_name AS program, p_type AS field, p_brand AS level, l_returnflag AS modality,
    r_name AS province, n_name AS canton, o_orderstatus AS status, o_orderpriority AS o_priority,
    CAST(year(o_orderdate) AS VARCHAR) AS file_id,
    make_timestamp(year(o_orderdate), 12, 31, 0, 0, 0) AS run_ts,
    (l_orderkey * 10 + l_linenumber) * 1000000000
      + CAST(round(l_extendedprice * 100) AS BIGINT) % 1000000000 AS row_num
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)
"""
_STAR = """
offers AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
  provider, provider_type, funding_type, program, field, level, modality, province, canton, status,
  file_id FROM base)
"""
_RUNS = """
runs AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS file_id, max(o_orderdate) AS ingested_at
  FROM orders GROUP BY 1)
"""
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"
_LAST = ", ".join(f"{c} DESC" for c in _ORDER.split(", "))


def _norm(column: str) -> str:
    return f"lower(trim(regexp_replace({column}, '\\s+', ' ', 'g')))"


def _keyed(source: str, place: str) -> str:
    """Natural key and row hash over ``source``; ``place`` gives the two territory parts."""
    parts = ", ".join(
        f"coalesce({_norm(c)}, '')" for c in ("provider", "program", "field", "level", "modality")
    )
    return f"""
keyed0 AS (SELECT *, concat_ws('|', {parts}, {place}) AS natural_key, {_norm('status')} AS status_norm
  FROM {source}),
keyed AS (SELECT *, sha256('{{"estado_norm": "' || status_norm || '", "natural_key": "'
  || natural_key || '"}}') AS row_hash FROM keyed0)
"""


_PLAIN = _keyed("base", f"{_norm('province')}, {_norm('canton')}")

_SPOILED = f"""
spoiled AS (SELECT * REPLACE (
    CASE l_suppkey % 5 WHEN 0 THEN province WHEN 1 THEN lower(province)
      WHEN 2 THEN '  ' || province || ' ' WHEN 3 THEN substr(province, 1, 1) || substr(province, 3)
      ELSE 'unknown' END AS province,
    CASE WHEN l_suppkey % 11 = 7 THEN 'elsewhere' ELSE canton END AS canton,
    CASE WHEN l_partkey % 97 <> 5 THEN provider END AS provider,
    CASE WHEN l_partkey % 89 <> 4 THEN program END AS program) FROM base)
"""


def _scores(pairs: str, name: str) -> str:
    """Similarity of the (a, b) pairs of ``pairs`` by a row-wise LCS programme."""
    return f"""
{name}_lcs(a, b, i, row) AS (
  SELECT a, b, 0, list_transform(range(0, length(b) + 1), lambda x: 0::BIGINT) FROM {pairs}
  UNION ALL
  SELECT a, b, i + 1, list_reduce(
    list_prepend([0::BIGINT], list_transform(range(1, length(b) + 1), lambda j: [j])),
    lambda cur, j: list_append(cur, CASE WHEN substr(b, j[1]::INT, 1) = substr(a, i + 1, 1)
      THEN row[j[1]] + 1 ELSE greatest(row[j[1] + 1], cur[-1]) END))
  FROM {name}_lcs WHERE i < length(a)),
{name} AS (SELECT a, b, CASE WHEN length(a) + length(b) = 0 THEN 100.0 ELSE
  (1.0::DOUBLE - (length(a) + length(b) - 2 * row[-1])::DOUBLE / (length(a) + length(b))) * 100
  END AS score
  FROM {name}_lcs WHERE i = length(a))
"""


_MATCH = f"""
names AS (SELECT DISTINCT province AS province_raw, canton AS canton_raw,
  coalesce({_norm('province')}, '') AS p, coalesce({_norm('canton')}, '') AS c FROM spoiled),
provinces AS (SELECT lower(r_name) AS b, min(n_nationkey) AS ord FROM nation
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1),
cantons AS (SELECT lower(r_name) AS province, lower(n_name) AS b, n_nationkey AS ord FROM nation
  JOIN region ON n_regionkey = r_regionkey),
p_pairs AS (SELECT DISTINCT p AS a, b FROM names, provinces),
{_scores('p_pairs', 'p_score')},
p_best AS (SELECT a AS p, arg_max(b, (score, -ord)) AS choice, max(score) AS score
  FROM p_score JOIN provinces USING (b) GROUP BY 1),
placed AS (SELECT names.*, CASE WHEN score >= 85 THEN choice END AS province_norm,
  CASE WHEN score >= 85 THEN score ELSE 0 END AS score_province FROM names JOIN p_best USING (p)),
c_pairs AS (SELECT DISTINCT c AS a, b FROM placed JOIN cantons ON province = province_norm),
{_scores('c_pairs', 'c_score')},
c_best AS (SELECT province, a AS c, arg_max(b, (score, -ord)) AS choice, max(score) AS score
  FROM c_score JOIN cantons USING (b) GROUP BY 1, 2),
mapping AS (SELECT placed.province_raw, placed.canton_raw, province_norm, score_province,
  CASE WHEN score >= 85 THEN choice END AS canton_norm,
  CASE WHEN score >= 85 THEN score ELSE 0 END AS score_canton
  FROM placed LEFT JOIN c_best ON province = province_norm AND c_best.c = placed.c),
matched AS (SELECT spoiled.*, province_norm, canton_norm, score_province,
  coalesce(score_canton, 0) AS score_canton,
  CASE WHEN province_norm IS NULL THEN 'failed_prov' WHEN canton_norm IS NULL THEN 'failed_canton'
    WHEN score_province = 100 AND score_canton = 100 THEN 'exact' ELSE 'fuzzy' END AS match_method
  FROM spoiled JOIN mapping ON province = province_raw AND canton = canton_raw)
"""

_CHECKED = _keyed("matched", "coalesce(province_norm, ''), coalesce(canton_norm, '')")
_OFFICIAL = """
official AS (SELECT DISTINCT lower(r_name) AS p, lower(n_name) AS c FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_suppkey % 3 = 2),
flagged AS (SELECT keyed.*, province_norm IS NULL OR canton_norm IS NULL AS bad_place,
  NOT (province_norm IS NULL OR canton_norm IS NULL) AND official.p IS NULL AS bad_pair
  FROM keyed LEFT JOIN official ON official.p = province_norm AND official.c = canton_norm)
"""


def _star(tail: str, *extra: str) -> str:
    return "WITH " + ", ".join((_OFFERS, _STAR, *extra)) + tail


def _counts(column: str, limit: int | None = None) -> str:
    tail = f" ORDER BY offers DESC, {column} LIMIT {limit}" if limit else ""
    return _star(
        f"SELECT {column}, count(*) AS offers FROM offers WHERE {column} IS NOT NULL GROUP BY 1"
        + tail
    )


def _diversity(group: str, category: str, source: str = "offers") -> str:
    return f"""
shares AS (SELECT {group}, {category}, count(*) AS n,
  count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY {group}) AS p FROM {source} GROUP BY 1, 2),
mixed AS (SELECT {group}, round(sum(p * p), 6) AS hhi, round(abs(sum(p * log2(p))), 6) AS entropy
  FROM shares GROUP BY 1)
"""


def _top(label: str, n: int) -> str:
    return f"""(SELECT string_agg({label} || ': ' || n, ', ' ORDER BY n DESC, {label}) FROM
  (SELECT {label}, count(*) AS n FROM offers GROUP BY 1 ORDER BY n DESC, {label} LIMIT {n}))
  AS top_{label}"""


def _dim(table: str, keys: str, columns: str, update: str | None = None, where: str = "true") -> str:
    """A dimension loaded with the earlier runs, then with the newest."""
    names = [k.strip() for k in keys.split(",")]
    ident = " || chr(31) || ".join(f"'=' || {k}" for k in names)
    first = f"""row_number() OVER (PARTITION BY file_id = newest, {keys} ORDER BY row_num) = 1"""
    norms = ", ".join(
        f"{_norm(c)} AS {c}_norm"
        for c in ("provider", "program", "field", "level", "modality", "province", "canton")
    )
    shown = [c.strip() for c in columns.split(",")]
    updated = [c.strip() for c in update.split(",")] if update else []
    picks = ", ".join(
        f"coalesce(n.{c}, o.{c}) AS {c}" if c in updated else f"coalesce(o.{c}, n.{c}) AS {c}"
        for c in shown
    )
    touched = (
        "CASE WHEN n.hit THEN TIMESTAMP '2003-01-01' ELSE TIMESTAMP '2002-01-01' END"
        if update else
        "CASE WHEN o.hit THEN TIMESTAMP '2002-01-01' ELSE TIMESTAMP '2003-01-01' END"
    )
    return f"""WITH {_OFFERS},
staged AS (SELECT * REPLACE (o_priority AS provider_type, modality AS funding_type), {norms},
  max(file_id) OVER () AS newest FROM base),
firsts AS (SELECT *, {ident} AS ident, true AS hit, file_id = newest AS late FROM staged
  WHERE {where} QUALIFY {first}),
o AS (SELECT * FROM firsts WHERE NOT late), n AS (SELECT * FROM firsts WHERE late)
SELECT sha256(coalesce(o.ident, n.ident)) AS {table}_id, {picks},
  CASE WHEN o.hit THEN TIMESTAMP '2002-01-01' ELSE TIMESTAMP '2003-01-01' END AS created_at,
  {touched} AS updated_at
FROM o FULL JOIN n ON o.ident = n.ident"""


_SCD = f"""
WITH {_OFFERS}, {_PLAIN},
kept AS (SELECT * FROM keyed QUALIFY
  row_number() OVER (PARTITION BY natural_key, file_id ORDER BY {_LAST}) = 1),
flags AS (SELECT *, lag(row_hash) OVER w AS before FROM kept
  WINDOW w AS (PARTITION BY natural_key ORDER BY file_id)),
numbered AS (SELECT *, sum(CASE WHEN before = row_hash THEN 0 ELSE 1 END) OVER
  (PARTITION BY natural_key ORDER BY file_id) AS version FROM flags)
"""
_VERSIONS = """
spans AS (SELECT natural_key, version, any_value(row_hash) AS row_hash,
  any_value(status_norm) AS status_norm, min(file_id) AS first_file, max(file_id) AS last_file
  FROM numbered {where} GROUP BY 1, 2),
versions AS (SELECT *, lead(first_file) OVER (PARTITION BY natural_key ORDER BY version) AS next
  FROM spans)
"""
_YEAR_END = "make_timestamp(CAST({} AS BIGINT), 12, 31, 0, 0, 0)"


def _series(bucket: str) -> str:
    sums = ", ".join(
        f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}"
        for c in ("rows_loaded", "ingest_new", "ingest_updated", "ingest_unchanged",
                  "skipped_missing_dims")
    )
    return (
        f"WITH {_LEDGER} SELECT CAST(date_trunc('{bucket}', ingested_at) AS TIMESTAMP) AS period, "
        f"count(*) AS files, {sums} FROM ledger WHERE status = 'success' GROUP BY 1"
    )


_LEDGER = """
ledger AS (SELECT CAST(event_id AS VARCHAR) AS file_id, ts AS ingested_at,
  CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'success' END AS status,
  event_id % 1000 AS rows_loaded, CASE WHEN event_id % 7 <> 0 THEN event_id % 13 END AS ingest_new,
  event_id % 5 AS ingest_updated, CAST(NULL AS BIGINT) AS ingest_unchanged,
  CASE WHEN event_id % 3 = 0 THEN event_id % 2 END AS skipped_missing_dims,
  value AS duration_seconds, user_id * 1000 AS file_size_bytes FROM events)
"""
_CHECKS = """
checks AS (SELECT event_id AS check_id, user_id AS service_name, ts AS created_at,
  value AS latency_ms, CASE WHEN event_type IN ('error', 'signup') THEN 'down' ELSE 'up' END AS status,
  CASE event_type WHEN 'error' THEN 503 WHEN 'view' THEN 404 WHEN 'signup' THEN 0 ELSE 200 END
  AS status_code FROM events)
"""
_METRICS = ("rows_loaded", "ingest_new", "ingest_updated", "ingest_unchanged",
            "skipped_missing_dims")
_FOLD = r"trim(regexp_replace(lower(regexp_replace({}, '[^\x00-\x7F]', '', 'g')), '[\t-\r\x1c-\x20]+', ' ', 'g'))"
_FOLDED = _FOLD.format("strip_accents({})")
_ISSUES = """
issues AS (SELECT event_id AS issue_id, ts AS created_at, event_type AS issue_type,
  props AS detail FROM events)
"""
_FINDINGS = """
findings AS (
  SELECT file_id, natural_key, row_num, 'duplicate_natural_key' AS issue_type,
    '{{"row_index":' || (row_num - 1) || ',"row_hash":"' || row_hash || '"}}' AS detail
  FROM (SELECT *, count(*) OVER (PARTITION BY file_id, natural_key) AS k FROM {source}) WHERE k > 1
  UNION ALL
  SELECT file_id, natural_key, NULL, 'conflicting_estado',
    '{{"states":["' || string_agg(status_norm, '","' ORDER BY r, status_norm) || '"]}}'
  FROM (SELECT file_id, natural_key, status_norm, min(row_num) AS r FROM {source} GROUP BY 1, 2, 3)
  GROUP BY 1, 2 HAVING count(*) > 1)
"""


def _violations(table: str, rule: str, sql: str) -> str:
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, ({sql}) AS violations"


def _collisions(table: str, columns: str, where: str = "true") -> str:
    return _violations(
        table, f"unique({columns})",
        f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {where} GROUP BY {columns} "
        "HAVING count(*) > 1)",
    )


def _orphans(table: str, column: str, target: str, key: str) -> str:
    return _violations(
        table, f"reference({column}->{target}.{key})",
        f"SELECT count(*) FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN "
        f"(SELECT {key} FROM {target})",
    )


_AUDIT = f"WITH {_LEDGER} " + " UNION ALL ".join(
    [
        _collisions("orders", "o_orderkey"),
        _collisions("part", "p_partkey"),
        _collisions("part", "p_name,p_type,p_brand"),
        _collisions("supplier", "s_name", "s_acctbal > 0"),
        _collisions("lineitem", "l_orderkey,l_linenumber"),
        _violations("orders", "domain(o_orderstatus)",
                    "SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"),
        _violations("files", "domain(status)", "SELECT count(*) FROM ledger WHERE status NOT IN "
                    "('success', 'failed', 'skipped', 'running')"),
        _violations("documents", "not_null(text)",
                    "SELECT count(*) FROM documents WHERE text IS NULL"),
        _violations("files", "not_null(ingest_new)",
                    "SELECT count(*) FROM ledger WHERE ingest_new IS NULL"),
        _orphans("lineitem", "l_orderkey", "orders", "o_orderkey"),
        _orphans("lineitem", "l_suppkey", "customer", "c_custkey"),
        _orphans("orders", "o_custkey", "customer", "c_custkey"),
        _orphans("nation", "n_regionkey", "region", "r_regionkey"),
        _orphans("documents", "doc_id", "labels", "doc_id"),
    ]
)

_DQ = f"WITH RECURSIVE {_OFFERS}, {_SPOILED}, {_MATCH}, {_CHECKED}, {_OFFICIAL}"
_KEY_METRICS = """
SELECT file_id, 'duplicates_in_file' AS metric,
  CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS value FROM per_key GROUP BY 1
UNION ALL SELECT file_id, 'conflicting_estado', count(*) FILTER (states > 1) FROM per_key GROUP BY 1
"""
_PER_KEY = """
per_key AS (SELECT file_id, natural_key, count(*) AS n, count(DISTINCT status_norm) AS states
  FROM keyed GROUP BY 1, 2)
"""

# The stored warehouse: rows without a territory are skipped, runs load a millisecond apart.
_HOUSE = f"""{_DQ}, {_PER_KEY},
loads AS (SELECT file_id, TIMESTAMP '2002-01-01' + to_milliseconds(
  CAST(row_number() OVER (ORDER BY file_id) - 1 AS BIGINT)) AS stamp FROM (SELECT DISTINCT file_id FROM base)),
lasts AS (SELECT * FROM flagged QUALIFY
  row_number() OVER (PARTITION BY natural_key, file_id ORDER BY row_num DESC) = 1),
flags AS (SELECT *, lag(row_hash) OVER (PARTITION BY natural_key ORDER BY file_id) AS before
  FROM lasts JOIN loads USING (file_id) WHERE NOT bad_place),
numbered AS (SELECT *, sum(CASE WHEN before = row_hash THEN 0 ELSE 1 END) OVER
  (PARTITION BY natural_key ORDER BY file_id) AS version FROM flags),
spans AS (SELECT natural_key, version, any_value(row_hash) AS row_hash,
  arg_min(status, stamp) AS status, min(stamp) AS opened, max(stamp) AS touched FROM numbered GROUP BY 1, 2),
versions AS (SELECT *, lead(opened) OVER (PARTITION BY natural_key ORDER BY version) AS next
  FROM spans),
changes AS (SELECT file_id, count(*) FILTER (before IS NULL) AS ingest_new,
  count(*) FILTER (before <> row_hash) AS ingest_updated,
  count(*) FILTER (before = row_hash) AS ingest_unchanged FROM flags GROUP BY 1),
runs AS (SELECT file_id, stamp, rows_loaded, coalesce(ingest_new, 0) AS ingest_new,
  coalesce(ingest_updated, 0) AS ingest_updated, coalesce(ingest_unchanged, 0) AS ingest_unchanged,
  skipped_missing_dims FROM (SELECT file_id, count(*) AS rows_loaded FROM flagged GROUP BY 1)
  JOIN loads USING (file_id) LEFT JOIN changes USING (file_id)
  JOIN (SELECT file_id, count(*) FILTER (bad_place) AS skipped_missing_dims FROM lasts GROUP BY 1)
  USING (file_id))
"""
_HOUSE_METRICS = (
    "rows_loaded", "ingest_new", "ingest_updated", "ingest_unchanged", "skipped_missing_dims",
)

ORACLE: dict[str, str] = {
    "star_offers": _star("SELECT * FROM offers LEFT JOIN runs USING (file_id)", _RUNS),
    "filter_facets": _star(
        """SELECT * FROM offers LEFT JOIN runs USING (file_id)
        WHERE province IN ('ASIA', 'EUROPE') AND modality IN ('A', 'R') AND status IN ('F', 'O')
        AND provider_type = 'TYPE A' AND ingested_at >= TIMESTAMP '1996-01-01'
        AND ingested_at < TIMESTAMP '2000-01-01'""",
        _RUNS,
    ),
    "facet_options": _star(
        " UNION ".join(
            f"SELECT '{f}' AS facet, {f} AS value FROM offers"
            + (" WHERE province IN ('ASIA', 'EUROPE')" if f == "canton" else "")
            for f in ("province", "canton", "field", "level", "modality", "provider_type",
                      "funding_type", "status")
        )
    ),
    "date_extent": "SELECT min(ts) AS first_at, max(ts) AS last_at FROM events",
    "date_window": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05' "
                   "AND ts < TIMESTAMP '2024-01-21'",
    "flagship": _star(
        """SELECT province, offers, field_diversity, hhi, entropy FROM (
        SELECT province, count(*) AS offers, count(DISTINCT field) AS field_diversity
        FROM chosen GROUP BY 1) JOIN mixed USING (province) ORDER BY offers DESC, province LIMIT 10""",
        "chosen AS (SELECT * FROM offers WHERE modality IN ('A', 'R'))",
        _diversity("province", "level", "chosen"),
    ),
    "top_provinces": """SELECT lower(r_name) AS province, count(*) AS offers FROM lineitem
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY 1 ORDER BY offers DESC, 1 LIMIT 3""",
    "top_provinces_view": _counts("province", 10),
    "kpis": _star("""SELECT count(*) AS offers, count(DISTINCT provider) AS providers,
        count(DISTINCT (program, field, level, modality)) AS programs,
        count(DISTINCT province) AS provinces, count(DISTINCT canton) AS cantons FROM offers"""),
    "status_counts": _counts("status"),
    "modality_counts": _counts("modality"),
    "top_providers": _counts("provider", 10),
    "coverage": _star("""SELECT province, count(*) AS offers,
        count(DISTINCT field) AS field_diversity FROM offers GROUP BY 1"""),
    "canton_drill": _star("""SELECT canton, count(*) AS offers FROM offers
        WHERE province = 'ASIA' GROUP BY 1"""),
    "top_cantons": _counts("canton", 10),
    "diversity_province": _star("SELECT * FROM mixed", _diversity("province", "field")),
    "diversity_canton": _star("SELECT * FROM mixed", _diversity("canton", "field")),
    "specialized_cantons": _star(
        "SELECT * FROM mixed ORDER BY hhi DESC, canton, entropy LIMIT 10",
        _diversity("canton", "field"),
    ),
    "diversified_cantons": _star(
        "SELECT * FROM mixed ORDER BY hhi, canton, entropy LIMIT 10",
        _diversity("canton", "field"),
    ),
    "provider_profile": _star("""SELECT provider, count(*) AS offers,
        count(DISTINCT field) AS unique_fields, count(DISTINCT level) AS unique_levels
        FROM offers GROUP BY 1 ORDER BY offers DESC, provider LIMIT 15"""),
    "region_features": _star("""SELECT lower(r_name) AS name_norm, lower(r_name) AS province_norm,
        CAST(NULL AS VARCHAR) AS canton_norm, offers, field_diversity FROM region LEFT JOIN (
        SELECT province, count(*) AS offers, count(DISTINCT field) AS field_diversity FROM offers
        GROUP BY 1) ON province = r_name"""),
    "canton_features": _star("""SELECT lower(n_name) AS name_norm, lower(r_name) AS province_norm,
        lower(n_name) AS canton_norm, offers FROM nation JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT canton, count(*) AS offers FROM offers WHERE province = 'ASIA' GROUP BY 1)
        ON canton = n_name WHERE r_name = 'ASIA'"""),
    "dataset_summary": _star(
        """SELECT *, concat_ws(chr(10), 'Dataset filtered summary',
        '- Total active offers: ' || offers, '- Unique IES: ' || providers,
        '- Programs: ' || programs, '- Provinces covered: ' || provinces,
        '- Cantons covered: ' || cantons, '- Ingestion date range: 1995-01-01 to 2001-12-31',
        '- Offer status distribution (top): ' || top_status,
        '- Modality distribution (top): ' || top_modality,
        '- Top IES by offers: ' || top_provider, '- Top provinces by offers: ' || top_province,
        '- Top cantons by offers: ' || top_canton) AS summary FROM figures""",
        f"""figures AS (SELECT count(*) AS offers, count(DISTINCT provider) AS providers,
        count(DISTINCT (program, field, level, modality)) AS programs,
        count(DISTINCT province) AS provinces, count(DISTINCT canton) AS cantons,
        {_top('status', 6)}, {_top('modality', 6)}, {_top('provider', 10)}, {_top('province', 10)},
        {_top('canton', 10)} FROM offers)""",
    ),
    "status_history": _star(
        """SELECT file_id, status, count(*) AS rows, ingested_at FROM offers
        JOIN runs USING (file_id) GROUP BY ALL""",
        _RUNS,
    ),
    "fold_documents": f"SELECT doc_id, {_FOLDED.format('text')} AS folded, "
                      f"{_FOLDED.format('source')} AS origin FROM documents",
    "fold_conversations": f"SELECT conv_id, turn, {_FOLDED.format('role')} AS role_norm, "
                          f"{_FOLDED.format('text')} AS folded FROM conversations",
    "column_names": r"""SELECT page_id, trim(regexp_replace(upper(regexp_replace(
        strip_accents(url), '[^\x00-\x7F]', '', 'g')), '[^A-Z0-9]+', '_', 'g'), '_') AS name
        FROM pages""",
    "natural_key_hash": f"""WITH {_OFFERS}, {_PLAIN} SELECT l_orderkey, l_linenumber, l_partkey,
        l_suppkey, natural_key, row_hash FROM keyed""",
    "similarity_scores": f"""WITH RECURSIVE
        pairs AS (SELECT DISTINCT lower(p_name) AS a, lower(p_type) AS b FROM part),
        {_scores('pairs', 'scored')}
        SELECT p_partkey, round(score, 6) AS score FROM part
        JOIN scored ON a = lower(p_name) AND b = lower(p_type)""",
    "territory_match": f"""WITH RECURSIVE {_OFFERS}, {_SPOILED}, {_MATCH}
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, province, canton, province_norm,
        canton_norm, round(score_province, 6) AS score_province,
        round(score_canton, 6) AS score_canton, match_method FROM matched""",
    "dedup_first": f"""WITH {_OFFERS} SELECT lower(program) AS program_norm,
        lower(field) AS field_norm, lower(level) AS level_norm, lower(modality) AS modality_norm,
        provider, status, {_ORDER} FROM base QUALIFY
        row_number() OVER (PARTITION BY program, field, level, modality ORDER BY {_ORDER}) = 1""",
    "dedup_last": f"""WITH {_OFFERS}, {_PLAIN} SELECT natural_key, row_hash, status, {_ORDER}
        FROM keyed QUALIFY row_number() OVER (PARTITION BY natural_key ORDER BY {_LAST}) = 1""",
    "dim_provider_upsert": _dim(
        "provider", "provider_norm", "provider, provider_norm, provider_type, funding_type",
        "provider_type, funding_type",
    ),
    "dim_territory_insert": _dim(
        "territory", "province_norm, canton_norm", "province, canton, province_norm, canton_norm"
    ),
    "dim_program_insert": _dim(
        "program", "program_norm, field_norm, level_norm, modality_norm",
        "program, program_norm, field_norm, level_norm, modality_norm",
    ),
    "dim_provider_backlog": f"""WITH {_OFFERS}, n AS (SELECT *, lower(provider) AS provider_norm,
        row_number() OVER (PARTITION BY provider ORDER BY run_ts, row_num) AS a,
        row_number() OVER (PARTITION BY provider ORDER BY run_ts DESC, row_num) AS z FROM base)
        SELECT sha256('=' || f.provider_norm) AS provider_id, f.provider, f.provider_norm,
        l.o_priority AS provider_type, l.modality AS funding_type, f.run_ts AS created_at,
        l.run_ts AS updated_at FROM n f JOIN n l ON f.provider = l.provider
        WHERE f.a = 1 AND l.z = 1""",
    "resolve_ids": f"""WITH {_OFFERS},
        n AS (SELECT *, '=' || {_norm('provider')} AS a, '=' || {_norm('province')} || chr(31) || '='
          || {_norm('canton')} AS b, '=' || {_norm('program')} || chr(31) || '=' || {_norm('field')}
          || chr(31) || '=' || {_norm('level')} || chr(31) || '=' || {_norm('modality')} AS c,
          max(file_id) OVER () AS newest FROM base),
        old AS (SELECT * FROM n WHERE file_id < newest)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          CASE WHEN a IN (SELECT a FROM old) THEN sha256(a) END AS provider_id,
          CASE WHEN b IN (SELECT b FROM old) THEN sha256(b) END AS territory_id,
          CASE WHEN c IN (SELECT c FROM old) THEN sha256(c) END AS program_id,
          a IN (SELECT a FROM old) AND b IN (SELECT b FROM old) AND c IN (SELECT c FROM old)
          AS resolved FROM n""",
    "scd2_versions": f"""{_SCD}, {_VERSIONS.format(where='')}
        SELECT sha256('=' || natural_key || chr(31) || '=' || first_file) AS offer_id, natural_key,
        row_hash, status_norm, {_YEAR_END.format('first_file')} AS first_seen_at,
        {_YEAR_END.format('coalesce(next, last_file)')} AS last_seen_at,
        coalesce(next, last_file) AS last_file_id, next IS NULL AS is_current FROM versions""",
    "scd2_run_counts": f"""{_SCD} SELECT file_id, count(*) AS keys,
        count(*) FILTER (before IS NULL) AS ingest_new,
        count(*) FILTER (before <> row_hash) AS ingest_updated,
        count(*) FILTER (before = row_hash) AS ingest_unchanged FROM numbered GROUP BY 1""",
    "scd2_merge": f"""{_SCD}, newest AS (SELECT max(file_id) AS f FROM base),
        {_VERSIONS.format(where='WHERE file_id < (SELECT max(file_id) FROM base)')},
        o AS (SELECT sha256('=' || natural_key || chr(31) || '=' || first_file) AS offer_id, *
          FROM versions WHERE next IS NULL),
        i AS (SELECT * FROM kept WHERE file_id = (SELECT f FROM newest))
        SELECT offer_id, o.natural_key, o.row_hash, o.status_norm,
          {_YEAR_END.format('first_file')} AS first_seen_at,
          {_YEAR_END.format('CASE WHEN i.natural_key IS NULL THEN last_file ELSE f END')}
            AS last_seen_at,
          CASE WHEN i.natural_key IS NULL THEN last_file ELSE f END AS last_file_id,
          i.natural_key IS NULL OR i.row_hash = o.row_hash AS is_current,
          CASE WHEN i.natural_key IS NULL THEN 'absent' WHEN i.row_hash = o.row_hash
            THEN 'unchanged' ELSE 'closed' END AS change
        FROM newest, o LEFT JOIN i ON i.natural_key = o.natural_key
        UNION ALL
        SELECT sha256('=' || i.natural_key || chr(31) || '=' || f), i.natural_key, i.row_hash,
          i.status_norm, {_YEAR_END.format('f')}, {_YEAR_END.format('f')}, f, true,
          CASE WHEN o.natural_key IS NULL THEN 'new' ELSE 'updated' END
        FROM newest, i LEFT JOIN o ON i.natural_key = o.natural_key
        WHERE o.natural_key IS NULL OR o.row_hash <> i.row_hash""",
    "dq_metrics": f"""{_DQ}, {_PER_KEY}
        SELECT file_id, 'invalid_territory' AS metric, count(*) FILTER (bad_place) AS value
          FROM flagged GROUP BY 1
        UNION ALL SELECT file_id, 'invalid_territory_pair', count(*) FILTER (bad_pair) FROM flagged GROUP BY 1
        UNION ALL SELECT file_id, 'missing_NOMBRE_IES', count(*) FILTER (provider IS NULL) FROM flagged
          GROUP BY 1
        UNION ALL SELECT file_id, 'missing_NOMBRE_CARRERA', count(*) FILTER (program IS NULL) FROM flagged
          GROUP BY 1
        UNION ALL {_KEY_METRICS}""",
    "dq_issues": f"""{_DQ}, {_FINDINGS.format(source='keyed')}
        SELECT * FROM findings
        UNION ALL SELECT file_id, natural_key, row_num, 'missing_territory_norm',
          '{{"provincia_original":"' || province || '","canton_original":"' || canton || '"}}'
          FROM flagged WHERE bad_place
        UNION ALL SELECT file_id, natural_key, row_num, 'invalid_territory_pair',
          '{{"provincia_norm":"' || province_norm || '","canton_norm":"' || canton_norm || '"}}'
          FROM flagged WHERE bad_pair
        UNION ALL SELECT file_id, natural_key, row_num, 'missing_nombre_ies',
          '{{"column":"NOMBRE_IES"}}' FROM flagged WHERE provider IS NULL
        UNION ALL SELECT file_id, natural_key, row_num, 'missing_nombre_carrera',
          '{{"column":"NOMBRE_CARRERA"}}' FROM flagged WHERE program IS NULL""",
    "dq_duplicates": f"""WITH {_OFFERS}, {_PLAIN} SELECT file_id, natural_key, row_num, row_hash,
        l_partkey, count(*) OVER (PARTITION BY file_id, natural_key) AS key_rows FROM keyed
        QUALIFY key_rows > 1""",
    "dq_conflicts": f"""WITH {_OFFERS}, {_PLAIN} SELECT file_id, natural_key,
        string_agg(status_norm, ',' ORDER BY r, status_norm) AS states FROM (
        SELECT file_id, natural_key, status_norm, min(row_num) AS r FROM keyed GROUP BY 1, 2, 3)
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_run_metrics": f"""WITH {_OFFERS}, {_PLAIN}, {_PER_KEY} SELECT file_id,
        '{{"conflicting_estado":' || count(*) FILTER (states > 1) || ',"duplicates_in_file":'
        || sum(CASE WHEN n > 1 THEN n ELSE 0 END) || ',"invalid_territory":0,'
        || '"invalid_territory_pair":0,"missing_NOMBRE_CARRERA":0,"missing_NOMBRE_IES":0}}'
        AS metrics FROM per_key GROUP BY 1""",
    "issue_preview": f"""WITH {_OFFERS}, {_PLAIN}, {_FINDINGS.format(source='keyed')}
        SELECT * FROM findings ORDER BY issue_type, file_id, natural_key, row_num LIMIT 200""",
    "recent_issues": f"""WITH {_ISSUES} SELECT * FROM (SELECT * FROM issues
        ORDER BY created_at DESC, issue_id LIMIT 2000) WHERE issue_type IN ('error', 'click')""",
    "issue_types": f"WITH {_ISSUES} SELECT DISTINCT issue_type FROM issues",
    "constraint_audit": _AUDIT,
    **{f"ingestion_series_{b}": _series(b) for b in ("hour", "day", "week", "month")},
    "pipeline_health": f"""WITH {_LEDGER} SELECT count(*) AS runs,
        round(avg(CASE WHEN status = 'success' THEN 1.0::DOUBLE ELSE 0 END) * 100, 6)
          AS success_rate,
        round(avg(duration_seconds), 6) AS avg_duration,
        round(avg(CASE WHEN duration_seconds > 0 THEN rows_loaded / duration_seconds END), 6)
          AS avg_rows_per_second FROM ledger""",
    "run_states": f"WITH {_LEDGER} SELECT status, count(*) AS runs FROM ledger GROUP BY 1",
    "file_sizes": f"""WITH {_LEDGER} SELECT file_id, ingested_at,
        round(file_size_bytes / 1048576.0::DOUBLE, 6) AS file_size_mb, duration_seconds
        FROM ledger""",
    "latest_run": f"""WITH {_LEDGER} SELECT * FROM ledger ORDER BY ingested_at DESC, file_id DESC
        LIMIT 1""",
    "latest_run_steps": """SELECT CAST(user_id AS VARCHAR) AS file_id, event_id AS step_id,
        event_type AS step_name, ts AS started_at, value AS duration_seconds FROM events
        WHERE user_id = (SELECT user_id FROM events ORDER BY ts DESC,
        CAST(user_id AS VARCHAR) DESC LIMIT 1)""",
    "last_step_per_file": """SELECT CAST(user_id AS VARCHAR) AS file_id, event_id AS step_id,
        event_type AS step_name, ts AS started_at, value AS duration_seconds FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "step_avg": """SELECT event_type AS step_name, round(avg(value), 6) AS avg_seconds FROM events
        GROUP BY 1""",
    "step_durations": """SELECT event_id AS step_id, CAST(user_id AS VARCHAR) AS file_id,
        round((epoch_us(max(ts) OVER (PARTITION BY user_id)) - epoch_us(ts)) / 1e6::DOUBLE, 6)
        AS seconds FROM events""",
    "service_latest": f"""WITH {_CHECKS} SELECT * FROM checks QUALIFY row_number() OVER
        (PARTITION BY service_name ORDER BY created_at DESC, check_id DESC) = 1""",
    "service_counts": f"""WITH {_CHECKS} SELECT service_name, status, count(*) AS checks
        FROM checks GROUP BY 1, 2""",
    "recent_checks": f"""WITH {_CHECKS} SELECT * FROM checks ORDER BY created_at DESC, check_id
        LIMIT 500""",
    "timeline_long": f"WITH {_LEDGER} " + " UNION ALL ".join(
        f"""SELECT file_id, ingested_at, '{m}' AS metric, value FROM (SELECT file_id, ingested_at,
        coalesce(CAST({m} AS DOUBLE), CASE WHEN event_type <> 'view'
        THEN CAST((event_id * {i + 2}) % 101 AS DOUBLE) END) AS value
        FROM ledger JOIN events ON file_id = CAST(event_id AS VARCHAR)) WHERE value IS NOT NULL"""
        for i, m in enumerate(_METRICS)
    ),
    "metric_series": """SELECT CAST(event_id AS VARCHAR) AS file_id, ts AS created_at,
        'invalid_territory' AS metric, CAST(event_id % 17 AS DOUBLE) AS value FROM events
        WHERE event_type <> 'view'
        UNION ALL SELECT CAST(event_id AS VARCHAR), ts, 'duplicates_in_file',
        CAST(event_id % 19 AS DOUBLE) FROM events WHERE event_type <> 'view'""",
    "metric_columns": """SELECT CAST(event_id AS VARCHAR) AS file_id, ts AS created_at,
        CASE WHEN event_type <> 'view' THEN CAST(event_id % 17 AS DOUBLE) END AS invalid_territory,
        CASE WHEN event_type <> 'view' THEN CAST(event_id % 19 AS DOUBLE) END AS duplicates_in_file,
        CAST(NULL AS DOUBLE) AS absent FROM events""",
    "props_map": """SELECT event_id, 'k' AS metric,
        CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events""",
    "coerced_casts": """SELECT c_custkey, TRY_CAST(c_name AS DOUBLE) AS name_number,
        TRY_CAST(split_part(c_name, '#', 2) AS DOUBLE) AS number,
        TRY_CAST('2024-01-' || substr(split_part(c_name, '#', 2), 8, 2) AS TIMESTAMP) AS day
        FROM customer""",
    "artifact_rows": """SELECT CAST(page_id AS VARCHAR) AS file_id, 'source_file' AS artifact,
        'sources/' || page_id || '/' || split_part(url, '/', -1) AS path,
        'https://files.example.org/storage/v1/object/public/artifacts/sources/' || page_id || '/'
        || split_part(url, '/', -1) AS url FROM pages
        UNION ALL SELECT CAST(page_id AS VARCHAR), 'report',
        'reports/' || page_id || '/data_quality.json',
        'https://files.example.org/storage/v1/object/public/artifacts/reports/' || page_id
        || '/data_quality.json' FROM pages""",
    "load_profile": f"""WITH {_OFFERS}, {_PLAIN} SELECT file_id, count(*) AS rows,
        count(DISTINCT natural_key) AS natural_keys, count(DISTINCT provider) AS providers,
        count(DISTINCT (province, canton)) AS territories,
        count(DISTINCT (program, field, level, modality)) AS programs FROM keyed GROUP BY 1""",
    "ledger_state": """SELECT CAST(user_id AS VARCHAR) AS file_id,
        arg_max(event_type, (ts, event_id)) AS status,
        arg_max('note ' || event_id, (ts, event_id)) FILTER (event_type = 'error') AS notes,
        arg_max(event_id % 100, (ts, event_id)) FILTER (event_type = 'click') AS rows_loaded,
        arg_max(value, (ts, event_id)) FILTER (event_type = 'purchase') AS duration_seconds
        FROM events GROUP BY 1""",
    "pending_documents": """SELECT doc_id, sha256(text) AS checksum FROM documents
        WHERE sha256(text) NOT IN (SELECT sha256(d.text) FROM documents d JOIN labels l
        ON d.doc_id = l.doc_id WHERE quality = 1)""",
    "loaded_documents": """WITH done AS (SELECT sha256(text) AS checksum,
        min(CAST(d.doc_id AS VARCHAR)) AS file_id FROM documents d JOIN labels l
        ON d.doc_id = l.doc_id WHERE quality = 1 GROUP BY 1)
        SELECT doc_id, checksum, file_id FROM documents JOIN done ON sha256(text) = checksum""",
    "header_discovery": f"""WITH {_OFFERS} SELECT row_num, provider AS "NOMBRE_IES",
        provider_type AS "TIPO_IES", funding_type AS "TIPO_FINANCIAMIENTO",
        program AS "NOMBRE_CARRERA", field AS "CAMPO_AMPLIO", level AS "NIVEL_FORMACION",
        modality AS "MODALIDAD", province AS "PROVINCIA", canton AS "CANTON", status AS "ESTADO"
        FROM base""",
    "read_offers_csv": f"""WITH {_OFFERS} SELECT row_number() OVER (ORDER BY row_num)
        + count(*) FILTER (row_num % 7 = 0) OVER (
            ORDER BY row_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS row_num,
        provider || ' "of", ' || modality AS provider, provider_type, funding_type,
        program || chr(10) || status AS program, field, level, modality, province, canton, status
        FROM base""",
    "dimension_counts": f"""WITH RECURSIVE {_OFFERS}, {_SPOILED}, {_MATCH} SELECT file_id,
        count(DISTINCT coalesce(provider, '')) AS providers,
        count(DISTINCT (province_norm, canton_norm)) AS territories,
        count(DISTINCT (program, field, level, modality)) AS programs FROM matched GROUP BY 1""",
    "dq_report": f"""WITH {_OFFERS}, {_PLAIN}, {_PER_KEY} SELECT
        '{{"file_id":"' || file_id || '","file_path":"offers","run_id":"' || file_id
        || '","generated_at":"2003-01-01T00:00:00.000000Z","metrics":{{"conflicting_estado":'
        || count(*) FILTER (states > 1) || ',"duplicates_in_file":'
        || sum(CASE WHEN n > 1 THEN n ELSE 0 END) || ',"invalid_territory":0,'
        || '"invalid_territory_pair":0,"missing_NOMBRE_CARRERA":0,"missing_NOMBRE_IES":0}}}}'
        AS value FROM per_key GROUP BY file_id""",
    "dq_metric_table": f"""WITH {_OFFERS}, {_PLAIN}, {_PER_KEY}
        SELECT metric, CAST(sum(value) AS BIGINT) AS value FROM ({_KEY_METRICS}
        UNION ALL SELECT DISTINCT file_id, unnest(['invalid_territory', 'invalid_territory_pair',
        'missing_NOMBRE_IES', 'missing_NOMBRE_CARRERA']), 0 FROM per_key) GROUP BY 1""",
    "recent_steps": """SELECT CAST(user_id AS VARCHAR) AS file_id, event_id AS step_id,
        event_type AS step_name, ts AS started_at, value AS duration_seconds FROM events
        ORDER BY ts DESC, event_id LIMIT 2000""",
    "warehouse_versions": f"""{_HOUSE} SELECT natural_key, row_hash, status,
        opened AS first_seen_at, coalesce(next, touched) AS last_seen_at, next IS NULL AS is_current
        FROM versions""",
    "warehouse_runs": f"""{_HOUSE} SELECT stamp AS ingested_at, 'success' AS status,
        'new=' || ingest_new || ', updated=' || ingest_updated || ', unchanged='
        || ingest_unchanged || ', skipped_missing_dims=' || skipped_missing_dims AS notes,
        {', '.join(_HOUSE_METRICS)} FROM runs""",
    "warehouse_storage_states": """SELECT 'success' AS storage_status,
        count(DISTINCT year(o_orderdate)) AS runs FROM orders""",
    "warehouse_quality": f"""{_HOUSE} """ + " UNION ALL ".join(
        [f"SELECT stamp AS created_at, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM runs"
         for m in _HOUSE_METRICS]
        + [f"SELECT stamp, '{m}', CAST(count(*) FILTER ({test}) AS DOUBLE) FROM flagged "
           "JOIN loads USING (file_id) GROUP BY 1"
           for m, test in (
               ("invalid_territory", "bad_place"), ("invalid_territory_pair", "false"),
               ("missing_NOMBRE_IES", "provider IS NULL"),
               ("missing_NOMBRE_CARRERA", "program IS NULL"))]
        + [f"SELECT stamp, metric, CAST(value AS DOUBLE) FROM ({_KEY_METRICS}) "
           "JOIN loads USING (file_id)"]
    ),
    "warehouse_issues": f"""{_HOUSE} SELECT stamp AS created_at, issue_type, issues FROM (
        SELECT file_id, 'duplicate_natural_key' AS issue_type, CAST(sum(n) AS BIGINT) AS issues
          FROM per_key WHERE n > 1 GROUP BY 1
        UNION ALL SELECT file_id, 'conflicting_estado', count(*) FROM per_key WHERE states > 1
          GROUP BY 1
        UNION ALL SELECT file_id, 'missing_territory_norm', count(*) FROM flagged WHERE bad_place
          GROUP BY 1
        UNION ALL SELECT file_id, 'missing_nombre_ies', count(*) FROM flagged
          WHERE provider IS NULL GROUP BY 1
        UNION ALL SELECT file_id, 'missing_nombre_carrera', count(*) FROM flagged
          WHERE program IS NULL GROUP BY 1) JOIN loads USING (file_id)""",
    "warehouse_star": f"""{_HOUSE} SELECT lower(status) AS status, touched AS last_seen_at,
        touched AS ingested_at, provider, provider_type, funding_type, province, canton, program,
        field, level, modality FROM (SELECT natural_key, status, touched FROM versions
        WHERE next IS NULL) JOIN (SELECT natural_key, {_norm('any_value(provider)')} AS provider,
        {_norm('any_value(program)')} AS program, {_norm('any_value(field)')} AS field,
        {_norm('any_value(level)')} AS level, {_norm('any_value(modality)')} AS modality,
        any_value(province_norm) AS province, any_value(canton_norm) AS canton FROM lasts GROUP BY 1)
        USING (natural_key) JOIN (SELECT {_norm('provider')} AS provider,
        arg_max(provider_type, (file_id, -row_num)) AS provider_type,
        arg_max(funding_type, (file_id, -row_num)) AS funding_type FROM flagged GROUP BY 1) p
        USING (provider)
        UNION ALL SELECT lower(status), touched, touched, NULL, t.provider_type, t.funding_type,
        province, canton, program, field, level, modality
        FROM (SELECT natural_key, status, touched FROM versions WHERE next IS NULL)
        JOIN (SELECT natural_key, any_value(provider) AS provider,
        {_norm('any_value(program)')} AS program, {_norm('any_value(field)')} AS field,
        {_norm('any_value(level)')} AS level, {_norm('any_value(modality)')} AS modality,
        any_value(province_norm) AS province, any_value(canton_norm) AS canton FROM lasts
        WHERE provider IS NULL GROUP BY 1) USING (natural_key),
        (SELECT arg_max(provider_type, (file_id, -row_num)) AS provider_type,
        arg_max(funding_type, (file_id, -row_num)) AS funding_type FROM flagged
        WHERE provider IS NULL) t""",
    "warehouse_constraints": """SELECT unnest(['files', 'provider', 'territory', 'program', 'offer',
        'files', 'health', 'files', 'files', 'health', 'step', 'staging', 'offer', 'offer', 'offer',
        'offer', 'run', 'issue', 'step']) AS table_name, unnest(['unique(checksum)',
        'unique(provider_norm)', 'unique(province_norm,canton_norm)',
        'unique(program_norm,field_norm,level_norm,modality_norm)', 'unique(natural_key)',
        'domain(status)', 'domain(status)', 'not_null(file_name)', 'not_null(checksum)',
        'not_null(service_name)', 'not_null(step_name)', 'reference(file_id->files.file_id)',
        'reference(provider_id->provider.provider_id)',
        'reference(territory_id->territory.territory_id)',
        'reference(program_id->program.program_id)', 'reference(last_file_id->files.file_id)',
        'reference(file_id->files.file_id)', 'reference(run_id->run.run_id)',
        'reference(file_id->files.file_id)']) AS rule, CAST(0 AS BIGINT) AS violations""",
    "published_top_provinces": f"""{_HOUSE} SELECT split_part(natural_key, '|', 6)
        AS provincia_norm, count(*) AS offers FROM versions WHERE next IS NULL GROUP BY 1
        ORDER BY offers DESC, 1 LIMIT 3""",
    "published_series": f"""{_HOUSE} SELECT count(*) AS files, """ + ", ".join(
        f"CAST(sum({m}) AS BIGINT) AS {m}" for m in _HOUSE_METRICS
    ) + " FROM runs",
    "surrogate_ids": """SELECT o_orderkey, sha256('=' || o_orderkey || chr(31) ||
        CASE WHEN o_orderstatus <> 'F' THEN '=' || o_orderstatus ELSE '~' END) AS id FROM orders""",
    "arrivals_ledger": """SELECT 'success' AS status, 1 AS files, count(*) AS rows_loaded
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)
        UNION ALL SELECT 'failed', 2, 0""",
    "service_states": f"""WITH {_CHECKS}, latest AS (SELECT * FROM checks QUALIFY row_number() OVER
        (PARTITION BY service_name ORDER BY created_at DESC, status_code DESC, latency_ms DESC) = 1),
        counts AS (SELECT service_name, count(*) AS checks, count(*) FILTER (status = 'up') AS n_up,
        count(*) FILTER (status = 'down') AS n_down FROM checks GROUP BY 1)
        SELECT CAST(service_name AS VARCHAR) AS service_name, checks, n_up, n_down, created_at,
        status, status_code, latency_ms FROM counts JOIN latest USING (service_name)""",
}
