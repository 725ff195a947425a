"""Names and value sets of the published data contract, and the warehouse schemas.

Inside the package the neutral names on the right are used; the names on the left are how
source files and published views call the same things.
"""

from __future__ import annotations

# The columns every source file must carry.
SOURCE_COLUMNS = {
    "NOMBRE_IES": "provider",
    "TIPO_IES": "provider_type",
    "TIPO_FINANCIAMIENTO": "funding_type",
    "NOMBRE_CARRERA": "program",
    "CAMPO_AMPLIO": "field",
    "NIVEL_FORMACION": "level",
    "MODALIDAD": "modality",
    "PROVINCIA": "province",
    "CANTON": "canton",
    "ESTADO": "status",
}
REQUIRED = tuple(SOURCE_COLUMNS)

# Fixed value: what the error says when different columns get one name.
DUPLICATE_COLUMNS = "Duplicate columns after normalization"

# Cell texts that source files use for a missing value.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Accepted run and service states.
RUN_STATES = ("success", "failed", "skipped", "running")
SERVICE_STATES = ("up", "down")

# Least similarity of an accepted territory match, rows scanned for a header,
# and the row limits of the monitoring reports.
MATCH_THRESHOLD = 85
HEADER_SCAN = 50
RECENT_ISSUES = 2000
RECENT_STEPS = 2000
RECENT_CHECKS = 500
ISSUE_PREVIEW = 200

# Metric names of the quality report, in report order.
LOAD_METRICS = (
    "rows_loaded",
    "ingest_new",
    "ingest_updated",
    "ingest_unchanged",
    "skipped_missing_dims",
)
QUALITY_METRICS = (
    "duplicates_in_file",
    "invalid_territory",
    "invalid_territory_pair",
    "conflicting_estado",
    "missing_NOMBRE_IES",
    "missing_NOMBRE_CARRERA",
)

NATURAL_KEY = (
    "provider_norm",
    "program_norm",
    "field_norm",
    "level_norm",
    "modality_norm",
    "province_norm",
    "canton_norm",
)
PROVIDER_KEY = ("provider_norm",)
TERRITORY_KEY = ("province_norm", "canton_norm")
PROGRAM_KEY = ("program_norm", "field_norm", "level_norm", "modality_norm")


_TEXT = {name: "string" for name in SOURCE_COLUMNS.values()}
_NORM = {
    "provider_norm": "string",
    "program_norm": "string",
    "status_norm": "string",
    "field_norm": "string",
    "level_norm": "string",
    "modality_norm": "string",
    "province_norm": "string",
    "canton_norm": "string",
    "score_province": "double",
    "score_canton": "double",
    "match_method": "string",
}

TABLES: dict[str, dict[str, str]] = {
    "raw/ledger": dict(
        file_id="string", event_seq="int", event_at="timestamp", file_name="string",
        checksum="string", rows_loaded="bigint", ingested_at="timestamp", status="string",
        notes="string", started_at="timestamp", finished_at="timestamp",
        duration_seconds="double", file_size_bytes="bigint", ingest_new="bigint",
        ingest_updated="bigint", ingest_unchanged="bigint", skipped_missing_dims="bigint",
        storage_status="string", storage_paths="string", process_metrics="string",
    ),
    "raw/staging": dict(
        row_num="bigint", ingested_at="timestamp", **_TEXT, **_NORM,
        normalized_fields="string", natural_key="string", row_hash="string", file_id="string",
    ),
    "core/provider": dict(
        provider_id="string", provider="string", provider_norm="string", provider_type="string",
        funding_type="string", created_at="timestamp", updated_at="timestamp",
        file_id="string",
    ),
    "core/territory": dict(
        territory_id="string", province="string", canton="string", province_norm="string",
        canton_norm="string", created_at="timestamp", updated_at="timestamp", file_id="string",
    ),
    "core/program": dict(
        program_id="string", program="string", program_norm="string", field_norm="string",
        level_norm="string", modality_norm="string", created_at="timestamp",
        updated_at="timestamp", file_id="string",
    ),
    "core/offer": dict(
        offer_id="string", provider_id="string", territory_id="string", program_id="string",
        status="string", status_norm="string", natural_key="string", row_hash="string",
        first_seen_at="timestamp", last_seen_at="timestamp", last_file_id="string",
        file_id="string", is_current="boolean",
    ),
    "audit/run": dict(
        run_id="string", created_at="timestamp", metrics="string", file_id="string"
    ),
    "audit/issue": dict(
        issue_id="string", run_id="string", created_at="timestamp", issue_type="string",
        natural_key="string", detail="string", file_id="string",
    ),
    "ops/step": dict(
        step_id="string", step_name="string", started_at="timestamp", finished_at="timestamp",
        duration_seconds="double", row_count="bigint", detail="string", file_id="string",
    ),
    "ops/health": dict(
        check_id="string", created_at="timestamp", service_name="string", endpoint="string",
        status="string", status_code="int", latency_ms="double", detail="string",
    ),
}

# Tables split into folders, one per run (and per version state for the fact).
PARTITIONS: dict[str, tuple[str, ...]] = {
    name: tuple(c for c in ("file_id", "is_current") if c in columns)
    for name, columns in TABLES.items()
    if name not in ("raw/ledger", "ops/health")
}


def ddl(table: str) -> str:
    """Schema of a warehouse table as a DDL string."""
    return ", ".join(f"{name} {kind}" for name, kind in TABLES[table].items())
