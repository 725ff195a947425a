"""The registered queries: every operator over the star-schema test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import (
    LOAD_METRICS, NATURAL_KEY, PROGRAM_KEY, PROVIDER_KEY, RECENT_CHECKS, RECENT_ISSUES,
    REQUIRED, RUN_STATES, SOURCE_COLUMNS, ddl,
)
from ..functions import structured
from ..functions.keys import surrogate_id
from ..functions.similarity import indel_ratio
from ..functions.temporal import in_day_range, seconds_between
from ..functions.text import column_name_expr, fold_text, normalize_value
from ..operators import (
    constraints, dedup, dimensions, diversity, filters, history, ledger, marts, monitoring,
    quality, reshape, summary, territory,
)
from ..operators.skew import lookup_join
from ..session import checkpointed, scratch_dir, scratch_scope, spread, stored
from ..sinks import reports
from ..sinks.tables import append_health
from ..sources import files, geojson, offers, sample
from ..sources.tables import read_view
from ..streaming import arrivals, health
from .ingest import load_files
from .warehouse import Warehouse, publish_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The filter the filtered queries use, and the province of the canton views.
CHOSEN = filters.Filters(
    {
        "province": ["ASIA", "EUROPE"],
        "modality": ["A", "R"],
        "status": ["F", "O"],
        "provider_type": ["TYPE A"],
    },
    (dt.date(1996, 1, 1), dt.date(1999, 12, 31)),
)
PROVINCE = "ASIA"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _round(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# Star, filters, facets -----------------------------------------------------------------------


@query
def star_offers(spark, sf):
    """Offers with their dimensions and the arrival time of their run."""
    return sample.timed_star(spark, sf)


@query
def filter_facets(spark, sf):
    """Offers that pass a multi-facet filter and a day range."""
    return filters.apply_filters(sample.timed_star(spark, sf), CHOSEN)


@query
def facet_options(spark, sf):
    """Facet values, with cantons limited to the chosen provinces."""
    rows = sample.star_rows(spark, sf)
    return filters.facet_options(rows, provinces=CHOSEN.facets["province"])


@query
def date_extent(spark, sf):
    return filters.date_extent(sample.table(spark, sf, "events"), "ts")


@query
def date_window(spark, sf):
    """Events of a range of days, the last day included."""
    days = (dt.date(2024, 1, 5), dt.date(2024, 1, 20))
    return sample.table(spark, sf, "events").where(in_day_range(F.col("ts"), *days))


# Marts ---------------------------------------------------------------------------------------


@query
def flagship(spark, sf):
    """Filtered provinces by offers, with field coverage, concentration and entropy."""
    rows = filters.apply_filters(
        sample.star_rows(spark, sf), filters.Filters({"modality": ["A", "R"]})
    )
    covered = marts.coverage(rows)
    mixed = diversity.diversity(rows, "province", "level")
    return _round(marts.top(covered.join(mixed, "province"), "offers", 10), "hhi", "entropy")


@query
def top_provinces(spark, sf):
    """The three provinces with most offers, counted per territory before the join."""
    lines = sample.table(spark, sf, "lineitem")
    supplier = sample.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    places = sample.territories(spark, sf)
    fact = lines.groupBy("l_suppkey").agg(F.count("*").alias("n")).join(
        supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    return marts.top(
        marts.offers_per_province(
            fact.select(F.col("s_nationkey").alias("territory_id"), "n"), places, weight="n"
        ),
        "offers", 3,
    )


@query
def top_provinces_view(spark, sf):
    """The provinces view read with a column choice, an order and a limit."""
    view = marts.value_counts(sample.star_rows(spark, sf), "province")
    view.createOrReplaceTempView("tideline_top_provinces")
    return read_view(
        spark, "tideline_top_provinces", ["province", "offers"], ["offers.desc", "province"], 10
    )


@query
def kpis(spark, sf):
    return marts.kpis(sample.star_rows(spark, sf))


@query
def status_counts(spark, sf):
    return marts.value_counts(sample.star_rows(spark, sf), "status")


@query
def modality_counts(spark, sf):
    return marts.value_counts(sample.star_rows(spark, sf), "modality")


@query
def top_providers(spark, sf):
    return marts.value_counts(sample.star_rows(spark, sf), "provider", 10)


@query
def coverage(spark, sf):
    return marts.coverage(sample.star_rows(spark, sf))


@query
def canton_drill(spark, sf):
    return marts.canton_drill(sample.star_rows(spark, sf), PROVINCE)


@query
def top_cantons(spark, sf):
    return marts.value_counts(sample.star_rows(spark, sf), "canton", 10)


@query
def diversity_province(spark, sf):
    rows = sample.star_rows(spark, sf)
    return _round(diversity.diversity(rows, "province", "field"), "hhi", "entropy")


@query
def diversity_canton(spark, sf):
    rows = sample.star_rows(spark, sf)
    return _round(diversity.diversity(rows, "canton", "field"), "hhi", "entropy")


@query
def specialized_cantons(spark, sf):
    return marts.top(diversity_canton(spark, sf), "hhi", 10)


@query
def diversified_cantons(spark, sf):
    return marts.top(diversity_canton(spark, sf), "hhi", 10, ascending=True)


@query
def provider_profile(spark, sf):
    return marts.provider_profile(sample.star_rows(spark, sf))


@query
def region_features(spark, sf):
    """Offers and field coverage attached to the map features of their province."""
    region = sample.table(spark, sf, "region").select(
        F.to_json(
            F.struct(
                F.array(
                    F.struct(
                        F.lit("Feature").alias("type"),
                        F.struct(F.concat(F.lit(" "), "r_name").alias("NAME_1")).alias(
                            "properties"
                        ),
                    )
                ).alias("features")
            )
        ).alias("value")
    )
    places = geojson.features(region, geojson.PROVINCE)
    counts = marts.coverage(sample.star_rows(spark, sf))
    folded = counts.withColumn("province", fold_text(F.col("province")))
    return marts.region_values(places, folded, "province").select(
        "name_norm", "province_norm", "canton_norm", "offers", "field_diversity"
    )


@query
def canton_features(spark, sf):
    """The canton map of one province, with offers."""
    nation = sample.territories(spark, sf).select(
        F.concat(
            F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","properties":'),
            structured.json_document(NAME_1=F.col("province"), NAME_2=F.col("canton")),
            F.lit(',"geometry":null}]}'),
        ).alias("value")
    )
    places = geojson.of_province(
        geojson.features(nation, geojson.CANTON), PROVINCE.lower()
    )
    counts = canton_drill(spark, sf).withColumn("canton", fold_text(F.col("canton")))
    return marts.region_values(places, counts, "canton").select(
        "name_norm", "province_norm", "canton_norm", "offers"
    )


@query
def dataset_summary(spark, sf):
    return summary.dataset_summary(sample.star_rows(spark, sf), "1995-01-01", "2001-12-31")


@query
def status_history(spark, sf):
    rows = sample.star_rows(spark, sf)
    return marts.status_history(rows, sample.runs(spark, sf))


# Text, keys, similarity ----------------------------------------------------------------------


@query
def fold_documents(spark, sf):
    """Accent-folded and normalised text of every document, whole."""
    text = F.col("text")
    return spread(sample.table(spark, sf, "documents"), "doc_id").select(
        "doc_id", fold_text(text).alias("folded"), normalize_value(F.col("source")).alias("origin")
    )


@query
def fold_conversations(spark, sf):
    return spread(sample.table(spark, sf, "conversations"), "conv_id", "turn").select(
        "conv_id", "turn", normalize_value(F.col("role")).alias("role_norm"),
        normalize_value(F.col("text")).alias("folded"),
    )


@query
def column_names(spark, sf):
    """Canonical column names made of the cells of a column."""
    return sample.table(spark, sf, "pages").select(
        "page_id", column_name_expr(F.col("url")).alias("name")
    )


@query
def natural_key_hash(spark, sf):
    return sample.keyed(sample.offers(spark, sf)).select(
        *sample.ORDER[:4], "natural_key", "row_hash"
    )


@query
def similarity_scores(spark, sf):
    """Similarity of each part's name to its type."""
    name, kind = F.lower("p_name"), F.lower("p_type")
    return sample.table(spark, sf, "part").select(
        "p_partkey", F.round(indel_ratio(name, kind), 6).alias("score")
    )


def _spoiled(spark, sf) -> DataFrame:
    """Offers with carelessly written provinces, unknown cantons and some missing names."""
    rows = sample.offers(spark, sf)
    return rows.withColumns(
        {
            "province": sample.spoiled_province(F.col("province"), F.col("l_suppkey")),
            "canton": F.when(F.col("l_suppkey") % 11 == 7, F.lit("elsewhere")).otherwise(
                F.col("canton")
            ),
            "provider": F.when(F.col("l_partkey") % 97 != 5, F.col("provider")),
            "provider_norm": F.when(F.col("l_partkey") % 97 != 5, F.col("provider_norm")),
            "program": F.when(F.col("l_partkey") % 89 != 4, F.col("program")),
            "program_norm": F.when(F.col("l_partkey") % 89 != 4, F.col("program_norm")),
        }
    ).drop("province_norm", "canton_norm")


@query
def territory_match(spark, sf):
    """Exact, fuzzy and failed territory matches of spoiled names."""
    offers = stored(_spoiled(spark, sf).select(*sample.ORDER[:4], "province", "canton"))
    matched = territory.match_territory(offers, sample.catalog(spark, sf))
    return _round(
        matched.select(
            *sample.ORDER[:4], "province", "canton", "province_norm", "canton_norm",
            "score_province", "score_canton", "match_method",
        ),
        "score_province", "score_canton",
    )


# Dedup, dimensions, history ------------------------------------------------------------------


@query
def dedup_first(spark, sf):
    """The first offer of every program, by the total row order."""
    rows = sample.offers(spark, sf).select(*PROGRAM_KEY, "provider", "status", *sample.ORDER)
    return dedup.keep_first(rows, PROGRAM_KEY, sample.ORDER)


@query
def dedup_last(spark, sf):
    """The last offer of every natural key."""
    rows = sample.with_key(sample.offers(spark, sf)).select(
        "natural_key", "status", "status_norm", *sample.ORDER
    )
    # The hash is made of what the rows carry; only the ones that stay need it.
    kept = sample.with_hash(dedup.keep_last(rows, ["natural_key"], sample.ORDER))
    return kept.select("natural_key", "row_hash", "status", *sample.ORDER)


def _newest(spark, sf) -> str:
    """The newest run (one value)."""
    year = F.year("o_orderdate").cast("string")
    return sample.table(spark, sf, "orders").agg(F.max(year)).first()[0]


def _staged(spark, sf) -> DataFrame:
    """Offers as staging holds them; type and funding differ between runs."""
    rows = sample.offers(spark, sf).select(
        *sample.ORDER[:4], "row_num", "file_id", "provider", "program", "province", "canton",
        *NATURAL_KEY, F.col("o_priority").alias("provider_type"),
        F.col("modality").alias("funding_type"),
    )
    return stored(rows)


def _empty(spark, table: str) -> DataFrame:
    return spark.createDataFrame([], ddl(table)).drop("file_id")


# Load times of the earlier runs and of the newest, as text read in the session's time zone.
BEFORE, NOW = "2002-01-01", "2003-01-01"


def _loaded(rows: DataFrame, when: str) -> DataFrame:
    """Rows as one file that was loaded at a given time."""
    return rows.withColumn("run_ts", F.lit(when).cast("timestamp"))


def _dimension(spark, sf, build, table) -> DataFrame:
    """A dimension after the earlier runs, then after the newest."""
    rows, newest = _staged(spark, sf), _newest(spark, sf)
    old = build(_empty(spark, table), _loaded(rows.where(F.col("file_id") < newest), BEFORE))
    return build(old, _loaded(rows.where(F.col("file_id") == newest), NOW))


@query
def dim_provider_upsert(spark, sf):
    made = _dimension(spark, sf, dimensions.providers, "core/provider")
    return _naive(made, "created_at", "updated_at")


@query
def dim_territory_insert(spark, sf):
    made = _dimension(spark, sf, dimensions.territories, "core/territory")
    return _naive(made, "created_at", "updated_at")


@query
def dim_program_insert(spark, sf):
    made = _dimension(spark, sf, dimensions.programs, "core/program")
    return _naive(made, "created_at", "updated_at")


@query
def dim_provider_backlog(spark, sf):
    """Providers after all runs in one go: first names, and the latest type and funding."""
    rows = sample.offers(spark, sf).select(
        # Numbers that increase with the run, then with the order of the rows.
        ((F.year("run_ts") - 1990) * F.lit(1 << 55) + F.col("row_num")).alias("row_num"),
        F.col("run_ts").cast("timestamp").alias("run_ts"), "provider", "provider_norm",
        F.col("o_priority").alias("provider_type"), F.col("modality").alias("funding_type"),
    )
    made = dimensions.providers(_empty(spark, "core/provider"), stored(rows))
    return _naive(made, "created_at", "updated_at")


@query
def resolve_ids(spark, sf):
    """Surrogate keys of all offers against dimensions that know the earlier runs only."""
    rows, newest = _staged(spark, sf), _newest(spark, sf)
    known = rows.where(F.col("file_id") < newest)
    dims = [
        build(_empty(spark, table), _loaded(known, BEFORE))
        for build, table in (
            (dimensions.providers, "core/provider"),
            (dimensions.territories, "core/territory"),
            (dimensions.programs, "core/program"),
        )
    ]
    found = dimensions.resolve_ids(rows, *dims)
    return found.select(
        *sample.ORDER[:4], "provider_id", "territory_id", "program_id",
        dimensions.resolved().alias("resolved"),
    )


PAYLOAD = ("status_norm",)


def _versioned(spark, sf) -> DataFrame:
    """Offers to be versioned. The row hashes of a key differ where its statuses do, so the
    status stands for the hash until ``_hashed`` makes it, once per version."""
    return sample.with_key(sample.offers(spark, sf)).select(
        "natural_key", F.coalesce("status_norm", F.lit("")).alias("row_hash"), *PAYLOAD,
        "file_id", "run_ts", "row_num",
    )


def _hashed(versions: DataFrame) -> DataFrame:
    # A version of a run without a time has no hash.
    dated = F.when(F.col("_status").isNotNull(), F.col("row_hash"))
    made = sample.with_hash(versions.withColumn("_status", F.col("row_hash")))
    return made.withColumn("row_hash", dated).select(*versions.columns)


@query
def scd2_versions(spark, sf):
    """All versions after loading every run, oldest first, in one job."""
    return _hashed(history.replay(_versioned(spark, sf), PAYLOAD, ["row_num"]))


@query
def scd2_run_counts(spark, sf):
    return history.run_counts(_versioned(spark, sf), ["row_num"])


@query
def scd2_merge(spark, sf):
    """The newest run merged into the state the earlier ones left."""
    rows, newest = _versioned(spark, sf), _newest(spark, sf)
    state = history.replay(rows.where(F.col("file_id") < newest), PAYLOAD, ["row_num"])
    incoming = dedup.keep_last(
        rows.where(F.col("file_id") == newest), ["natural_key"], ["row_num"]
    )
    # The replay leaves its versions dealt out by natural key.
    return history.merge(
        _hashed(state.where("is_current")), _hashed(incoming), PAYLOAD, F.lit(newest),
        F.lit(f"{newest}-12-31").cast("timestamp_ntz"), bucketed=True,
    )


# Quality -------------------------------------------------------------------------------------


def _checked(spark, sf, *extra: str) -> DataFrame:
    # The offers are joined once: their names are matched, then all rows are read again.
    names = ["file_id", "row_num", "provider", "program", "province", "canton", "status_norm"]
    names += [c for c in (*NATURAL_KEY, *extra) if c not in ("province_norm", "canton_norm")]
    offers = stored(_spoiled(spark, sf).select(*dict.fromkeys(names)))
    matched = territory.match_territory(offers, sample.catalog(spark, sf))
    # Several rules read these rows.
    return stored(
        sample.keyed(matched).select(
            "file_id", "natural_key", "row_num", "row_hash", "status_norm", "provider", "program",
            "province", "canton", "province_norm", "canton_norm", *extra,
        )
    )


def _official(spark, sf) -> DataFrame:
    """Territories that have a provider of mixed funding, as the list of valid pairs."""
    supplier = sample.suppliers(spark, sf).where("funding_type = 'MIXED'")
    return sample.territories(spark, sf).join(
        supplier, F.col("s_nationkey") == F.col("territory_id"), "left_semi"
    )


@query
def dq_metrics(spark, sf):
    """Quality metrics of every run."""
    return quality.metrics(_checked(spark, sf), _official(spark, sf))


@query
def dq_issues(spark, sf):
    """All findings of every run, with their JSON detail."""
    return quality.issues(_checked(spark, sf), _official(spark, sf))


@query
def dq_duplicates(spark, sf):
    rows = sample.keyed(sample.offers(spark, sf)).select(
        "file_id", "natural_key", "row_num", "row_hash", "l_partkey"
    )
    return quality.duplicate_rows(rows)


@query
def dq_conflicts(spark, sf):
    """Keys with several statuses in a run; the statuses as text, in order of appearance."""
    found = quality.conflicting_status(sample.keyed(sample.offers(spark, sf)))
    return found.withColumn("states", F.array_join("states", ","))


@query
def dq_run_metrics(spark, sf):
    """The metric document of each run."""
    rows = sample.keyed(sample.offers(spark, sf))
    return quality.metric_document(quality.metrics(rows, None))


@query
def issue_preview(spark, sf):
    """The first findings of the unspoiled offers."""
    rows = sample.keyed(sample.offers(spark, sf)).select(
        "file_id", "natural_key", "row_num", "row_hash", "status_norm", "provider", "program",
        "province", "canton", "province_norm", "canton_norm",
    )
    return quality.preview(quality.issues(stored(rows), None))


def _event_issues(spark, sf) -> DataFrame:
    return sample.table(spark, sf, "events").select(
        F.col("event_id").alias("issue_id"), F.col("ts").alias("created_at"),
        F.col("event_type").alias("issue_type"), F.col("props").alias("detail"),
    )


@query
def recent_issues(spark, sf):
    """The newest issues, limited to chosen types."""
    return quality.recent_issues(_event_issues(spark, sf), RECENT_ISSUES, ["error", "click"])


@query
def issue_types(spark, sf):
    return quality.issue_types(_event_issues(spark, sf))


@query
def constraint_audit(spark, sf):
    """Unique keys, value sets, required values and references of the test tables."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "labels",
             "documents")
    tables = {name: sample.table(spark, sf, name) for name in names}
    tables["files"] = sample.event_ledger(spark, sf)
    rules = [
        constraints.Unique("orders", ["o_orderkey"]),
        constraints.Unique("part", ["p_partkey"]),
        constraints.Unique("part", ["p_name", "p_type", "p_brand"]),
        constraints.Unique("supplier", ["s_name"], "s_acctbal > 0"),
        constraints.Unique("lineitem", ["l_orderkey", "l_linenumber"]),
        constraints.OneOf("orders", "o_orderstatus", ["F", "O"]),
        constraints.OneOf("files", "status", RUN_STATES),
        constraints.Required("documents", "text"),
        constraints.Required("files", "ingest_new"),
        constraints.Reference("lineitem", "l_orderkey", "orders", "o_orderkey"),
        constraints.Reference("lineitem", "l_suppkey", "customer", "c_custkey"),
        constraints.Reference("orders", "o_custkey", "customer", "c_custkey"),
        constraints.Reference("nation", "n_regionkey", "region", "r_regionkey"),
        constraints.Reference("documents", "doc_id", "labels", "doc_id"),
    ]
    return constraints.audit(tables, rules)


# Runs, steps, services -----------------------------------------------------------------------


def _series(bucket: str) -> Query:
    def run(spark, sf):
        made = monitoring.ingestion_series(sample.event_ledger(spark, sf), bucket)
        return _naive(made, "period")

    run.__name__ = f"ingestion_series_{bucket}"
    return query(run)


for _bucket in ("hour", "day", "week", "month"):
    _series(_bucket)


@query
def pipeline_health(spark, sf):
    made = monitoring.pipeline_health(sample.event_ledger(spark, sf))
    return _round(made, "success_rate", "avg_duration", "avg_rows_per_second")


@query
def run_states(spark, sf):
    return ledger.run_states(sample.event_ledger(spark, sf))


@query
def file_sizes(spark, sf):
    return _round(monitoring.file_sizes(sample.event_ledger(spark, sf)), "file_size_mb")


@query
def latest_run(spark, sf):
    return dedup.latest_run(sample.event_ledger(spark, sf))


@query
def latest_run_steps(spark, sf):
    """Steps of the user seen last, as the steps of the latest run."""
    steps = sample.event_steps(spark, sf)
    seen = steps.groupBy("file_id").agg(F.max("started_at").alias("ingested_at"))
    return dedup.steps_of_latest_run(steps, seen)


@query
def last_step_per_file(spark, sf):
    return dedup.keep_last(
        sample.event_steps(spark, sf), ["file_id"], ["started_at", "step_id"]
    )


@query
def step_avg(spark, sf):
    return _round(monitoring.step_average(sample.event_steps(spark, sf)), "avg_seconds")


@query
def step_durations(spark, sf):
    """Seconds from each step to the end of its day's work."""
    steps = sample.event_steps(spark, sf)
    ends = steps.groupBy("file_id").agg(F.max("started_at").alias("finished_at"))
    return lookup_join(steps, ends, ["file_id"]).select(
        "step_id", "file_id",
        seconds_between(F.col("started_at"), F.col("finished_at")).alias("seconds"),
    )


def _checks(spark, sf) -> DataFrame:
    code = F.col("code")
    return sample.event_health(spark, sf).select(
        "check_id", "service_name", "created_at", "latency_ms",
        structured.availability(code).alias("status"),
        structured.status_code(code).alias("status_code"),
    )


@query
def service_latest(spark, sf):
    return monitoring.service_latest(_checks(spark, sf))


@query
def service_counts(spark, sf):
    return monitoring.service_counts(_checks(spark, sf))


@query
def recent_checks(spark, sf):
    return monitoring.recent_checks(_checks(spark, sf), RECENT_CHECKS)


def _quality_runs(spark, sf) -> DataFrame:
    """A metric document per event, broken for one type of event."""
    number = F.col("event_id")
    document = structured.json_document(
        **{name: (number * (i + 2)) % 101 for i, name in enumerate(LOAD_METRICS)},
        invalid_territory=number % 17, duplicates_in_file=number % 19,
    )
    return sample.table(spark, sf, "events").select(
        number.cast("string").alias("file_id"), F.col("ts").alias("created_at"),
        F.when(F.col("event_type") == "view", F.lit("{broken")).otherwise(document).alias(
            "metrics"
        ),
    )


@query
def timeline_long(spark, sf):
    """Load figures per run and measure, gaps filled from the quality runs."""
    return monitoring.timeline(sample.event_ledger(spark, sf), _quality_runs(spark, sf))


@query
def metric_series(spark, sf):
    return reshape.metric_series(_quality_runs(spark, sf))


@query
def metric_columns(spark, sf):
    return reshape.metric_columns(
        _quality_runs(spark, sf), ["file_id", "created_at"],
        ["invalid_territory", "duplicates_in_file", "absent"],
    )


@query
def props_map(spark, sf):
    """Event properties parsed as a metric map, one row per member."""
    return reshape.metric_rows(sample.table(spark, sf, "events"), ["event_id"], "props")


@query
def coerced_casts(spark, sf):
    """Numbers and times read from text, NULL where they are neither."""
    name = F.col("c_name")
    digits = F.split_part(name, F.lit("#"), F.lit(2))
    return sample.table(spark, sf, "customer").select(
        "c_custkey", structured.to_number(name).alias("name_number"),
        structured.to_number(digits).alias("number"),
        structured.to_instant(F.concat(F.lit("2024-01-"), F.substring(digits, 8, 2)))
        .cast("timestamp_ntz").alias("day"),
    )


@query
def artifact_rows(spark, sf):
    """Source and report artefacts of every page, stored as JSON and read back."""
    file_id = F.col("page_id").cast("string")
    source = structured.object_path("sources", file_id, F.element_at(F.split("url", "/"), -1))
    report = structured.object_path("reports", file_id, F.lit("data_quality.json"))
    base = F.lit("https://files.example.org/")

    def info(path):
        url = structured.public_url(base, "artifacts", path)
        return F.struct(path.alias("path"), url.alias("url"))

    stored = sample.table(spark, sf, "pages").select(
        file_id.alias("file_id"),
        F.to_json(
            F.struct(info(source).alias("source_file"), info(report).alias("report"))
        ).alias("storage_paths"),
    )
    return reshape.artifact_rows(stored)


@query
def load_profile(spark, sf):
    return monitoring.load_profile(sample.keyed(sample.offers(spark, sf)))


# Ledger and arrivals -------------------------------------------------------------------------


@query
def ledger_state(spark, sf):
    """The current row of every file, from the events written about it."""
    number = F.col("event_id")
    kind = F.col("event_type")
    events = sample.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("file_id"), number.alias("event_seq"),
        F.col("ts").alias("event_at"), kind.alias("status"),
        F.when(kind == "error", F.concat(F.lit("note "), number)).alias("notes"),
        F.when(kind == "click", number % 100).alias("rows_loaded"),
        F.when(kind == "purchase", F.col("value")).alias("duration_seconds"),
    )
    return ledger.current_state(events)


def _arrivals(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Documents as arriving files; labelled ones as runs, good or failed by their quality."""
    docs = sample.table(spark, sf, "documents").select(
        "doc_id", F.sha2("text", 256).alias("checksum")
    )
    done = docs.join(sample.table(spark, sf, "labels"), "doc_id").select(
        F.col("doc_id").cast("string").alias("file_id"), "checksum",
        F.when(F.col("quality") == 1, "success").otherwise("failed").alias("status"),
    )
    return docs, done


@query
def pending_documents(spark, sf):
    """Documents whose content no successful run has loaded."""
    return ledger.pending(*_arrivals(spark, sf))


@query
def loaded_documents(spark, sf):
    """Documents whose content some successful run has loaded, with that run."""
    return ledger.already_loaded(*_arrivals(spark, sf))


@query
def pending_files(spark, sf):
    """Stored files under the folder, by content checksum, that no run has loaded."""
    done = sample.table(spark, sf, "documents").select(
        F.sha2("text", 256).alias("checksum"), F.lit("success").alias("status")
    )
    return ledger.pending(files.file_checksums(spark, sf, "*.parquet"), done)


@query
def header_discovery(spark, sf):
    """Offers read from a headerless cell table with a title, a blank row and untidy names."""
    rows = sample.offers(spark, sf)
    names = list(SOURCE_COLUMNS.values())
    cells = rows.select(
        (F.col("row_num") + 2).alias("pos"),
        *[F.col(n).alias(f"c{i}") for i, n in enumerate(names)],
    )
    untidy = [f" {n.replace('_', '  ').lower()}. " for n in REQUIRED]
    top = [
        (0, "Published offers", *[None] * (len(names) - 1)),
        (1, *[None] * len(names)),
        (2, *untidy),
    ]
    kinds = ", ".join(f"{c} {'bigint' if c == 'pos' else 'string'}" for c in cells.columns)
    head = spark.createDataFrame(top, kinds)
    below = offers.rows_below_header(head.unionByName(cells))
    return offers.drop_empty(below)


@query
def read_offers_csv(spark, sf):
    """Offers read back from part files of which the first has a title and the header, with
    doubled quotes and line breaks in cells, and an empty record after some of the others."""
    names = list(SOURCE_COLUMNS.values())
    rows = sample.offers(spark, sf).select("row_num", *names).withColumns(
        {
            "provider": F.concat("provider", F.lit(' "of", '), "modality"),
            "program": F.concat("program", F.lit("\n"), "status"),
        }
    )
    cells = [F.concat(F.lit('"'), F.replace(n, F.lit('"'), F.lit('""')), F.lit('"')) for n in names]
    empty = F.when(F.col("row_num") % 7 == 0, F.lit("\n" + "," * (len(names) - 1)))
    lines = rows.select(
        "row_num", F.concat(F.concat_ws(",", *cells), F.coalesce(empty, F.lit(""))).alias("value")
    )
    top = [(-2, "Published offers, all runs"), (-1, ",".join(REQUIRED))]
    lines = lines.unionByName(spark.createDataFrame(top, "row_num bigint, value string"))
    parts = max(3, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = f"{scratch_dir(spark).rstrip('/')}/landing/{uuid.uuid4().hex}"
    ordered = lines.repartitionByRange(parts, "row_num").sortWithinPartitions("row_num")
    ordered.select("value").write.text(path)
    return offers.read_offers(spark, path, format="csv", multiline=True)


@query
def dimension_counts(spark, sf):
    """Distinct dimension members per run, combinations with NULL parts included."""
    return monitoring.dimension_counts(_checked(spark, sf, *PROVIDER_KEY, *PROGRAM_KEY))


def _plain_runs(spark, sf) -> DataFrame:
    """Quality runs of the unspoiled offers."""
    return dq_run_metrics(spark, sf).select(
        "file_id", F.col("file_id").alias("run_id"), F.lit(NOW).cast("timestamp").alias("created_at"), "metrics"
    )


@query
def dq_report(spark, sf):
    """The quality report of every run as JSON text."""
    return reports.report_document(_plain_runs(spark, sf), "offers")


@query
def dq_metric_table(spark, sf):
    """Quality metrics as (metric, value) rows, summed over the runs."""
    rows = reports.metric_table(_plain_runs(spark, sf))
    return rows.groupBy("metric").agg(F.sum("value").alias("value"))


@query
def recent_steps(spark, sf):
    return monitoring.recent_steps(sample.event_steps(spark, sf))


@query
def surrogate_ids(spark, sf):
    """Identifiers from keys with and without NULL parts."""
    return sample.table(spark, sf, "orders").select(
        "o_orderkey",
        surrogate_id(
            F.col("o_orderkey"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
        ).alias("id"),
    )


# The warehouse itself, loaded from files that Spark writes out of the test tables --------------

_HOUSES: dict[tuple[str, str], Warehouse] = {}


def _house(spark, sf) -> Warehouse:
    """A warehouse that has loaded every run of the spoiled offers; built once per session.

    Each run is a folder of delimited files in row order, each with a header. The views are
    published first of all. Then all runs but the newest are loaded together, and the newest is
    merged into what they left.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key in _HOUSES:
        return _HOUSES[key]
    base = f"{scratch_dir(spark).rstrip('/')}/house/{uuid.uuid4().hex}"
    with scratch_scope(spark):
        rows = _spoiled(spark, sf).select(
            "file_id", "row_num", *[F.col(n).alias(p) for p, n in SOURCE_COLUMNS.items()]
        )
        # A gzipped file is read by one task, so there are several.
        written = {
            "header": True, "escape": '"', "compression": "gzip", "maxRecordsPerFile": 100_000,
        }
        ordered = rows.orderBy("file_id", "row_num").drop("row_num")
        ordered.write.partitionBy("file_id").options(**written).csv(f"{base}/landing")
        # 25 rows, in catalogue order.
        places = sample.catalog(spark, sf).orderBy("ordinal").select(
            F.col("province_norm").alias("provincia"), F.col("canton_norm").alias("canton")
        )
        places.coalesce(1).write.option("header", True).csv(f"{base}/places")
        # One value per run.
        years = sample.runs(spark, sf).orderBy("file_id").select("file_id").collect()
        paths = [f"{base}/landing/file_id={y['file_id']}" for y in years]
        first = dt.datetime(2002, 1, 1, tzinfo=dt.UTC)
    house = Warehouse(spark, f"{base}/house")
    _publish(house)
    load_files(spark, house.root, paths[:-1], f"{base}/places", first)
    last = first + dt.timedelta(milliseconds=len(paths) - 1)
    load_files(spark, house.root, paths[-1:], f"{base}/places", last)
    _HOUSES[key] = house
    return house


_PUBLISHED: dict[str, str] = {}


def _publish(house: Warehouse) -> None:
    """Publish the views, unless this session shows this house already."""
    session = house.spark.sparkContext.applicationId
    if _PUBLISHED.get(session) != house.root:
        publish_views(house.spark, house.root)
        _PUBLISHED[session] = house.root


def _utc(df: DataFrame, *columns: str) -> DataFrame:
    """Instants as naive UTC times."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    return df.withColumns(
        {
            c: F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))
            for c in columns
        }
    )


@query
def warehouse_versions(spark, sf):
    """All stored versions after loading every run."""
    versions = _house(spark, sf).versions().select(
        "natural_key", "row_hash", "status", "first_seen_at", "last_seen_at", "is_current"
    )
    return _utc(versions, "first_seen_at", "last_seen_at")


@query
def warehouse_runs(spark, sf):
    """The ledger: what each run loaded and changed."""
    runs = _house(spark, sf).ledger().select("ingested_at", "status", "notes", *LOAD_METRICS)
    return _utc(runs, "ingested_at")


@query
def warehouse_storage_states(spark, sf):
    """What became of the artefacts of the stored runs."""
    return ledger.storage_states(_house(spark, sf).ledger())


@query
def warehouse_quality(spark, sf):
    """Stored quality metrics of every run."""
    runs = _house(spark, sf).table("audit/run")
    return _utc(reshape.metric_rows(runs, ["created_at"]), "created_at")


@query
def warehouse_issues(spark, sf):
    """Stored issues by run and type."""
    log = _house(spark, sf).table("audit/issue")
    counts = log.groupBy("created_at", "issue_type").agg(F.count("*").alias("issues"))
    return _utc(counts, "created_at")


@query
def warehouse_star(spark, sf):
    """The star of the stored current offers."""
    star = _house(spark, sf).star().drop("offer_id", "is_current")
    return _utc(star, "last_seen_at", "ingested_at")


@query
def warehouse_constraints(spark, sf):
    """The constraint audit of the stored warehouse."""
    house = _house(spark, sf)
    return constraints.audit(house.constraint_tables())


@query
def published_top_provinces(spark, sf):
    """The published table function, called from SQL; it was published before any load."""
    _publish(_house(spark, sf))
    return spark.sql("SELECT * FROM rpc_top_provinces(3)")


@query
def published_series(spark, sf):
    """The published series function, called from SQL; it was published before any load."""
    _publish(_house(spark, sf))
    return spark.sql(
        "SELECT files, rows_loaded, ingest_new, ingest_updated, ingest_unchanged, "
        "skipped_missing_dims FROM rpc_ingestion_series('month')"
    )


# Streams -------------------------------------------------------------------------------------


def _write_one_file(rows: DataFrame, path: str, order: str) -> None:
    """Rows in order as one CSV file, without the column that orders them.

    They are joined and sorted in parallel, and stored so; one task then copies the sorted parts
    in turn and holds none of them.
    """
    sorted_ = checkpointed(rows.orderBy(order)).drop(order)
    sorted_.coalesce(1).write.options(header=True, escape='"').csv(path)


@query
def arrivals_ledger(spark, sf):
    """What the ledger says of files that arrived: one good, one without the required columns,
    and one with a record of another width."""
    base = f"{scratch_dir(spark).rstrip('/')}/arrivals/{uuid.uuid4().hex}"
    newest = _newest(spark, sf)
    rows = _spoiled(spark, sf).where(F.col("file_id") == newest).select(
        "row_num", *[F.col(n).alias(p) for p, n in SOURCE_COLUMNS.items()]
    )
    _write_one_file(rows, f"{base}/landing/offers", "row_num")
    places = sample.table(spark, sf, "region")
    places.coalesce(1).write.option("header", True).csv(f"{base}/landing/places")
    header = ",".join(REQUIRED)
    torn = places.groupBy().agg(F.array_sort(F.collect_list("r_name")).alias("names"))
    torn.select(F.concat_ws("\n", F.lit(header), "names")).coalesce(1).write.text(
        f"{base}/landing/torn"
    )
    arrivals.start(
        spark, f"{base}/landing/*", f"{base}/house", f"{base}/checkpoint", pattern="*.{csv,txt}"
    ).awaitTermination()
    ledger_ = Warehouse(spark, f"{base}/house").ledger()
    return ledger_.groupBy("status").agg(
        F.count("*").alias("files"), F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded")
    )


@query
def service_states(spark, sf):
    """The latest check and the counts of every service, followed by a stream over a restart."""
    base = f"{scratch_dir(spark).rstrip('/')}/health/{uuid.uuid4().hex}"
    checks = sample.event_health(spark, sf).select(
        F.col("service_name").cast("string"), F.lit("probe").alias("endpoint"),
        F.col("created_at").cast("timestamp"), "code", "latency_ms",
        F.lit(None).cast("string").alias("error"), "check_id",
    )
    for part in (0, 1):
        append_health(checks.where(F.col("check_id") % 2 == part).drop("check_id"), base)
        health.follow(spark, base, f"{base}/checkpoint").awaitTermination()
    found = health.service_states(spark, base).drop("endpoint", "detail")
    return _naive(found, "created_at")
