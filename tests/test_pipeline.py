import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tideline.contract import QUALITY_METRICS, REQUIRED
from tideline.functions.keys import row_hash
from tideline.operators import constraints, history
from tideline.plans.ingest import _PAYLOAD, load_files, retry_failed, run_batch
from tideline.plans.warehouse import Warehouse, publish_views
from tideline.sinks import tables
from tideline.sinks.tables import append_events, append_health, compact_ledger, ensure_tables
from tideline.streaming import arrivals, health

CATALOG = [("El Oro", "Machala"), ("El Oro", "Zaruma"), ("Loja", "Loja"), ("Pichincha", "Quito")]


def offer(provider="Uni Á", program="Química", province="El Oro", canton="Machala",
          status="Vigente", kind="Mixta", modality="Nocturna"):
    return [provider, kind, "Propios", program, "Ciencias", "Corto", modality, province,
            canton, status]


FIRST = [
    offer(), offer(status="No vigente"),                   # one key twice, two statuses
    offer(program="Derecho", province="el oroo"),          # fuzzy province
    offer(program="Medicina", province="Narnia"),          # unknown province
    offer(program="Artes", canton="Nowhere"),              # unknown canton
    offer(provider="", program="Música", province="Loja", canton="LOJA"),
    offer(provider="Uni B", province="Pichincha", canton="Quito"),
]
SECOND = [
    offer(status="No vigente", kind="Privada"),            # unchanged
    offer(program="Derecho", status="Cerrada"),            # changed
    offer(program="Danza", province="Loja", canton="Loja"),  # new
]


def write_csv(path, rows):
    lines = ["Oferta,,", ",".join(REQUIRED), *[",".join(r) for r in rows]]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("house")
    places = base / "places.csv"
    places.write_text("provincia,canton\n" + "\n".join(",".join(p) for p in CATALOG) + "\n")
    root = str(base / "root")
    files = [write_csv(base / "first.csv", FIRST), write_csv(base / "second.csv", SECOND)]
    days = [dt.datetime(2025, 1, 1, tzinfo=dt.UTC), dt.datetime(2025, 2, 3, tzinfo=dt.UTC)]
    results = [run_batch(spark, root, f, str(places), day) for f, day in zip(files, days)]
    return root, str(places), files, days, results


def test_first_run_metrics(loaded):
    first = loaded[4][0]["metrics"]
    assert first == {
        "rows_loaded": 7, "ingest_new": 4, "ingest_updated": 0, "ingest_unchanged": 0,
        "skipped_missing_dims": 2, "duplicates_in_file": 2, "invalid_territory": 2,
        "invalid_territory_pair": 0, "conflicting_estado": 1, "missing_NOMBRE_IES": 1,
        "missing_NOMBRE_CARRERA": 0,
    }
    keys = sum(first[k] for k in ("ingest_new", "ingest_updated", "ingest_unchanged",
                                  "skipped_missing_dims"))
    assert keys == 6


def test_second_run_versions(spark, loaded):
    root, _, _, days, results = loaded
    second = results[1]["metrics"]
    assert [second[f"ingest_{k}"] for k in ("new", "updated", "unchanged")] == [1, 1, 1]
    house = Warehouse(spark, root)
    versions = house.versions().collect()
    assert len(versions) == 6 and sum(v["is_current"] for v in versions) == 5
    law = sorted((v for v in versions if "derecho" in v["natural_key"]),
                 key=lambda v: v["first_seen_at"])
    naive = [d.replace(tzinfo=None) for d in days]
    assert [(v["first_seen_at"], v["last_seen_at"], v["is_current"], v["status"]) for v in law] == [
        (naive[0], naive[1], False, "Vigente"), (naive[1], naive[1], True, "Cerrada")]
    assert law[0]["last_file_id"] == results[1]["file_id"]
    seen = {v["natural_key"]: v for v in versions if v["is_current"]}
    same = next(v for k, v in seen.items() if k.startswith("uni a|quimica"))
    assert (same["first_seen_at"], same["last_seen_at"]) == (naive[0], naive[1])
    absent = next(v for k, v in seen.items() if k.startswith("uni b"))
    assert absent["last_seen_at"] == naive[0]


def test_dimensions(spark, loaded):
    house = Warehouse(spark, loaded[0])
    providers = {r["provider_norm"]: r for r in house.dimension("provider").collect()}
    assert set(providers) == {"uni a", None, "uni b"}
    assert providers["uni a"]["provider_type"] == "Privada"
    assert providers["uni a"]["provider"] == "Uni Á"
    assert providers["uni a"]["created_at"] < providers["uni a"]["updated_at"]
    places = {(r["province_norm"], r["canton_norm"])
              for r in house.dimension("territory").collect()}
    assert places == {("el oro", "machala"), ("loja", "loja"), ("pichincha", "quito")}


def test_replay_of_a_file_is_skipped(spark, loaded):
    root, places, files, _, results = loaded
    again = run_batch(spark, root, files[0], places)
    assert again == {"status": "skipped", "file_id": results[0]["file_id"]}
    row = Warehouse(spark, root).ledger().where(F.col("file_id") == again["file_id"]).first()
    assert row["status"] == "success" and row["notes"].startswith("Duplicate checksum skipped")
    assert row["rows_loaded"] == 7


def test_ledger_steps_and_reports(spark, loaded):
    root, _, files, _, results = loaded
    house = Warehouse(spark, root)
    row = house.ledger().where(F.col("file_id") == results[1]["file_id"]).first()
    assert row["notes"] == "new=1, updated=1, unchanged=1, skipped_missing_dims=0"
    assert 0 < row["duration_seconds"] < 600 and row["finished_at"] > row["started_at"]
    assert row["checksum"] and row["file_size_bytes"] > 0 and row["storage_status"] == "success"
    document = json.loads(row["process_metrics"])
    assert set(document) == {"timings", "rows", "unique"}
    assert document["rows"] == {"total": 3, "natural_keys": 3}
    assert set(document["unique"]) == {"ies", "territories", "programs"}
    assert json.loads(row["storage_paths"])["data_quality_json"]["path"] == (
        f"reports/{row['file_id']}/data_quality.json")
    names = {r["step_name"] for r in house.table("ops/step").collect()}
    assert {"checksum", "load_staging", "upsert_dims", "scd_fact", "data_quality"} <= names
    report = spark.read.json(f"{root}/reports/{results[0]['file_id']}/data_quality.json").first()
    assert report["file_path"] == files[0]
    assert report["metrics"].asDict() == results[0]["metrics"]
    issues = spark.read.csv(f"{root}/reports/{results[0]['file_id']}/inconsistencies.csv",
                            header=True, escape='"')
    assert issues.count() == house.table("audit/issue").where(
        F.col("file_id") == results[0]["file_id"]).count() == 6


def test_star_and_constraints(spark, loaded):
    house = Warehouse(spark, loaded[0])
    star = house.star()
    assert star.count() == 5
    assert {r["province"] for r in star.collect()} == {"el oro", "loja", "pichincha"}
    tables = house.constraint_tables()
    assert {r["violations"] for r in constraints.audit(tables).collect()} == {0}


def test_published_views(spark, loaded):
    publish_views(spark, loaded[0])
    found = spark.sql("SELECT * FROM rpc_top_provinces(2)").collect()
    assert [tuple(r) for r in found] == [("el oro", 2), ("loja", 2)]
    assert spark.sql("SELECT count(*) FROM rpc_top_provinces()").first()[0] == 3
    series = spark.sql("SELECT period, files, rows_loaded FROM rpc_ingestion_series('month')")
    assert [tuple(r) for r in series.collect()] == [
        (dt.datetime(2025, 1, 1), 1, 7), (dt.datetime(2025, 2, 1), 1, 3)]
    assert spark.sql("SELECT count(*) FROM v_ingestion_series").first()[0] == 2
    joined = spark.sql(
        "SELECT i.nombre_norm, t.provincia_norm, p.campo_amplio FROM fact_offer f "
        "JOIN dim_ies i ON f.ies_id = i.ies_id JOIN dim_territory t ON "
        "f.territory_id = t.territory_id JOIN dim_program p ON f.program_id = p.program_id "
        "LEFT JOIN files rf ON f.last_file_id = rf.file_id WHERE f.is_current = TRUE")
    assert joined.count() == 5


def test_failed_run_leaves_no_trace_and_can_be_retried(spark, loaded, tmp_path, monkeypatch):
    from tideline.plans import ingest

    _, places, files, _, _ = loaded
    root = str(tmp_path / "root")

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_check", broken)
        with pytest.raises(RuntimeError):
            run_batch(spark, root, files[0], places)
    house = Warehouse(spark, root)
    assert house.ledger().first()["status"] == "failed"
    assert house.newest() is None and house.versions().count() == 0
    assert run_batch(spark, root, files[0], places)["metrics"]["ingest_new"] == 4
    assert house.versions().count() == 4
    assert house.table("raw/staging").count() == 7


def test_without_catalogue(spark, loaded, tmp_path):
    result = run_batch(spark, str(tmp_path / "root"), loaded[2][1])
    metrics = result["metrics"]
    assert metrics["skipped_missing_dims"] == 3 and metrics["invalid_territory"] == 3
    assert metrics["invalid_territory_pair"] == 0
    assert set(QUALITY_METRICS) <= set(metrics)


def test_arrivals(spark, loaded, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    write_csv(landing / "1.csv", FIRST)
    root, checkpoint = str(tmp_path / "root"), str(tmp_path / "checkpoint")

    def drain():
        arrivals.start(spark, str(landing), root, checkpoint, loaded[1]).awaitTermination(120)
        return {r["file_name"].split("/")[-1]: r["status"]
                for r in Warehouse(spark, root).ledger().collect()}

    assert drain() == {"1.csv": "success"}
    write_csv(landing / "2.csv", SECOND)
    write_csv(landing / "copy.csv", FIRST)
    (landing / "odd.csv").write_text("a,b\n1,2\n")
    due = {"1.csv": "success", "2.csv": "success", "odd.csv": "failed"}
    assert drain() == due
    assert Warehouse(spark, root).current().count() == 5
    failed = Warehouse(spark, root).ledger().where("status = 'failed'").first()
    assert failed["notes"] and failed["storage_status"] == "failed" and failed["finished_at"]
    # Offered again it fails again; mended, it is loaded, and then there is nothing to retry.
    assert [r["status"] for r in retry_failed(spark, root, loaded[1])] == ["unreadable"]
    write_csv(landing / "odd.csv", [offer(program="Baile")])
    assert [r["status"] for r in retry_failed(spark, root, loaded[1])] == ["success"]
    assert retry_failed(spark, root, loaded[1]) == []
    assert Warehouse(spark, root).current().count() == 6


def test_schema_bootstrap(spark, loaded, tmp_path):
    root = str(tmp_path / "root")
    for path, day in zip(loaded[2], loaded[3]):
        run_batch(spark, root, path, loaded[1], day)
    try:
        assert ensure_tables(spark, root) is True
        assert ensure_tables(spark, root) is False
        assert spark.table("raw.staging").count() == 10
        assert spark.sql("SELECT count(*) FROM core.offer WHERE is_current").first()[0] == 9
    finally:
        for name in ("raw", "core", "audit", "ops"):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_health_checks(spark, tmp_path):
    checks = spark.createDataFrame(
        [("auth", "http://a", dt.datetime(2025, 1, 1), 200, 3.5, None),
         ("rest", "http://r", dt.datetime(2025, 1, 1), None, 9.0, "timeout")],
        "service_name string, endpoint string, created_at timestamp, code int, "
        "latency_ms double, error string")
    for _ in range(2):
        append_health(checks, str(tmp_path))
    found = Warehouse(spark, str(tmp_path)).table("ops/health")
    assert found.count() == 4
    down = found.where("status = 'down'").first()
    assert (down["status_code"], down["detail"]) == (0, '{"error":"timeout"}')


def test_backlog_equals_one_by_one(spark, loaded, tmp_path):
    root, places, files, days, results = loaded
    third = write_csv(tmp_path / "third.csv", [offer(status="Vigente"), *FIRST[2:4]])
    one = run_batch(spark, root, third, places, dt.datetime(2025, 3, 1, tzinfo=dt.UTC))
    both, step = str(tmp_path / "both"), str(tmp_path / "step")
    found = load_files(spark, both, [*files, files[0], third], places, days[0])
    assert [f["status"] for f in found] == ["success", "success", "skipped", "success"]
    assert [found[i]["metrics"] for i in (0, 1, 3)] == [
        results[0]["metrics"], results[1]["metrics"], one["metrics"]]
    run_batch(spark, step, files[0], places, days[0])
    load_files(spark, step, [files[1], third], places, days[0] + dt.timedelta(milliseconds=1))
    columns = ["natural_key", "row_hash", "status", "last_file_id", "is_current", "provider_id",
               "territory_id", "program_id", "offer_id"]

    def state(where, *extra):
        house = Warehouse(spark, where)
        versions = house.versions().select(*columns, *extra).collect()
        providers = house.dimension("provider").drop("created_at", "updated_at").collect()
        others = [house.dimension(n).select(f"{n}_id").collect() for n in ("territory", "program")]
        return [sorted(map(tuple, rows), key=str) for rows in (versions, providers, *others)]

    assert state(both) == state(root) == state(step)
    assert state(both, "first_seen_at", "last_seen_at") == state(
        step, "first_seen_at", "last_seen_at")
    assert Warehouse(spark, both).newest() == found[3]["file_id"]

    # Every file has its own steps and document, as if it had been loaded alone.
    ids = [found[i]["file_id"] for i in (0, 1, 3)]

    def told(where):
        house = Warehouse(spark, where)
        steps = house.table("ops/step").where(F.col("file_id").isin(ids)).collect()
        runs = house.ledger().where(F.col("file_id").isin(ids)).collect()
        documents = {r["file_id"]: json.loads(r["process_metrics"]) for r in runs}
        details = {
            (r["file_id"], r["step_name"]): (r["row_count"], json.loads(r["detail"] or "{}"))
            for r in steps
        }
        return details, {i: (d["rows"], d["unique"]) for i, d in documents.items()}

    alone, together = told(root), told(both)
    assert alone[1] == together[1] and set(alone[0]) == set(together[0])
    assert {i for i, _ in alone[0]} == set(ids)
    for key, (count, detail) in together[0].items():
        assert detail.pop("files") == 3
        assert (count, detail) == alone[0][key]


def test_a_retry_leaves_nothing_of_the_first_try(spark, tmp_path, monkeypatch):
    """Load a; b fails after its versions are written; load c; retry b, which closes nothing."""
    from tideline.plans import ingest

    root, places, files = str(tmp_path / "house"), str(tmp_path / "p.csv"), []
    (tmp_path / "p.csv").write_text(
        "provincia,canton\n" + "".join(f"{p},{c}\n" for p, c in CATALOG), encoding="utf-8"
    )
    contents = ([offer()], [offer(status="Cerrada")], [offer(status="Cerrada"), offer(program="X")])
    for i, rows in enumerate(contents):
        write_csv(tmp_path / f"{i}.csv", rows)
        files.append(str(tmp_path / f"{i}.csv"))
    run_batch(spark, root, files[0], places)
    text = "e" * 3000

    def broken(*_):
        raise RuntimeError(text)

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_report", broken)
        with pytest.raises(RuntimeError):
            run_batch(spark, root, files[1], places)
    house = Warehouse(spark, root)
    failed = house.ledger().where("status = 'failed'").first()
    assert failed["notes"] == text and json.loads(failed["process_metrics"])["error"] == text
    assert house.of_good_runs("audit/run").count() == 1
    run_batch(spark, root, files[2], places)
    run_batch(spark, root, files[1], places)
    versions = house.versions()
    assert versions.count() == versions.select("offer_id").distinct().count()
    closed = house.table("core/offer").where("not is_current")
    assert closed.where(F.col("file_id") == failed["file_id"]).count() == 0


def test_a_broken_file_fails_alone(spark, tmp_path):
    from tideline.plans.ingest import load_files

    root = str(tmp_path / "house")
    write_csv(tmp_path / "good.csv", [offer()])
    (tmp_path / "bad.csv.gz").write_bytes(b"\x1f\x8b\x08\x00broken")
    paths = [str(tmp_path / "bad.csv.gz"), str(tmp_path / "good.csv")]
    results = load_files(spark, root, paths, strict=False)
    assert [r["status"] for r in results] == ["failed", "success"]
    states = {r["file_name"]: r["status"] for r in Warehouse(spark, root).ledger().collect()}
    assert states == {paths[0]: "failed", paths[1]: "success"}


def test_views_follow_the_loads(spark, loaded, tmp_path):
    """Published over nothing, the views and functions show every later load."""
    root, (first, second) = str(tmp_path / "root"), loaded[2]
    publish_views(spark, root)
    top = lambda: [tuple(r) for r in spark.sql("SELECT * FROM rpc_top_provinces(2)").collect()]
    series = lambda: spark.sql("SELECT files FROM rpc_ingestion_series('year')").collect()
    versions = lambda: spark.table("fact_offer").count()
    assert top() == [] and series() == [] and versions() == 0
    run_batch(spark, root, first, loaded[1], loaded[3][0])
    assert top()[0] == ("el oro", 2) and versions() == 4
    run_batch(spark, root, second, loaded[1], loaded[3][1])
    assert top() == [("el oro", 2), ("loja", 2)] and versions() == 6
    assert spark.table("dim_ies").count() == 3 and spark.table("files").count() == 2
    assert spark.table("stg_oferta").count() == 10
    plan = spark.sql("SELECT * FROM dim_ies")._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan


def test_merge_goes_bucket_by_bucket(spark, loaded):
    """The current offers of the last run are joined as they lie, and nothing is lost by it."""
    house = Warehouse(spark, loaded[0])
    newest = house.newest()
    buckets = tables.offer_buckets(spark, loaded[0], newest)
    assert buckets == tables.next_buckets(spark, loaded[0], newest)
    current = house.bucketed_current(newest)
    plain = house.current(newest)
    assert sorted(map(tuple, current.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    keys = [r["natural_key"] for r in plain.collect()] + ["new|key"]
    incoming = spark.createDataFrame([(k,) for k in keys], "natural_key string").select(
        "natural_key", row_hash(F.col("natural_key"), F.lit("x")).alias("row_hash"),
        *[F.lit("v").alias(c) for c in _PAYLOAD],
    )
    now = F.lit(dt.datetime(2026, 1, 1)).cast("timestamp")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        merged = history.merge(current, incoming, _PAYLOAD, F.lit("f"), now, bucketed=True)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and f"SelectedBucketsCount: {buckets}" in plan
        assert plan.count("Exchange hashpartitioning") == 1
        usual = history.merge(plain, incoming, _PAYLOAD, F.lit("f"), now)
        assert sorted(map(str, merged.collect())) == sorted(map(str, usual.collect()))
    finally:
        spark.conf.set(limit, before)


def test_buckets_grow_with_the_offers(spark, loaded, monkeypatch):
    newest = Warehouse(spark, loaded[0]).newest()
    now = tables.offer_buckets(spark, loaded[0], newest)
    monkeypatch.setattr(tables, "MOST_BUCKET_BYTES", 1)
    monkeypatch.setattr(tables, "BUCKET_BYTES", 100)
    assert tables.next_buckets(spark, loaded[0], newest) > now
    assert tables.next_buckets(spark, loaded[0], None) >= 1


def test_ledger_compaction(spark, tmp_path, monkeypatch):
    """Files stay few, and the state the same, also if a compaction dies half-way."""
    root, start = str(tmp_path), dt.datetime(2025, 1, 1)

    def event(i, seq, **more):
        when = start + dt.timedelta(seconds=10 * i + seq)
        return {"file_id": f"f{i % 7}", "event_seq": seq, "event_at": when, **more}

    def state():
        return sorted(map(str, Warehouse(spark, root).ledger().collect()))

    def files():
        return len(tables._files(spark, f"{root}/raw/ledger"))

    for i in range(12):
        append_events(spark, root, [event(i, 0, status="running", notes=f"n{i}")])
        append_events(spark, root, [event(i, 2, status="success" if i % 3 else "failed")])
    whole = state()
    assert files() == 24 and not compact_ledger(spark, root, 24)

    with monkeypatch.context() as patch:
        # It dies after the folded events are stored, before they are noted.
        patch.setattr(tables, "_write_note", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact_ledger(spark, root, 5)
    assert state() == whole and files() > 24
    assert compact_ledger(spark, root, 5) and state() == whole
    # The next ones delete what was folded before.
    for i in range(12, 30):
        append_events(spark, root, [event(i, 2, status="success", notes=f"n{i}")])
        before = state()
        compact_ledger(spark, root, 5)
        assert state() == before
    assert files() <= 2 * 5 + 4
    notes = {r["file_id"]: r["notes"] for r in Warehouse(spark, root).ledger().collect()}
    assert notes == {f"f{i % 7}": f"n{i}" for i in range(23, 30)}


def test_health_stream_over_a_restart(spark, tmp_path):
    root, checkpoint = str(tmp_path / "root"), str(tmp_path / "checkpoint")

    def checks(*rows):
        append_health(spark.createDataFrame(
            [(s, "http://x", dt.datetime(2025, 1, d), c, 1.0, None) for s, d, c in rows],
            "service_name string, endpoint string, created_at timestamp, code int, "
            "latency_ms double, error string"), root)
        health.follow(spark, root, checkpoint).awaitTermination(120)
        found = health.service_states(spark, root).collect()
        return {r["service_name"]: (r["checks"], r["n_up"], r["n_down"], r["status"],
                                    r["created_at"].day) for r in found}

    assert health.service_states(spark, root) is None
    assert checks(("auth", 1, 200), ("rest", 1, 503), ("auth", 2, 503)) == {
        "auth": (2, 1, 1, "down", 2), "rest": (1, 0, 1, "down", 1)}
    # An older check that comes late counts, and the latest one stays.
    assert checks(("auth", 1, 200), ("new", 3, 200)) == {
        "auth": (3, 2, 1, "down", 2), "rest": (1, 0, 1, "down", 1), "new": (1, 1, 0, "up", 3)}


def test_audit_scans_every_table_once(spark, tmp_path):
    spark.createDataFrame([(1, "a", 9), (1, "b", 1), (None, "c", 2), (3, None, None)],
                          "id int, kind string, ref int").write.parquet(f"{tmp_path}/one")
    spark.createDataFrame([(1, 1), (2, 7), (2, 3)], "k int, j int").write.parquet(f"{tmp_path}/two")
    frames = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("one", "two")}
    rules = [
        constraints.Unique("one", ["id"]), constraints.Unique("two", ["k"], "j > 2"),
        constraints.OneOf("one", "kind", ["a", "b"]), constraints.Required("one", "ref"),
        constraints.Required("two", "k"), constraints.Reference("one", "ref", "two", "k"),
        constraints.Reference("two", "j", "one", "id"), constraints.Reference("two", "k", "two", "k"),
        constraints.Reference("one", "id", "two", "k"), constraints.Unique("one", ["id", "ref"]),
    ]
    found = constraints.audit(frames, rules)
    assert [(r["table_name"], r["violations"]) for r in found.collect()] == [
        ("one", 1), ("two", 1), ("one", 1), ("one", 1), ("two", 0), ("one", 1), ("two", 1),
        ("two", 0), ("one", 1), ("one", 0)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2
    assert {r["violations"] for r in constraints.audit(
        {n: f.limit(0) for n, f in frames.items()}, rules).collect()} == {0}
