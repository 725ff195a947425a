"""What a load leaves behind on disk."""

import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tideline import session
from tideline.contract import HEADER_SCAN, REQUIRED
from tideline.operators import constraints, skew
from tideline.plans import ingest, queries
from tideline.plans.warehouse import Warehouse
from tideline.session import checkpointed, scratch_dir, scratch_scope, stored
from tideline.sources import offers


def _scratch(spark) -> set[str]:
    """Data files in the scratch folder, without the houses that queries load there."""
    root = Path(scratch_dir(spark))
    found = {str(p) for p in root.rglob("part-*")}
    return {p for p in found if "/house/" not in p}


def _file(path, status, rows=6) -> str:
    lines = [",".join(REQUIRED)]
    for n in range(rows):
        lines.append(f"Uni {n % 3},A,B,Prog {n % 2},F,L,M,Loja,Loja,{status}")
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    base = tmp_path_factory.mktemp("landing")
    (base / "places.csv").write_text("provincia,canton\nLoja,Loja\n", encoding="utf-8")
    return [_file(base / f"{s}.csv", s) for s in ("a", "b", "c")], str(base / "places.csv")


def test_a_load_leaves_no_scratch_data(spark, files, tmp_path):
    before = _scratch(spark)
    results = ingest.load_files(spark, str(tmp_path), files[0], files[1])
    assert _scratch(spark) == before
    assert [r["status"] for r in results] == ["success"] * 3
    assert Warehouse(spark, str(tmp_path)).versions().count() == 18


def test_a_failed_load_leaves_no_scratch_data(spark, files, tmp_path, monkeypatch):
    def fail(*_):
        raise RuntimeError("no quality")

    monkeypatch.setattr(ingest, "_check", fail)
    before = _scratch(spark)
    with pytest.raises(RuntimeError, match="no quality"):
        ingest.load_files(spark, str(tmp_path), files[0], files[1])
    assert _scratch(spark) == before
    assert session._SCOPES.get() == ()


def test_scopes_delete_what_was_made_in_them(spark):
    before, option = _scratch(spark), spark.conf.get(session._CLEANUP)
    with scratch_scope(spark):
        with scratch_scope(spark):
            assert spark.conf.get(session._CLEANUP) == "true"
            kept = stored(spark.range(5), keep=True)
            stored(spark.range(6))
            assert checkpointed(spark.range(7)).count() == 7
        assert kept.count() == 5
        assert len({str(Path(p).parent) for p in _scratch(spark) - before}) == 1
    assert _scratch(spark) == before
    assert spark.conf.get(session._CLEANUP) == option
    outside = stored(spark.range(5))
    assert outside.count() == 5


def test_stored_hashes_are_those_of_the_staging(spark, files, tmp_path):
    ingest.load_files(spark, str(tmp_path), files[0][:2], files[1])
    house = Warehouse(spark, str(tmp_path))
    staged = house.table("raw/staging").select("natural_key", "row_hash").distinct()
    versions = house.versions().select("natural_key", "row_hash")
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, versions.collect()))


def test_report_and_landing_are_compressed(spark, sample_dir):
    base = Path(queries._house(spark, sample_dir).root)
    reports = list(base.glob("reports/*/inconsistencies.csv/part-*"))
    landing = list(base.parent.glob("landing/*/part-*"))
    assert reports and landing
    assert {p.suffix for p in [*reports, *landing]} == {".gz"}


def test_files_are_read_with_their_own_errors(spark, files, tmp_path):
    (tmp_path / "odd.csv").write_text("a,b\n1,2\n")
    paths = [files[0][0], str(tmp_path / "odd.csv"), files[0][1]]
    results = ingest.load_files(spark, str(tmp_path / "house"), paths, files[1], strict=False)
    assert [r["status"] for r in results] == ["success", "unreadable", "success"]
    runs = Warehouse(spark, str(tmp_path / "house")).ledger().where("status = 'success'")
    notes = {r["file_name"]: json.loads(r["process_metrics"])["rows"] for r in runs.collect()}
    assert notes[paths[0]] == notes[paths[2]] == {"total": 6, "natural_keys": 6}


def test_header_is_looked_for_in_the_first_records_only(spark, tmp_path, monkeypatch):
    real = offers.column_name_expr
    monkeypatch.setattr(
        offers, "column_name_expr",
        lambda c: F.when(c == "plain", F.raise_error(F.lit("taken apart"))).otherwise(real(c)),
    )
    rows = [",".join([f"v{n}" if n < HEADER_SCAN else "plain"] * len(REQUIRED)) for n in range(80)]
    (tmp_path / "a.csv").write_text("\n".join([",".join(REQUIRED), *rows]), encoding="utf-8")
    assert offers.read_offers(spark, str(tmp_path / "a.csv")).count() == 80


def test_only_keys_of_many_rows_are_spread(spark, monkeypatch):
    salted = []

    def watched(df, *more, **options):
        made = stored(df, *more, **options)
        if "_salt" in df.columns:
            salted.append(made)
        return made

    monkeypatch.setattr(skew, "stored", watched)
    monkeypatch.setattr(skew, "SPREAD_ROWS", 100)
    keys = ["hot"] * 300 + [f"k{i % 40}" for i in range(120)] + [None, None]
    df = spark.createDataFrame(list(zip(keys, range(len(keys)))), "k string, row_num int")
    found = skew.rows_of_repeated_keys(df, ["k"], F.col("row_num")).collect()
    counts = Counter(k for k in keys if k)
    assert Counter(r["k"] for r in found) == counts
    assert all(r["key_rows"] == counts[r["k"]] for r in found)
    salts = {r["k"]: r["n"] for r in salted[0].groupBy("k").agg(
        F.countDistinct("_salt").alias("n")).collect()}
    assert salts.pop("hot") > 10
    assert set(salts.values()) == {1}


def _shuffled(spark) -> set[str]:
    """Files of shuffles that are still there."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = disk.getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_scopes_drop_shuffles(spark):
    before = _shuffled(spark)
    with scratch_scope(spark):
        assert spark.range(100).groupBy((F.col("id") % 7).alias("k")).count().count() == 7
    assert not _shuffled(spark) - before


def test_audit_drops_its_shuffles(spark, monkeypatch):
    monkeypatch.setattr(constraints, "TASK_ENTRIES", 10)
    tables = {"t": spark.range(100).select((F.col("id") % 90).alias("a"))}
    before = _shuffled(spark)
    found = constraints.audit(tables, [constraints.Unique("t", ["a"])]).collect()
    # One for the count of the rows.
    assert found[0]["violations"] == 10 and len(_shuffled(spark) - before) <= 2
