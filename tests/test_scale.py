"""What travels, and where, in the steps that grow with the data."""

import pytest
from pyspark.sql import functions as F

from tideline.functions.keys import packed_digest, unpacked_digest
from tideline.operators import constraints, dimensions, history, quality, skew
from tideline.plans import queries
from tideline.plans.queries import QUERIES
from tideline.sinks.tables import next_buckets
from tideline.sources import offers


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df) -> list:
    return sorted(map(str, df.collect()))


def test_digests_come_back_whole(spark):
    texts = ["ab" * 32, "AB" * 32, "0" * 64, "a" * 63, "", "é", "0" * 64 + "\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select("t", packed_digest(F.col("t")).alias("p"))
    assert {r["t"]: len(r["p"]) for r in found.collect() if r["t"]}["ab" * 32] == 33
    assert [r[0] for r in found.select(unpacked_digest(F.col("p"))).collect()] == texts


def _versions(spark):
    rows = [
        (f"k{i % 7}", f"{(i * i) % 3}" * 64, f"p{i % 7}" * 32, f"f{i % 3}", f"2020-01-0{i % 3 + 1}", i)
        for i in range(21)
    ]
    return spark.createDataFrame(
        rows, "natural_key string, row_hash string, program_id string, file_id string, "
        "run_ts string, row_num bigint"
    ).withColumn("run_ts", F.col("run_ts").cast("timestamp"))


def test_unique_rows_are_dealt_out_once(spark):
    rows = _versions(spark)
    made = history.replay(rows, ["program_id"], ["row_num"], unique=True, parts=5)
    assert _plan(made).count("Exchange") == 1
    assert made.rdd.getNumPartitions() == 5
    assert _rows(made) == _rows(history.replay(rows, ["program_id"], ["row_num"]))
    counts = history.run_counts(rows, ["row_num"], unique=True)
    assert _rows(counts) == _rows(history.run_counts(rows, ["row_num"]))


def test_replay_goes_on_from_stored_versions(spark):
    rows = _versions(spark)
    early = history.replay(rows.where("file_id < 'f2'"), ["program_id"], ["row_num"])
    late = history.replay(
        rows.where("file_id = 'f2'"), ["program_id"], ["row_num"], early.where("is_current")
    )
    closed = early.where("not is_current")
    whole = history.replay(rows, ["program_id"], ["row_num"])
    assert _rows(late.unionByName(closed)) == _rows(whole)


def test_first_load_makes_buckets_for_its_rows(spark, tmp_path):
    assert next_buckets(spark, str(tmp_path), None, 100_000_000) == 128


@pytest.mark.parametrize("name", ["dedup_last", "scd2_versions"])
def test_hashes_are_made_after_rows_travel(spark, sample_dir, name):
    plan = _plan(QUERIES[name](spark, sample_dir))
    assert "sha2" in plan
    assert plan.rindex("sha2") < plan.rindex("Window")


def test_versions_without_a_time_have_no_hash(spark):
    rows = spark.createDataFrame([("k", None), ("l", "")], "natural_key string, row_hash string")
    rows = rows.withColumn("status_norm", F.lit(None).cast("string"))
    found = {r["natural_key"]: r["row_hash"] for r in queries._hashed(rows).collect()}
    assert found["k"] is None and len(found["l"]) == 64


def test_merge_does_not_deal_out_the_state_again(spark, sample_dir):
    assert "hashpartitioning(_hash" not in _plan(QUERIES["scd2_merge"](spark, sample_dir))


def test_rows_travel_for_programs_without_other_ids(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    rows = spark.createDataFrame(
        [("a", "b", "c", "d", "e", "f", "g")],
        "provider_norm string, program_norm string, field_norm string, level_norm string, "
        "modality_norm string, province_norm string, canton_norm string",
    )

    def dim(name, keys):
        return rows.select(*keys).withColumn(f"{name}_id", F.lit(name))

    found = dimensions.resolve_ids(
        rows, dim("provider", ["provider_norm"]),
        dim("territory", ["province_norm", "canton_norm"]),
        dim("program", ["program_norm", "field_norm", "level_norm", "modality_norm"]),
    )
    assert found.columns == [*rows.columns, "provider_id", "territory_id", "program_id"]
    assert found.first()[7:] == ("provider", "territory", "program")
    joins = [x for x in _plan(found).splitlines() if "Join" in x and "_salt" in x]
    assert "program_norm" in joins[-1]  # the innermost one


def test_metrics_single_out_no_rows(spark, monkeypatch):
    def never(*_):
        raise AssertionError("rows of repeated keys are not needed for counts")

    monkeypatch.setattr(quality, "rows_of_repeated_keys", never)
    rows = spark.createDataFrame(
        [("f", "k", 1, "h", "A"), ("f", "k", 2, "h", "B"), ("f", "l", 3, "h", None),
         ("f", "l", 4, "h", "A"), ("f", "m", 5, "h", "A"), (None, "n", 6, "h", "A"),
         (None, "n", 7, "h", "B")],
        "file_id string, natural_key string, row_num bigint, row_hash string, status_norm string",
    ).withColumns({c: F.lit("x") for c in ("provider", "program", "province_norm", "canton_norm")})
    found = {(r["file_id"], r["metric"]): r["value"] for r in quality.metrics(rows, None).collect()}
    assert found["f", "duplicates_in_file"] == 4
    assert found["f", "conflicting_estado"] == 1
    assert found[None, "duplicates_in_file"] == found[None, "conflicting_estado"] == 0


def test_audit_deals_entries_out_by_their_number(spark, monkeypatch):
    tables = {"t": spark.range(100).select((F.col("id") % 90).alias("a"), F.lit("x").alias("b"))}
    rules = [constraints.Unique("t", ["a"]), constraints.OneOf("t", "b", ["y"]),
             constraints.Reference("t", "a", "t", "a")]
    plain = _rows(constraints.audit(tables, rules))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    monkeypatch.setattr(constraints, "TASK_ENTRIES", 50)
    collect = type(tables["t"]).collect

    def watched(df):
        seen.append(spark.conf.get("spark.sql.shuffle.partitions"))
        return collect(df)

    monkeypatch.setattr(type(tables["t"]), "collect", watched)
    found = constraints.audit(tables, rules)
    assert seen == ["8"]
    monkeypatch.undo()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert _rows(found) == plain


def test_one_file_is_sorted_before_it_is_one(spark, tmp_path):
    rows = spark.range(1000).repartition(7).select((1000 - F.col("id")).alias("n"), F.col("id").alias("v"))
    queries._write_one_file(rows, str(tmp_path / "one"), "n")
    (part,) = (tmp_path / "one").glob("*.csv")
    assert part.read_text().split() == ["v", *[str(v) for v in reversed(range(1000))]]


def test_header_search_takes_apart_only_lines_with_its_words(spark, tmp_path, monkeypatch):
    real = offers.column_name_expr
    monkeypatch.setattr(
        offers, "column_name_expr",
        lambda c: F.when(c == "plain", F.raise_error(F.lit("taken apart"))).otherwise(real(c)),
    )
    lines = ["plain,plain"] * 80 + ["Cantón,nombre  ies"]
    (tmp_path / "a.csv").write_text("\n".join(lines), encoding="utf-8")
    found = offers._header_cells(spark, str(tmp_path), ",", ("NOMBRE_IES", "CANTON"))
    assert found == ["Cantón", "nombre  ies"]
