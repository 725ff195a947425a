"""Published counts of the unspoiled offers, all runs taken as one file."""

from pyspark.sql import functions as F

from tideline.operators import quality
from tideline.plans.queries import QUERIES
from tideline.sources import sample


def test_key_counts(spark, sample_dir):
    rows = sample.keyed(sample.offers(spark, sample_dir)).withColumn("file_id", F.lit("all"))
    found = {r["metric"]: r["value"] for r in quality.metrics(rows, None).collect()}
    assert (found["duplicates_in_file"], found["conflicting_estado"]) == (3806, 1185)
    keys = rows.groupBy("natural_key").count()
    assert (rows.count(), keys.count(), keys.where("count > 1").count()) == (6000, 3789, 1595)


def test_version_identities(spark, sample_dir):
    counts = QUERIES["scd2_run_counts"](spark, sample_dir).collect()
    for r in counts:
        assert r["keys"] == r["ingest_new"] + r["ingest_updated"] + r["ingest_unchanged"]
    versions = QUERIES["scd2_versions"](spark, sample_dir)
    assert versions.count() == sum(r["ingest_new"] + r["ingest_updated"] for r in counts)
    current = versions.where("is_current")
    assert current.count() == current.select("natural_key").distinct().count() == 3789


def test_rows_per_province(spark):
    rows = QUERIES["coverage"](spark, "/root/testdata/sf0.01").collect()
    assert {r["province"]: r["offers"] for r in rows} == {
        "MIDDLE EAST": 16131, "AMERICA": 14801, "ASIA": 12096, "EUROPE": 9049, "AFRICA": 7923}
