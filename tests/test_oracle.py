"""Every registered query against its SQL, on whole results."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from compare import connect, difference  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402


@pytest.fixture(scope="module")
def database(sample_dir):
    return connect(sample_dir)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, sample_dir, database, name):
    found = difference(queries()[name](spark, sample_dir), database, oracle_sql()[name])
    assert found is None, found


def test_pending_files(spark, sample_dir):
    import hashlib

    found = {r["path"].removeprefix("file:"): (r["size"], r["checksum"])
             for r in queries()["pending_files"](spark, sample_dir).collect()}
    for path in Path(sample_dir).glob("*.parquet"):
        content = path.read_bytes()
        assert found[str(path)] == (len(content), hashlib.sha256(content).hexdigest())


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
