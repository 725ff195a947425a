import pytest

FIELDS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(*rows, more=""):
        full = [(*r, *[None] * (5 - len(r)))[:5] for r in rows]
        if not more:
            return spark.createDataFrame(full, FIELDS)
        names = [x.split()[0] for x in more.split(", ")]
        return spark.createDataFrame(
            [(*r, *["clash"] * len(names)) for r in full], f"{FIELDS}, {more}"
        )

    return make


@pytest.fixture(scope="session")
def sample(spark, sample_dir):
    """Whole rows of the smallest documents table."""
    return spark.read.parquet(f"{sample_dir}/documents.parquet")
