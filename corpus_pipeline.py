"""From documents to token ids: languages, exact and near copies, mixture, byte pairs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.bpe import bpe_round_trip
from tideline.llm.exact import keep_first
from tideline.llm.jaccard import one_of_each
from tideline.llm.language import drop_rejected
from tideline.llm.mixing import mixed
from tideline.llm.queries import MIXTURE, MIXTURE_BLOCK, MIXTURE_OTHER, tokenizer_file
from tideline.session import scratch_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is close enough to a known language."""
    return drop_rejected(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture of their sources."""
    return mixed(docs, MIXTURE, MIXTURE_OTHER, MIXTURE_BLOCK)


def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and digests of them and of what they decode to."""
    return bpe_round_trip(docs, tokenizer_file("word_bpe_49k.json")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )


STAGES = [
    ("language_id", language_id),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("byte_pairs", byte_pairs),
]

#: Neither the language model nor the merges can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each writes Parquet that the next one reads."""
    folder = f"{scratch_dir(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
