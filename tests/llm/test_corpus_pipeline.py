"""The pipeline against its stages done plainly, and what a user of the entry sees."""

import hashlib
import re

import public_tokenizers
from near_copies import brute as near_brute
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tideline.llm.language import train


def test_against_plain_python(spark, sample, sample_dir):
    model = train(sample, "doc_id", "text", "lang")
    rows = {r["doc_id"]: r["text"] for r in sample.collect()}
    rows = {i: t for i, t in rows.items() if not model.classify(t)[2]}
    first = {}
    for i in sorted(rows):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i] or ""), i)
    rows = {i: rows[i] for i in first.values()}
    lead = near_brute(list(rows.items()))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    due = set()
    for i, text in rows.items():
        if lead[i] == i:
            ids = library.encode(text or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            due.add(
                (i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                 hashlib.sha256(text.encode()).hexdigest())
            )
    found = corpus_pipeline.run(spark, sample_dir).collect()
    assert {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found} == due
    assert len(found) == len(due)


def test_stages_keep_the_columns(spark, documents, sample_dir, tmp_path):
    docs = documents((1, None, "en", "a"), (2, "", None, None), (None, "x y z", "en", "b"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sample_dir)
        assert out.columns == docs.columns, name
        out.count()
        empty = stage(spark, docs.limit(0), sample_dir)
        assert empty.columns == docs.columns and empty.count() == 0, name
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_registered():
    names = queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(oracle_sql()) <= set(names)
