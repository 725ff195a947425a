import zlib

import pyarrow as pa

from tideline.llm.language import (
    SLICE_BYTES, accepted, drop_rejected, fit, identify_languages, ngram_counts,
)

SAMPLES = {
    "en": "the quick brown fox jumps over the lazy dog while the children are watching it run",
    "de": "der schnelle braune fuchs springt über den faulen hund und die kinder schauen zu",
}


def many(count=40):
    rows = []
    for i in range(count):
        lang = "en" if i % 2 else "de"
        words = SAMPLES[lang].split()
        k = i % len(words)
        rows.append((i, " ".join(words[k:] + words[:k]) * 3, lang, "s"))
    return rows


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 4 == 2


def test_held_out_accuracy(spark, sample_dir):
    folder = sample_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)


def test_label_of_held_out_rows_is_not_learned(documents):
    rows = [
        (i, t, "xx" if is_held_out(i) else lang, s) for i, t, lang, s in many()
    ]
    found = identify_languages(documents(*rows)).collect()
    assert {r["lang_pred"] for r in found} == {"en", "de"}


def test_rejects(documents):
    far = "щука жёлтый эхо цифра объём юный " * 30
    rows = many() + [(900, None), (901, ""), (902, "12 34 !?"), (903, far), (904, "the dog")]
    df = documents(*rows, more="id string, score string, label string")
    found = {r["doc_id"]: r for r in identify_languages(df).collect()}
    for i in (900, 901, 902):
        assert (found[i]["lang_pred"], found[i]["score"], found[i]["rejected"]) == ("und", 0.0, True)
    assert found[903]["rejected"] and found[903]["lang_pred"] in SAMPLES
    assert not found[904]["rejected"] and found[904]["lang_pred"] == "en"
    assert not any(found[i]["rejected"] for i in range(40))
    kept = drop_rejected(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {*range(40), 904}


def test_edges(documents):
    assert identify_languages(documents()).count() == 0
    assert drop_rejected(documents()).count() == 0
    alone = identify_languages(documents((1, "no label"), (None, "x"), (None, "x"))).collect()
    assert [(r["lang_pred"], r["rejected"]) for r in alone] == [("und", True)] * 3
    twice = identify_languages(documents(*many(), *many(), (None, SAMPLES["en"], "en", "s")))
    assert twice.count() == 81


def test_long_text(documents):
    rows = many() + [(99, SAMPLES["de"] * 5000)]
    found = {r["doc_id"]: r for r in identify_languages(documents(*rows)).collect()}
    assert found[99]["lang_pred"] == "de" and not found[99]["rejected"]


def test_large_batches_come_back_in_parts():
    model = fit({k: [ngram_counts(v)] for k, v in SAMPLES.items()})
    text = SAMPLES["en"] * (SLICE_BYTES // 2 // len(SAMPLES["en"]))
    texts = [text, text, None, text, "12", "", text, text]
    batch = pa.record_batch({"doc_id": pa.array(range(8)), "text": pa.array(texts, pa.string())})
    found = list(accepted([batch, batch.slice(0, 0), batch.slice(4)], model, 1))
    assert [i for x in found for i in x.column(0).to_pylist()] == [0, 1, 3, 6, 7, 6, 7]
    assert all(x.nbytes <= SLICE_BYTES + 1000 for x in found)
