import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tideline.llm import tokens
from tideline.llm.tokens import byte_slices, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "a  b", "a \nb", " a\n\n b ", "x <|endoftext|> y", "é  b", "a\x1c b", "  a b  ",
    "don't 've  're\t\tx", "a\r\n b", "日本 語 １２", "👍 👍🏽 a", "x.\ny, z;\n\nw", "Ünïcode wörd, ok.",
    "no-blank" * 4000, "  a  b", "THE!! of### a*** 1,000.5",
]


@pytest.mark.parametrize("slice_bytes", [1, 1000, tokens.SLICE_BYTES])
def test_against_library(documents, sample, slice_bytes):
    library = Tokenizer.from_file(PATH)
    texts = ODD + [r["text"] for r in sample.collect()]
    df = documents(*enumerate(texts), more="n_tokens string, id string")
    rows = count_tokens(df, PATH, slice_bytes=slice_bytes).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), n), text[:80]
        assert r["over_limit"] == (n > 1024)


def test_pieces_model(documents):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    df = documents(*enumerate(ODD))
    for r in count_tokens(df, path).collect():
        assert r["n_tokens"] == len(library.encode(ODD[r["doc_id"]] or ""))


def test_edges(documents):
    rows = count_tokens(documents((None, "a b"), (None, "a b"), (1, "c"), (1, None)), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in rows) == [(0, 2), (0, 2), (1, 0), (1, 1)]
    assert count_tokens(documents(), PATH).count() == 0


def test_byte_slices():
    assert list(byte_slices([], 5)) == []
    assert list(byte_slices([9, 1, 2, 3, 9, 0], 5)) == [(0, 1), (1, 3), (3, 4), (4, 5), (5, 6)]


def test_table_forgets(monkeypatch):
    known = tokens.Known(4)
    for i in range(10):
        known.put(str(i), i)
    assert known.get("9") == 9 and known.get("0") is None
    assert len(known.new) + len(known.old) <= 4
