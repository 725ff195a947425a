import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tideline.llm.bpe import Codec, Transducer, bpe_decode, bpe_encode, bpe_round_trip, codec

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def due(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def random_texts(seed, count=300):
    rnd = random.Random(seed)
    alphabets = ["ab", "aeioust'.- ", "éèáöΣσςİıß ", "日本語👍🏽x1 ", "the tion and ing", "0123 #$%"]
    for _ in range(count):
        text = "".join(rnd.choices(rnd.choice(alphabets), k=rnd.choice([1, 5, 40, 300])))
        yield text + rnd.choice(["", "<|endoftext|>", " <|startoftext|>x", "\x1c \xa0 y"])


def test_against_library(spark, documents, sample):
    texts = [r["text"] for r in sample.collect()] + list(random_texts(1))
    texts += [None, "", " \n", "Á é", "don't 've'll"]
    df = documents(*enumerate(texts), more="ids string, decoded string, id string")
    for found in (bpe_decode(bpe_encode(df, PATH), PATH), bpe_round_trip(df, PATH)):
        rows = found.collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert (r["ids"], r["decoded"]) == due(texts[r["doc_id"]])


def test_long_word_streams():
    rnd = random.Random(2)
    merges = codec(PATH).merges
    for alphabet in ("abcdeinrst", "a", "th"):
        word = "".join(rnd.choices(alphabet, k=5000))
        machine, out, held = Transducer(merges, "</w>"), [], 0
        at = 0
        while at < len(word):
            n = rnd.randrange(1, 400)
            out += machine.feed(word[at : at + n], final=at + n >= len(word))
            held = max(held, len(machine.text))
            at += n
        assert [codec(PATH).ids[t] for t in out] == due(word)[0]
        assert held < 1000  # bounded by the pieces and the lookahead, not by the word


def test_short_is_the_plain_algorithm():
    rnd = random.Random(3)
    merges = codec(PATH).merges
    for _ in range(500):
        word = "".join(rnd.choices("aeinrsthoul", k=rnd.randrange(1, 20)))
        assert merges.short(word, "</w>") == merges.apply([*word[:-1], word[-1] + "</w>"])


def test_every_character_of_the_plain_path():
    known = codec(PATH)
    letters = [chr(c) for c in [*range(0x21, 0x7F), *range(0xA0, 0x250), 0x300, 0x301, 0x327]]
    for x in letters:
        for text in (x, f"A{x}b", f"'{x}s1{x}", f"{x}{x.upper()}é", f"e{x}\u0301 {x}"):
            ids = np.frombuffer(known.encode(text.encode()), np.int32).tolist()
            assert (ids, known.decode(ids)) == due(text)


def test_readable(documents):
    df = documents((1, "Héllo  WORLD 👍"), (2, None))
    rows = bpe_decode(bpe_encode(df, PATH), PATH, readable=True).collect()
    assert {r["doc_id"]: r["decoded"] for r in rows} == {1: "héllo world 👍 ", 2: ""}


def test_edges(documents):
    df = documents((None, "a"), (None, "a"), (3, "b"), (3, "b"))
    assert bpe_encode(df, PATH).count() == 4
    assert bpe_encode(documents(), PATH).count() == 0
    assert bpe_round_trip(df, PATH).count() == 4
    assert bpe_round_trip(documents(), PATH).count() == 0
    with pytest.raises(ValueError):
        codec(PATH).merges.short("一", "")


def test_little_is_kept_of_many_runs():
    model = Codec(PATH)
    words = [a + b for a in "abcdefghijklmnopqrst" for b in "aeioubcdfghklmnprstw"]
    for word in words:
        model.run(word.encode())
    tracemalloc.start()
    for one in words:
        for two in words:
            model.run(f"{one}-{two}".encode())
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 15 << 20
