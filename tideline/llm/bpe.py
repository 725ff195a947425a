"""Byte-pair encoding as a streaming transducer with bounded lookahead, and its decoding.

Encoding. A sequence of tokens is the encoding of its text exactly when every two neighbours
encode to themselves, so the token that ends at a position depends only on the position it
starts from, and the last token of every prefix is unique. The transducer therefore reads
symbols from the left and keeps, per position, the token that ends there. A later token starts
at most one longest token back: that length, taken from the merge list, is the lookahead.
Whatever all paths from the positions inside it agree on is stable and leaves the transducer,
so its memory doesn't grow with the text.

Text reaches it through the tokenizer file's own steps: special strings are cut out, then NFC,
lower case, and the split into words, digits and marks. None of these looks across ASCII white
space, so texts are taken run by run, and the ids of runs met before are looked up.

Decoding is a state machine too: bytes of a token that don't end a character yet wait for the
next token.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import give_back, ship
from .tokens import byte_slices, visible_bytes
from .words import utf8

#: Bytes of text or ids that are worked on at once.
SLICE_BYTES = 4 << 20
#: What a Python worker keeps of earlier texts. A run costs most memory and is found again least
#: often; its words are. All tables together take about 50 MB.
KNOWN_RUNS = 60_000
KNOWN_WORDS = 300_000
KNOWN_PAIRS = 150_000
RUN_BYTES = 64

#: Lengths of tokens that are tried at every place.
FEW = (2, 1)
#: Letters that NFC leaves alone and that lower case maps to one letter, as ranges of a pattern,
#: and their lower case. ASCII and these need no table of Unicode.
LATIN = "À-ÖØ-öø-įı-ſ"
LATIN_LOWER = "a-zß-öø-ſ"

_open: dict[str, "Codec"] = {}


class Merges:
    """The merge list: which tokens there are, what they are made of, and which may follow."""

    def __init__(self, merges: Iterable[tuple[str, str]], symbols: Iterable[str]):
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.parts = {s: (s,) for s in symbols}
        self.made: dict[str, tuple[str, str]] = {}
        for a, b in self.rank:
            self.parts.setdefault(a + b, self.parts[a] + self.parts[b])
            self.made.setdefault(a + b, (a, b))
        #: Symbols that must follow a position before nothing more can reach back over it.
        self.lookahead = max(map(len, self.parts.values()))
        #: The lengths of tokens of three symbols or more that don't end a word, the longest
        #: first and with the shorter ones behind, by their first three symbols.
        lengths: dict[str, set[int]] = {}
        for token, parts in self.parts.items():
            if len(token) == len(parts) > 2:
                lengths.setdefault(token[:3], set()).add(len(parts))
        self.lengths = {
            start: (*sorted(found, reverse=True), *FEW) for start, found in lengths.items()
        }
        self.pairs: dict[tuple[str | None, str], bool] = {}
        # Pairs are kept of these strings, not of the slices of texts that they were met as.
        self._same = {token: token for token in self.parts}
        self._edges: tuple[dict, dict] = ({}, {})

    def apply(self, symbols: Iterable[str]) -> list[str]:
        """The plain algorithm: the lowest pair is merged, the leftmost first."""
        found = list(symbols)
        while len(found) > 1:
            best, at = min(
                (self.rank.get(pair, len(self.rank)), i)
                for i, pair in enumerate(zip(found, found[1:]))
            )
            if best == len(self.rank):
                break
            found[at : at + 2] = [found[at] + found[at + 1]]
        return found

    def edge(self, token: str, right: bool) -> list[tuple[str, int]]:
        """What stands at one edge of ``token`` while it is built, each with the rank of the
        merge that takes it in; the token itself is never taken in."""
        known = self._edges[right]
        if token not in known:
            steps, until = [], len(self.rank)
            part = token
            while True:
                steps.append((part, until))
                if part not in self.made:
                    break
                until, part = self.rank[self.made[part]], self.made[part][right]
            known[token] = steps
        return known[token]

    def fits(self, before: str | None, token: str) -> bool:
        """Whether ``token`` may stand behind ``before``, or at the start of a word.

        Merges happen in the order of their ranks. So a merge across the border happens if it
        comes before the merges that take in its two parts; at equal rank the left one is first.
        """
        if before is None:
            fits = self.apply(self.parts[token]) == [token]
        else:
            rank, never = self.rank, len(self.rank)
            fits = self.fits(None, token) and not any(
                (at := rank.get((a, b), never)) < until_a and at <= until_b and at < never
                for a, until_a in self.edge(before, True)
                for b, until_b in self.edge(token, False)
            )
        if len(self.pairs) >= KNOWN_PAIRS:
            self.pairs.clear()
        self.pairs[self._same.get(before), self._same[token]] = fits
        return fits

    def short(self, symbols: str, suffix: str) -> list[str]:
        """Tokens of a word that the lookahead covers whole, the longest fitting one first.

        There is only one way to any position on which all neighbours fit, so no position is
        come to twice.
        """
        parts, pairs, lengths = self.parts, self.pairs, self.lengths.get
        path: list[str] = []
        turns: list[Iterator[int]] = []  # for each token of the path, the lengths not tried yet
        before, at, end = None, 0, len(symbols)
        while True:
            token = symbols[at:] + suffix
            if token in parts:
                fit = pairs.get((before, token))
                if fit or fit is None and self.fits(before, token):
                    path.append(token)
                    return path
            sizes = iter(lengths(symbols[at : at + 3], FEW))
            while True:
                for size in sizes:
                    token = symbols[at : at + size]
                    if at + size < end and token in parts:
                        fit = pairs.get((before, token))
                        if fit or fit is None and self.fits(before, token):
                            break
                else:
                    if not path:
                        raise ValueError(f"no tokens make {symbols!r}")
                    at -= len(path.pop())
                    sizes = turns.pop()
                    before = path[-1] if path else None
                    continue
                break
            path.append(token)
            turns.append(sizes)
            before, at = token, at + size


class Transducer:
    """Reads the symbols of one word in pieces of any size and gives tokens once stable."""

    def __init__(self, merges: Merges, suffix: str):
        self.merges, self.suffix = merges, suffix
        self.held = ""  # the last symbol read; it may end the word
        self.text = ""  # symbols since the last stable position
        self.last: list[str | None] = [None]  # the token that ends at each of these positions

    def feed(self, symbols: str, final: bool = False) -> list[str]:
        symbols = self.held + symbols
        self.held = "" if final else symbols[-1:]
        body = symbols if final else symbols[:-1]
        stable: list[str] = []
        step = 4 * self.merges.lookahead
        for at in range(0, len(body), step):
            part = body[at : at + step]
            self._read(part, final and at + step >= len(body))
            if at + step < len(body) or not final:
                stable += self._settle()
        if final:
            stable += self._path(len(self.text))
        return stable

    def _read(self, part: str, final: bool) -> None:
        parts, fits, reach = self.merges.parts, self.merges.fits, self.merges.lookahead
        pairs = self.merges.pairs
        start = len(self.text)
        self.text = text = self.text + part
        last = self.last
        for end in range(start + 1, len(text) + 1):
            tail = self.suffix if final and end == len(text) else ""
            for begin in range(max(0, end - reach), end):
                token = text[begin:end] + tail
                if token in parts:
                    fit = pairs.get((last[begin], token))
                    if fit or fit is None and fits(last[begin], token):
                        last.append(token)
                        break
            else:
                raise ValueError(f"no token ends with the symbol {text[end - 1]!r}")

    def _path(self, end: int) -> list[str]:
        found = []
        while end > 0:
            token = self.last[end]
            found.append(token)
            end -= len(self.merges.parts[token])
        return found[::-1]

    def _settle(self) -> list[str]:
        """Tokens on which the paths from all positions still in reach agree."""
        live = set(range(max(0, len(self.text) - self.merges.lookahead), len(self.text) + 1))
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(top - len(self.merges.parts[self.last[top]]))
        meet = live.pop()
        stable = self._path(meet)
        self.text, self.last = self.text[meet:], self.last[meet:]
        return stable


class Codec:
    """A tokenizer file of this kind, ready to encode and decode; kept between tasks."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.table = visible_bytes()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        bases = [*self.table.values(), *(c + self.suffix for c in self.table.values())]
        self.merges = Merges(merges, bases)
        # Which characters are letters is for the library to say; on Latin ones it's plain.
        bare = {"vocab": {}, "merges": []}
        library = Tokenizer.from_str(
            json.dumps({**spec, "model": {**model, **bare}, "added_tokens": [],
                        "post_processor": None, "decoder": None})
        )
        self.normal = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        plain = split.replace(r"\p{L}", LATIN_LOWER).replace(r"\p{N}", "0-9")
        self.plain_words = re.compile(plain, re.ASCII).findall
        self.is_plain = re.compile(f"[\\x00-\\x7f{LATIN}]*").fullmatch
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.packed = {t: np.int32(i).tobytes() for t, i in self.ids.items()}
        self.runs: dict[bytes, bytes] = {}
        self.old_runs: dict[bytes, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.old_known: dict[str, bytes] = {}
        self.spell = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        bytes_of = {c: b for b, c in self.table.items()}
        self.raw = {
            i: bytes(bytes_of[c] for c in t.removesuffix(self.suffix))
            + (b" " if self.suffix and t.endswith(self.suffix) else b"")
            for t, i in self.ids.items()
        } | {i: t.encode() for t, i in self.special.items()}

    def word(self, word: str, mapped: bool = False) -> bytes:
        """Ids of one word of the split, as 32-bit integers; ``mapped`` if its bytes are
        written as visible characters already."""
        symbols = word
        if not mapped and not (word.isascii() and word.isprintable()):
            symbols = word.encode().decode("latin-1").translate(self.table)
        found = self.known.get(symbols)
        if found is not None:
            return found
        found = self.old_known.get(symbols)
        if found is None:
            if len(symbols) <= self.merges.lookahead:
                tokens = self.merges.short(symbols, self.suffix)
            else:
                tokens = Transducer(self.merges, self.suffix).feed(symbols, final=True)
            found = b"".join(map(self.packed.__getitem__, tokens))
        if len(symbols) <= RUN_BYTES:
            if len(self.known) >= KNOWN_WORDS // 2:
                self.old_known, self.known = self.known, {}
            self.known[symbols] = found
        return found

    def run(self, run: bytes) -> bytes:
        """Ids of a run without ASCII white space."""
        found = self.old_runs.get(run)
        if found is None:
            text = run.decode()
            if "<|" not in text and (text.isascii() or self.is_plain(text)):
                found = b"".join(map(self.word, self.plain_words(text.lower())))
            else:
                found = b"".join(self._parts(text))
        if len(run) <= RUN_BYTES:
            if len(self.runs) >= KNOWN_RUNS // 2:
                self.old_runs, self.runs = self.runs, {}
            self.runs[run] = found
        return found

    def _parts(self, text: str) -> Iterator[bytes]:
        for part in self.cut(text):
            if part in self.special:
                yield np.int32(self.special[part]).tobytes()
            else:
                for word, _ in self.split(self.normal(part)):
                    yield self.word(word, mapped=True)

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text, as 32-bit integers."""
        get = self.runs.get
        return b"".join([get(x) or self.run(x) for x in text.split()])

    def decode(self, ids: list[int]) -> str:
        """The tokens as they are spelled, a blank between each: what the library returns for a
        file that names no decoder."""
        return " ".join(map(self.spell.__getitem__, ids))

    def text(self, ids: list[int]) -> str:
        """Readable text: bytes back, ends of words as blanks."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        parts = [machine.decode(self.raw[i]) for i in ids]
        return "".join([*parts, machine.decode(b"", final=True)])


def codec(path: str) -> Codec:
    if path not in _open:
        _open[path] = Codec(path)
    return _open[path]


def bpe_encode(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its id and ``ids``, the tokens of its whole text.

    ``tokenizer`` is the path of a tokenizer file that every worker can read. A NULL text is an
    empty one and has no tokens. Ids of rows are carried as they are, so NULL and repeated ones
    give a row each. Other columns are ignored, whatever their names. An empty table gives an
    empty result. Nothing is shuffled.
    """
    ship(docs.sparkSession)
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        model = codec(tokenizer)
        for batch in batches:
            texts = batch.column("text")
            sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in texts]
            for a, b in byte_slices(sizes, SLICE_BYTES):
                found = [model.encode(utf8(x)) for x in texts[a:b]]
                ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
                ids = pa.Array.from_buffers(
                    pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(found))]
                )
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[a:b], lists], names=[id_col, "ids"]
                )
                del found, ids, lists
                give_back()

    return source.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def bpe_decode(
    encoded: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    ids_col: str = "ids",
    readable: bool = False,
) -> DataFrame:
    """One row per row of ``encoded``: its id, ``ids`` and ``decoded``.

    ``decoded`` is what the library's ``decode(ids, skip_special_tokens=False)`` returns;
    with ``readable`` it is text again, by the incremental byte machine. NULL ids decode to an
    empty text, as an empty list does.
    """
    ship(encoded.sparkSession)
    source = encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        model = codec(tokenizer)
        back = model.text if readable else model.decode
        for batch in batches:
            lists = batch.column("ids")
            sizes = [4 * (n or 0) for n in lists.value_lengths().to_pylist()]
            for a, b in byte_slices(sizes, SLICE_BYTES):
                texts = [
                    back(x.values.to_numpy().tolist()) if x.is_valid else "" for x in lists[a:b]
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[a:b], lists[a:b], pa.array(texts, pa.string())],
                    names=[id_col, "ids", "decoded"],
                )
                give_back()

    return source.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")


def bpe_round_trip(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``bpe_encode`` and ``bpe_decode`` in one pass: id, ``ids`` and ``decoded`` of every row.

    One Python worker a task does both, so an executor holds half as many tables of tokens.
    """
    ship(docs.sparkSession)
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        model = codec(tokenizer)
        for batch in batches:
            texts = batch.column("text")
            sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in texts]
            for a, b in byte_slices(sizes, SLICE_BYTES):
                found = [np.frombuffer(model.encode(utf8(x)), np.int32) for x in texts[a:b]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id")[a:b], pa.array(found, pa.list_(pa.int32())),
                        pa.array([model.decode(x.tolist()) for x in found], pa.string()),
                    ],
                    names=[id_col, "ids", "decoded"],
                )
                del found
                give_back()

    return source.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")
