"""Token counts: batches of text through a public tokenizer, returning lengths only.

Each Arrow batch is worked through in slices of about ``slice_bytes`` of text, so that a slice
costs the same whatever the lengths of its rows. Texts are split where no token of a byte-level
tokenizer can span: at a single blank between two characters that are not white space. The
blank stays with what follows it. Every piece is counted by the library itself; pieces that
come again (most do) are looked up instead, in a table of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship

SLICE_BYTES = 256 << 10
KNOWN_PIECES = 800_000
PIECE_CHARS = 64

# Python's white space includes all that the tokenizers split at, so a blank between two of its
# non-space characters is one for them too.
_BLANK = re.compile(r" (?=\S)(?<=\S )")

def visible_bytes() -> dict[int, str]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others follow from U+0100 on in their order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_VISIBLE = visible_bytes()

_open: dict[str, "Counter"] = {}


class Known:
    """A table of bounded size in two generations: what was used since the last turn stays."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size // 2, {}, {}

    def get(self, key: str) -> int | None:
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key: str, value: int) -> None:
        if len(key) <= PIECE_CHARS:
            if len(self.new) >= self.size:
                self.old, self.new = self.new, {}
            self.new[key] = value


class Counter:
    """Counts tokens of texts with one tokenizer; kept by a Python worker between tasks."""

    def __init__(self, path: str):
        self.pieces = Known(KNOWN_PIECES)
        self.cut = not path.endswith(".model")
        if self.cut:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.merge = model.model.tokenize
            self.lengths = lambda texts: [
                len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)
            ]
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lengths = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]

    def word(self, piece: str) -> int | None:
        """Tokens of a blank and a Latin word, with or without one mark behind it; None for
        any other piece. Such a word is one run for the library's splitter, so its merges are
        all that is left to do, and a mark alone is one token."""
        marks = piece[-1] in ".,;:!?"
        letters = piece[:-1] if marks else piece
        if not letters.isalpha():
            return None
        if not letters.isascii():
            if max(letters) >= "\u0250":
                return None
            letters = letters.encode().decode("latin-1").translate(_VISIBLE)
        return len(self.merge(_VISIBLE[0x20] + letters)) + marks

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        if not self.cut:
            return self.lengths(texts)
        totals, firsts, others = [], [], []
        known = self.pieces
        for i, text in enumerate(texts):
            first, *rest = _BLANK.split(text)
            counts = list(map(known.new.get, rest))
            total = 0
            if None in counts:
                for piece, n in zip(rest, counts):
                    if n is None and (n := known.get(piece)) is None:
                        if (n := self.word(piece)) is None:
                            others.append((i, piece))
                            continue
                        known.put(piece, n)
                    total += n
            else:
                total = sum(counts)
            totals.append(total)
            firsts.append(first)
        # A first piece has no blank in front.
        distinct = list({piece for _, piece in others})
        found = self.lengths(firsts + [f" {piece}" for piece in distinct])
        totals = [a + b for a, b in zip(totals, found)]
        new = dict(zip(distinct, found[len(firsts) :]))
        for i, piece in others:
            totals[i] += new[piece]
        for piece, n in new.items():
            known.put(piece, n)
        return totals


def counter(path: str) -> Counter:
    if path not in _open:
        import os

        # Spark gives a task one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _open[path] = Counter(path)
    return _open[path]


def byte_slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes each; a larger row is a range itself."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``tokenizer`` is the path of a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file that
    every worker can read. Special tokens are not added; their strings inside a text count as
    the library's default has it. A NULL text is empty and has no tokens. Ids are carried as they
    are: NULL and repeated ids give a row each. Other columns are ignored, whatever their names.
    An empty table gives an empty result. Nothing is shuffled.
    """
    ship(docs.sparkSession)
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        model = counter(tokenizer)
        for batch in batches:
            texts = batch.column("text")
            sizes = [len(x.as_buffer() or b"") if x.is_valid else 0 for x in texts]
            totals: list[int] = []
            for a, b in byte_slices(sizes, slice_bytes):
                totals += model.count([x or "" for x in texts[a:b].to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()),
                    pa.array([n > limit for n in totals], pa.bool_()),
                ],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    return source.mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
