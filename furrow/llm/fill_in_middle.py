"""Fill-in-middle by a piece table.

A document is a list of descriptors (buffer, start, length) over two buffers that never
change: its text and the string of the three marks. Cutting splits a descriptor, putting
marks in adds descriptors, and an arrangement permutes the three marked parts. No text
is copied until the descriptors are read off, and the hash reads them one by one.

    parts     <P>prefix   <M>middle   <S>suffix
    psm       <P>prefix   <S>suffix   <M>middle
    spm       <S>suffix   <P>prefix   <M>middle

The way back reads the marks of an output into descriptors over the output itself,
applies the inverse permutation and leaves the marks out. A text that holds a mark is
left as it is, so every mark of an arranged output is one that was put in.

The work is per document, so there is no shuffle, and the rows of a batch are given on
in slices of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import code_points, narrow

MARKS = ("<P>", "<M>", "<S>")
#: The order of the marked parts (prefix, middle, suffix) in the output of a form.
ARRANGEMENTS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
#: Buffers of a descriptor.
TEXT, MARK = 0, 1
#: Characters of output that are given on at once.
SLICE_CHARS = 4_000_000


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


class PieceTable:
    """Descriptors over a text (or an output) and the marks."""

    def __init__(self, text: str):
        self.buffers = (text, "".join(MARKS))
        self.pieces = [Piece(TEXT, 0, len(text))]

    def cut(self, offset: int) -> None:
        """Splits the descriptor that holds ``offset`` of the sequence; the left part may
        be empty, so that ``k`` cuts of one descriptor always leave ``k + 1``."""
        before = 0
        for i, p in enumerate(self.pieces):
            if offset <= before + p.length and (offset < before + p.length or i == len(self.pieces) - 1):
                left = offset - before
                self.pieces[i : i + 1] = [Piece(p.buffer, p.start, left), Piece(p.buffer, p.start + left, p.length - left)]
                return
            before += p.length
        raise ValueError("the cut lies outside of the text")

    def mark(self) -> None:
        """Puts each mark before its part."""
        marks = [Piece(MARK, sum(map(len, MARKS[:i])), len(m)) for i, m in enumerate(MARKS)]
        self.pieces = [p for pair in zip(marks, self.pieces, strict=True) for p in pair]

    def arrange(self, order: tuple[int, ...]) -> None:
        """Permutes the marked parts, two descriptors each."""
        self.pieces = [p for i in order for p in self.pieces[2 * i : 2 * i + 2]]

    def stream(self) -> Iterator[str]:
        for buffer, start, length in self.pieces:
            yield self.buffers[buffer][start : start + length]

    def read(self) -> str:
        return "".join(self.stream())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part.encode("utf-8", "surrogatepass"))
        return digest.hexdigest()


def inverse(order: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(sorted(range(len(order)), key=order.__getitem__))


def token_ends(text: str) -> np.ndarray:
    """The ends of the tokens ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``: where a
    word stops, and the end of the text."""
    points = code_points(text)
    if not len(points):
        return np.empty(0, dtype=np.int64)
    space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    return np.append(np.flatnonzero(~space[:-1] & space[1:]) + 1, len(points))


def choose(seed: str, id_: object, n: int, plain_free: bool, share: int, spm_share: int) -> tuple[str, int, int]:
    """Form and the two places of the cuts, in tokens, from the seed and the id alone."""
    digest = hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not plain_free or h[2] % 100 >= share:
        return "plain", 0, 0
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return ("spm" if h[3] % 100 < spm_share else "psm"), a, b


def arranged(text: str, id_: object, seed: str, share: int, spm_share: int) -> tuple[int, str, PieceTable, tuple[int, int] | None]:
    """Number of tokens, form, descriptors, and the characters of prefix and middle."""
    ends, table = token_ends(text), PieceTable(text)
    form, a, b = choose(seed, id_, len(ends), text != "" and not any(m in text for m in MARKS), share, spm_share)
    if form == "plain":
        return len(ends), form, table, None
    first, last = (int(ends[i - 1]) if i else 0 for i in (a, b))
    table.cut(first)
    table.cut(last)
    table.mark()
    table.arrange(ARRANGEMENTS[form])
    return len(ends), form, table, (first, last - first)


def taken_apart(output: str, form: str) -> PieceTable:
    """The descriptors of the text over an output: marks found, inverse order, marks left out."""
    table = PieceTable(output)
    if form != "plain":
        order = ARRANGEMENTS[form]
        starts = [output.index(MARKS[i]) for i in order]
        stops = [*starts[1:], len(output)]
        parts = [Piece(TEXT, s + len(MARKS[i]), e - s - len(MARKS[i])) for i, s, e in zip(order, starts, stops, strict=True)]
        table.pieces = [parts[i] for i in inverse(order)]
    return table


SHAPE = (
    "id long, n long, form string, prefix_chars long, middle_chars long, "
    "pieces array<struct<buffer: int, start: int, length: int>>, output string, output_sha256 string"
)


def transform(
    docs: DataFrame, seed: str = "42", share: int = 50, spm_share: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id``, tokens ``n``, ``form`` (plain, psm, spm), characters of
    prefix and middle (null if plain), ``pieces`` (descriptors over the text, buffer 0, and
    the marks ``<P><M><S>``, buffer 1), ``output`` and its ``output_sha256``.

    ``share`` % of the documents are arranged, ``spm_share`` % of these suffix first. A null
    text counts as empty; empty texts and texts that hold a mark stay plain. A null id
    draws like the empty string; rows that share an id draw alike, and each gives a row.
    Very long texts are cut whole. An empty table gives an empty one. Other columns are
    left behind, whatever they are called.
    """
    columns = [c.split()[0] for c in SHAPE.replace("struct<buffer: int, start: int, length: int>", "struct").split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, chars = [], 0
            for id_, text in zip(batch["id"], batch["text"], strict=True):
                n, form, table, cuts = arranged(text, id_, seed, share, spm_share)
                output = table.read()
                # The id travels as text, so that a null does not turn the others into floats.
                key = None if id_ is None else int(id_)
                rows.append((key, n, form, *(cuts or (None, None)), [p._asdict() for p in table.pieces], output, table.sha256()))
                chars += len(output)
                if chars > SLICE_CHARS:
                    yield _frame(rows, columns)
                    rows, chars = [], 0
            yield _frame(rows, columns)

    base = narrow(docs, id=id_col, text=text_col).select(F.col("id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    return base.mapInPandas(run, SHAPE)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=columns)
    for c in ("id", "prefix_chars", "middle_chars"):
        out[c] = out[c].astype("Int64")
    return out


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of; null for a null output or form."""

    @F.pandas_udf("string")
    def back(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([None if o is None or f is None else taken_apart(o, f).read() for o, f in zip(outputs, forms, strict=True)])

    return back(output, form)


def restored_sha256(output: Column, form: Column) -> Column:
    """The hash of the restored text, read off the descriptors; null for null."""

    @F.pandas_udf("string")
    def digest(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([None if o is None or f is None else taken_apart(o, f).sha256() for o, f in zip(outputs, forms, strict=True)])

    return digest(output, form)
