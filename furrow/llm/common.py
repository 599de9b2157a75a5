"""Helpers shared by the operators: tokens, hashes, groups of rows in a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A side of a join is broadcast only if it was counted and has no more rows.
BROADCAST_ROWS = 2_000_000
#: What is not a word of the licence and decontamination scans, as a Java pattern.
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ODD = np.uint64(0x9E3779B97F4A7C15)


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names.

    Whatever else the table holds, also under a name the operator uses inside,
    is left behind here."""
    return df.select(*[df[there].alias(here) for here, there in columns.items()])


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows at most ``rows`` rows.

    Beyond that it is returned as it is and the join shuffles; both ways give the
    same rows. ``df`` should be a written table of a few fixed-width columns."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles; a shorter text is one
    shingle, a text without words none."""
    h = word_hashes(words_of(text))
    if len(h) == 0:
        return h
    k = min(k, len(h))
    out = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        out = (out ^ (out >> np.uint64(29))) * ODD + h[i : len(h) - k + 1 + i]
    return np.unique(out ^ (out >> np.uint64(32)))


def segments(
    df: DataFrame, key: str, work: Callable[[object, pd.DataFrame], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    """``work(key, rows)`` for each group of ``key``, which must not be null.

    The groups are hash-dealt and sorted, and a task streams through its sorted
    rows holding one group at a time; callers bound the size of a group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            values = batch[key].to_numpy()
            if not len(values):
                continue
            cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and held[0][key].iloc[0] != values[a]:
                    yield from work(held[0][key].iloc[0], pd.concat(held) if len(held) > 1 else held[0])
                    held = []
                held.append(batch.iloc[a:b])
        if held:
            yield from work(held[0][key].iloc[0], pd.concat(held) if len(held) > 1 else held[0])

    return df.repartition(key).sortWithinPartitions(key).mapInPandas(run, schema)


def native_words(text: Column) -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text as an
    array of strings, made by built-in functions; null and empty texts have none.

    ``lower`` also folds letters beyond ASCII. That never moves a word boundary."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_ALNUM)
    lead = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return F.slice(parts, lead + 1, F.greatest(F.size(parts) - lead - tail, F.lit(0)))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For the nodes 0..n-1 and the links a-b: the smallest node each one reaches."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    return label

