"""Repeated passages by a sparse suffix array.

Of all suffixes of all texts only those are kept that start at a minimiser: the place
of the smallest hash of ``GRAM`` words among ``window`` neighbouring places. The
places are chosen by content, so two copies of a passage keep the same suffixes, and
every passage of ``least_words`` words has one that starts in its first ``window``
places and so goes on for at least ``least_words - window + 1`` words inside it.

1. The kept suffixes are range-shuffled and sorted by the hash of these next words; a
   suffix that equals neither neighbour cannot lie in a repeated passage.
2. From the others the match is extended left, word by word up to ``window - 1``, and
   right to ``least_words``: each extension is a whole window of ``least_words``
   words. The windows are sorted in turn, and equal neighbours from different
   documents (or, if asked for, from one) are repeats.
3. The repeated windows of a text are merged into spans.

Sorting by (hash, document, place) cuts a very frequent passage into many tasks. A run
of equal hashes that crosses tasks is settled from one summary per end of a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import broadcast_if_small, narrow, word_hashes, words_of
from furrow.session import settle

GRAM = 8


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)


class Rolling:
    """Hashes of any stretch of words from sums of powers; all arithmetic modulo 2**64."""

    def __init__(self, text: str | None):
        h = word_hashes(words_of(text))
        self.n = len(h)
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(h * _powers(BASE, self.n), dtype=np.uint64)])
        self.back = _powers(BACK, self.n + 1)

    def hashes(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Of the stretches of ``length`` words at ``starts``, all of which fit."""
        out = (self.sums[starts + length] - self.sums[starts]) * self.back[starts]
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(29))

    def minimisers(self, window: int) -> np.ndarray:
        """The places that hold the smallest hash of some ``window`` neighbouring places,
        the last one of equals."""
        places = self.n - GRAM + 1
        if places < window:
            return np.empty(0, dtype=np.int64)
        view = np.lib.stride_tricks.sliding_window_view(self.hashes(np.arange(places), GRAM)[::-1], window)
        return np.unique(places - 1 - (np.arange(len(view)) + view.argmin(axis=1)))


def _suffixes(window: int, key_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, places = [], []
            for text in batch["text"]:
                r = Rolling(text)
                at = r.minimisers(window)
                at = at[at + key_words <= r.n]
                keys.append(r.hashes(at, key_words).view(np.int64))
                places.append(at.astype(np.int32))
            yield pd.DataFrame({"id": batch["id"].to_numpy(), "keys": keys, "places": places})

    return run


def _windows(window: int, least_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, places = [], []
            for text, at in zip(batch["text"], batch["at"], strict=True):
                r = Rolling(text)
                starts = np.unique((np.asarray(at)[:, None] - np.arange(window)[None, :]).ravel())
                starts = starts[(starts >= 0) & (starts + least_words <= r.n)]
                keys.append(r.hashes(starts, least_words).view(np.int64))
                places.append(starts.astype(np.int32))
            yield pd.DataFrame({"id": batch["id"].to_numpy(), "keys": keys, "places": places})

    return run


def _beside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of sorted rows those with the key of the row before or after. The first and the last
    row of a task stay, as their neighbours may be elsewhere; a later step decides."""
    held: pd.DataFrame | None = None
    same_before = True
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch])
        if len(rows) < 2:
            held = rows
            continue
        key = rows["key"].to_numpy()
        equal = key[1:] == key[:-1]
        keep = np.concatenate([[same_before], equal]) | np.concatenate([equal, [False]])
        yield rows.iloc[:-1][keep[:-1]]
        held, same_before = rows.iloc[-1:], bool(equal[-1])
    if held is not None:
        yield held


JUDGED = "id long, key long, place int, open boolean, high long, n long"


class _Run:
    """The run of equal keys in hand: its ids and number, and its rows until it repeats."""

    def __init__(self, rows: pd.DataFrame, first: bool):
        self.key, self.low, self.first = rows["key"].iloc[0], rows["id"].iloc[0], first
        self.high, self.n, self.held = self.low, 0, []

    def add(self, rows: pd.DataFrame, within: bool) -> Iterator[pd.DataFrame]:
        """Takes further rows; gives on all rows there are once the run is known to repeat."""
        self.high, self.n = rows["id"].iloc[-1], self.n + len(rows)
        self.held.append(rows)
        if self.repeats(within):
            yield from (r.assign(open=False, high=pd.NA, n=pd.NA) for r in self.held)
            self.held = []

    def repeats(self, within: bool) -> bool:
        return self.low != self.high or (within and self.n > 1)

    def close(self, last: bool) -> Iterator[pd.DataFrame]:
        """At an end of the task: the rows left, open, and one row that sums the run up."""
        if self.first or last:
            yield from (r.assign(open=True, high=pd.NA, n=pd.NA) for r in self.held)
            yield pd.DataFrame({"id": [self.low], "key": [self.key], "place": [-1], "open": [True], "high": [self.high], "n": [self.n]})


def _runs(within: bool):
    """Of rows sorted by key and id those of a run that repeats. The first and the last run
    of a task may go on in other tasks: each is summed up in one row (place -1: key, least
    and greatest id, number), and its rows are open if they do not repeat here."""

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run: _Run | None = None
        for batch in batches:
            key, ids = batch["key"].to_numpy(), batch["id"].to_numpy()
            if not len(key):
                continue
            starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
            ends = np.append(starts[1:], len(key))
            head = batch.iloc[: ends[0]]
            if run is None:
                run = _Run(head, first=True)
            elif run.key != key[0]:
                yield from run.close(last=False)
                run = _Run(head, first=False)
            yield from run.add(head, within)
            if len(starts) == 1:
                continue
            yield from run.close(last=False)
            s, e = starts[1:-1], ends[1:-1]
            repeats = (ids[s] != ids[e - 1]) | (within & (e - s > 1))
            inner = batch.iloc[ends[0] : starts[-1]][np.repeat(repeats, e - s)]
            if len(inner):
                yield inner.assign(open=False, high=pd.NA, n=pd.NA)
            run = _Run(batch.iloc[starts[-1] :], first=False)
            yield from run.add(batch.iloc[starts[-1] :], within)
        if run is not None:
            yield from run.close(last=True)

    def typed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in judged(batches):
            yield rows.astype({"high": "Int64", "n": "Int64"})

    return typed


def repeated_passages(
    docs: DataFrame,
    least_words: int = 50,
    window: int = 18,
    within: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per span of a text of which every window of ``least_words`` words also stands
    in another document: ``doc_id``, ``start_word``, ``end_word`` (exclusive) and
    ``n_words``. With ``within`` a repeat inside one document counts too.

    Spans are maximal and do not touch. Null and short texts and rows without an id have
    none. Rows that share an id are one document: they give no repeats of each other
    unless ``within`` is set. Very long texts are hashed whole. An empty table gives an
    empty one. Words are separated by ASCII white space, with A-Z in lower case, and
    compared by 64-bit hashes of whole windows.
    """
    key_words = least_words - window + 1
    if key_words < GRAM + 1:
        raise ValueError(f"least_words must exceed window by {GRAM} or more")
    base = narrow(docs, id=id_col, text=text_col).where("id is not null and text is not null")
    exploded = F.inline(F.arrays_zip("keys", "places")).alias("key", "place")
    shape = "id long, keys array<long>, places array<int>"
    order = ["key", "id", "place"]
    suffixes = base.mapInPandas(_suffixes(window, key_words), shape).select("id", exploded)
    # A range shuffle samples its input first; the table spares a second scan of the texts.
    ordered = settle(suffixes).repartitionByRange(*order).sortWithinPartitions(*order)
    met = settle(ordered.mapInPandas(_beside, "id long, key long, place int").groupBy("id").agg(F.collect_set("place").alias("at")))
    windows = base.join(met, "id").select("id", "text", "at").mapInPandas(_windows(window, least_words), shape).select("id", exploded)
    judged = settle(
        settle(windows).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_runs(within), JUDGED)
    )
    # At most two sums a task: those of one key are one run that crosses tasks.
    sums = judged.where("place < 0").groupBy("key").agg(F.min("id").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    crossing = settle(sums.where((F.col("low") != F.col("high")) | (F.lit(within) & (F.col("n") > 1))).select("key"))
    open_rows = judged.where("open and place >= 0").join(broadcast_if_small(crossing), "key", "left_semi").select("id", "place")
    repeats = judged.where("not open").select("id", "place").union(open_rows)
    spans = repeats.groupBy("id").agg(F.array_sort(F.collect_set("place")).alias("places")).mapInPandas(
        _merge(least_words), "doc_id long, start_word long, end_word long, n_words long"
    )
    return spans


def _merge(least_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for id_, places in zip(batch["id"], batch["places"], strict=True):
                p = np.asarray(places)
                new = np.concatenate([[True], p[1:] > p[:-1] + least_words])
                start = p[new]
                end = np.append(p[:-1][new[1:]], p[-1]) + least_words
                out += [(id_, a, b, b - a) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            yield pd.DataFrame(out, columns=["doc_id", "start_word", "end_word", "n_words"])

    return run
