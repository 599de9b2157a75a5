"""Language identification: multinomial naive Bayes over hashed character n-grams.

The counts of all training texts are summed by Spark over (language, bucket). The
driver receives a table of languages times ``BUCKETS`` numbers whatever the input,
turns it into log-probabilities and broadcasts the matrix; texts are then scored in
batches by gathering and adding its rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import ODD, code_points, narrow

#: Buckets of the n-gram hash, lengths of the n-grams, added to every count.
BITS, ORDERS, SMOOTH = 15, (1, 2, 3), 0.5
BUCKETS = 1 << BITS
#: Characters looked at in one go; only the size of temporary arrays.
PIECE = 1 << 18


@functools.cache
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def buckets_of(text: str | None) -> np.ndarray | None:
    """The buckets of all n-grams of a text, None if it holds no letter. Whatever is not a
    letter counts as a space."""
    if not text:
        return None
    c = code_points(text.lower())
    is_letter = letters()[c]
    if not is_letter.any():
        return None
    c = np.where(is_letter, c, 32).astype(np.uint64)
    found, gram = [], np.zeros(len(c), dtype=np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(c) < n:
            break
        gram = gram[: len(c) - n + 1] * np.uint64(0x110001) + c[n - 1 :]
        if n in ORDERS:
            found.append((((gram + np.uint64(n)) * ODD) >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(found)


class Model(NamedTuple):
    languages: list[str]
    #: One row per bucket, one column per language.
    log_probability: np.ndarray
    log_prior: np.ndarray


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            found = buckets_of(text)
            if found is None:
                continue
            own = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            for start in range(0, len(found), PIECE):
                piece = found[start : start + PIECE]
                if len(piece) > BUCKETS // 4:
                    own += np.bincount(piece, minlength=BUCKETS)
                else:
                    np.add.at(own, piece, 1)
            docs[lang] = docs.get(lang, 0) + 1
    for lang, own in counts.items():
        there = np.flatnonzero(own)
        # Bucket -1 holds the number of texts.
        yield pd.DataFrame({"lang": lang, "bucket": [-1, *there], "n": [docs[lang], *own[there]]})


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from every row whose language is not null and whose text has a letter.

    Without such rows the model has no language. Its size is 4 bytes times the number
    of languages times ``BUCKETS``."""
    rows = narrow(labelled, lang=lang_col, text=text_col).where("lang is not null and text is not null")
    counted = rows.mapInPandas(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toPandas()
    languages = sorted(table["lang"].unique())
    place = {lang: i for i, lang in enumerate(languages)}
    counts, docs = np.full((BUCKETS, len(languages)), SMOOTH), np.zeros(len(languages))
    column = table["lang"].map(place).to_numpy(dtype=int)
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    counts[bucket[bucket >= 0], column[bucket >= 0]] += n[bucket >= 0]
    docs[column[bucket < 0]] = n[bucket < 0]
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32), np.log(docs / max(docs.sum(), 1)))


def judge(text: str | None, model: Model) -> tuple[str, float]:
    """The likeliest language and its posterior probability; ``und`` and 0 without a letter
    or without any learned language. Ties go to the first language in order."""
    found = buckets_of(text) if model.languages else None
    if found is None:
        return "und", 0.0
    total = model.log_prior.copy()
    for start in range(0, len(found), PIECE):
        total += model.log_probability[found[start : start + PIECE]].sum(axis=0, dtype=np.float64)
    best = int(total.argmax())
    return model.languages[best], float(1 / np.exp(total - total[best]).sum())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``lang_pred`` and ``score``. Null ids are
    kept, repeated rows are judged alike, an empty table gives an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            judged = [judge(text, shared.value) for text in batch["text"]]
            yield pd.DataFrame(judged, columns=["lang_pred", "score"]).assign(key=batch["key"].to_numpy())

    keyed = narrow(docs, key=id_col, text=text_col).withColumn("key", F.col("key").cast("string"))
    scored = keyed.mapInPandas(run, "lang_pred string, score double, key string")
    return scored.select(F.col("key").cast(docs.schema[id_col].dataType).alias("doc_id"), "lang_pred", "score")
