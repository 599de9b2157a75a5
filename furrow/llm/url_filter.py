"""URL filter: rules first, then the ratio of two character language models.

Both models are variable-order Markov models over the bytes of a URL: the probability
of a byte after the last ``ORDER`` bytes is interpolated with the one after shorter
contexts, each context trusted by how often it was seen, down to a uniform byte. One
is learned from URLs that the rules allow, one from those they block. The score is
the mean difference of the log-likelihoods per byte, and its threshold is calibrated
on held-out URLs with a known verdict.

Counts are kept by hashed context in ``1 << BITS`` buckets for each length; they are
summed by Spark, so the driver holds a model of a fixed size whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import ODD, narrow

ORDER, BITS, TRUST = 5, 18, 2.0
#: Bins of the score for the calibration, between -LIMIT and LIMIT.
BINS, LIMIT = 4000, 4.0


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: The rules of the query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path: both empty for a null URL and one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0)
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, both null without one; among rules of the
    same length the first in code point order."""
    rule = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.host + r.path), r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, r.host + r.path) if rule is None else rule.when(fits, r.host + r.path)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def grams(url: str) -> np.ndarray:
    """One row per byte: its bucket after contexts of 0 to ORDER bytes, then the buckets of
    the contexts alone. A URL starts after ORDER bytes 0."""
    b = np.frombuffer(b"\0" * ORDER + url.encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint64)
    n, shift = len(b) - ORDER, np.uint64(64 - BITS)
    out = np.empty((n, 2 * (ORDER + 1)), dtype=np.int64)
    for k in range(ORDER + 1):
        context = np.full(n, k + 1, dtype=np.uint64)
        for i in range(ORDER - k, ORDER):
            context = (context ^ (context >> np.uint64(29))) * ODD + b[i : i + n]
        whole = (context ^ (context >> np.uint64(29))) * ODD + b[ORDER:] + np.uint64(1)
        out[:, k] = (whole * ODD) >> shift
        out[:, ORDER + 1 + k] = ((context + np.uint64(977)) * ODD) >> shift
    return out


class Model(NamedTuple):
    #: Axes: allowed or blocked, length of the context, bucket. Of bytes after contexts, of contexts.
    bytes_after: np.ndarray
    contexts: np.ndarray
    threshold: float

    def log_likelihoods(self, url: str) -> np.ndarray:
        """Mean log-likelihood per byte under the allowed and the blocked model."""
        g = grams(url)
        p = np.full((2, len(g)), 1 / 256)
        for k in range(ORDER + 1):
            seen = self.contexts[:, k, g[:, ORDER + 1 + k]]
            # A hashed bucket may hold other bytes too; no share exceeds its context's.
            after = np.minimum(self.bytes_after[:, k, g[:, k]], seen)
            p = (after + TRUST * p) / (seen + TRUST)
        return np.log(p).mean(axis=1)

    def score(self, url: str | None) -> float:
        if not url:
            return 0.0
        allowed, blocked = self.log_likelihoods(url)
        return float(allowed - blocked)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros((2, 2 * (ORDER + 1), 1 << BITS), dtype=np.int32)
    for batch in batches:
        for url, verdict in zip(batch["url"], batch["verdict"], strict=True):
            g = grams(url)
            for k in range(g.shape[1]):
                np.add.at(counts[int(verdict == "block"), k], g[:, k], 1)
    verdict, k, bucket = np.nonzero(counts)
    for start in range(0, len(bucket), 100_000):
        at = slice(start, start + 100_000)
        yield pd.DataFrame({"v": verdict[at], "k": k[at], "bucket": bucket[at], "n": counts[verdict[at], k[at], bucket[at]]})


def _scores(model_of, columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[columns].assign(score=[model_of.value.score(u) for u in batch["url"]])

    return run


def fit(pages: DataFrame, rules: Sequence[Rule] = RULES, url_col: str = "url") -> Model:
    """Learns from every URL that a rule judges: four of five (by a hash of the URL) count
    for the models, the fifth calibrates the threshold to the best mean of the two
    shares judged right. Without URLs of both kinds all scores are 0 and allowed."""
    url = narrow(pages, url=url_col)
    host, path = parts(F.col("url"))
    known = url.withColumn("verdict", ruled(host, path, rules)[1]).where("verdict is not null and url != ''")
    held = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    counted = known.where(~held).mapInPandas(_count, "v int, k int, bucket int, n long")
    table = counted.groupBy("v", "k", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2, 2 * (ORDER + 1), 1 << BITS), dtype=np.float32)
    counts[table["v"], table["k"], table["bucket"]] = table["n"]
    model = Model(counts[:, : ORDER + 1], counts[:, ORDER + 1 :], -np.inf)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    bins = (
        known.where(held)
        .mapInPandas(_scores(shared, ["verdict"]), "verdict string, score double")
        .groupBy("verdict", F.floor((F.least(F.greatest("score", F.lit(-LIMIT)), F.lit(LIMIT)) + LIMIT) / (2 * LIMIT) * BINS).alias("bin"))
        .count()
        .toPandas()
    )
    number = np.zeros((2, BINS + 1))
    number[(bins["verdict"] == "block").to_numpy(dtype=int), bins["bin"].to_numpy(dtype=int)] = bins["count"]
    if not number.sum(axis=1).all() or not counts.any(axis=(1, 2)).all():
        return model
    # For each bin as the first allowed one: shares of the allowed and the blocked judged right.
    right = np.cumsum(number[0][::-1])[::-1] / number[0].sum() + (np.cumsum(number[1]) - number[1]) / number[1].sum()
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return model._replace(threshold=float(best.mean() / BINS * 2 * LIMIT - LIMIT))


def judge(pages: DataFrame, model: Model, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and
    ``score``. The rule's verdict holds; else a URL is allowed if its score reaches the
    model's threshold. A null or empty URL scores 0, fits no rule and is blocked, as there
    is nothing to judge. Null ids and repeated rows are kept; an empty table gives an
    empty one."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    host, path = parts(F.col("url"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    keyed = (
        narrow(pages, key=id_col, url=url_col)
        .select(F.col("key").cast("string").alias("key"), "url", host.alias("host"), path.alias("path"))
        .withColumns({"rule": rule, "by_rule": verdict})
    )
    columns = ["key", "url", "host", "path", "rule", "by_rule"]
    scored = keyed.mapInPandas(_scores(shared, columns), ", ".join(f"{c} string" for c in columns) + ", score double")
    learned = F.when((F.coalesce("url", F.lit("")) != "") & (F.col("score") >= F.lit(model.threshold)), "allow").otherwise("block")
    return scored.select(
        F.col("key").cast(pages.schema[id_col].dataType).alias("page_id"),
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", learned).alias("verdict"),
        "score",
    )
