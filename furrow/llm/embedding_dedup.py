"""Near copies among embeddings: random hyperplanes, exact check, components.

Each table has its own hyperplanes and files a vector under the signs of its products
with them. Vectors of one label that share a bucket in some table are compared by
their exact cosine. A pair that meets in several tables is counted in the first one
only, which both ends know from their signs.

With 20 tables of 12 bits a pair at cosine 0.98 has the same signs in at least one
table with probability 1 - 6e-6; a closer pair sooner. Equal vectors are folded
before and count by their number. A bucket with more than ``BLOCK`` vectors is split
into parts, each pair of parts being a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import local_components, narrow, segments
from furrow.llm.components import connected_components
from furrow.session import settle

TABLES, BITS, SEED = 20, 12, 7
BLOCK = 2048


def _signs(tables: int, bits: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            signs = np.zeros((len(batch), tables), dtype=np.int64)
            widths = batch["vector"].map(len).to_numpy()
            for width in np.unique(widths):
                if width not in planes:
                    planes[width] = np.random.default_rng([seed, int(width)]).standard_normal((width, tables * bits))
                own = np.flatnonzero(widths == width)
                x = np.array([np.asarray(v, dtype=float) for v in batch["vector"].iloc[own]])
                scale = np.abs(x).max(axis=1, keepdims=True)
                up = ((x / scale) @ planes[width] > 0).reshape(len(own), tables, bits)
                signs[own] = up @ (1 << np.arange(bits))
            yield batch.assign(signs=list(signs))

    return run


def _compare(tables: int, least: float):
    def work(key: str, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        table, i, j = (int(x) for x in key.split(":")[-3:])
        x = np.array([np.asarray(v, dtype=float) for v in rows["vector"]])
        x /= np.abs(x).max(axis=1, keepdims=True)
        part, signs = rows["part"].to_numpy(), np.array(rows["signs"].tolist())
        ids, weight = rows["rep"].to_numpy(), rows["weight"].to_numpy()
        norm = np.sqrt((x * x).sum(axis=1))
        left = np.flatnonzero(part == i)
        right = left if i == j else np.flatnonzero(part == j)
        cosine = (x[left] @ x[right].T) / np.outer(norm[left], norm[right])
        a, b = np.nonzero(cosine >= least)
        a, b = left[a], right[b]
        if i == j:
            a, b = a[a < b], b[a < b]
        if not len(a):
            return
        # The smallest connected row of the part pair, for the components.
        root = local_components(len(rows), a, b)
        new = np.ones(len(a), dtype=bool)
        for earlier in range(table):
            new &= signs[a, earlier] != signs[b, earlier]
        links = np.bincount(a[new], weight[b[new]], len(rows)) + np.bincount(b[new], weight[a[new]], len(rows))
        out = pd.DataFrame({"a": ids, "b": ids[root], "links": links.astype(np.int64)})
        yield out[(out["links"] > 0) | (out["a"] != out["b"])]

    return work


def near_copies(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = 0.98,
    tables: int = TABLES,
    bits: int = BITS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links`` (other rows with a cosine of
    at least ``least``), ``component_id`` (the smallest id reachable) and ``kept``.

    A vector that is null, empty, all zero or holds a null, NaN or infinite component,
    and one whose label is null, links with nothing. Vectors of different widths or
    labels are not compared. A row without an id has no component, links with nothing
    and is kept. Rows that share an id are one node. An empty table gives an empty one.
    """
    base = narrow(vectors, vec_id=id_col, label=label_col, given=vector_col).withColumn(
        "vector", F.transform("given", lambda v: v.cast("double"))
    )
    sound = (
        F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("vector", lambda v: v != 0)
    )
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False))
    marked = settle(
        base.select(
            "vec_id",
            F.col("label").cast("string").alias("label"),
            F.coalesce(usable, F.lit(False)).alias("usable"),
            F.xxhash64("vector").alias("h1"),
            F.xxhash64(F.lit(1), "vector").alias("h2"),
            F.when(usable, F.col("vector")).alias("vector"),
        )
    )
    good = marked.where("usable")
    key = ["label", "h1", "h2"]
    copies = settle(good.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")))
    # One row of each group of equal vectors goes on, whichever it is.
    folded = good.groupBy(*key).agg(F.any_value("vector").alias("vector")).join(copies, key)
    signed = settle(
        folded.select("rep", "weight", "label", "vector").mapInPandas(
            _signs(tables, bits, seed), "rep long, weight long, label string, vector array<double>, signs array<long>"
        )
    )
    filed = signed.select("*", F.size("vector").alias("width"), F.posexplode("signs").alias("table", "sign")).withColumn(
        "bucket", F.concat_ws(":", "label", "width", "sign", "table")
    )
    sizes = settle(filed.groupBy("bucket").count().where("count > 1").select("bucket", F.ceil(F.col("count") / BLOCK).alias("parts")))
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    dealt = (
        filed.join(sizes, "bucket")
        .select(
            "rep",
            "weight",
            "vector",
            "signs",
            "bucket",
            part.alias("part"),
            F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("with"),
        )
        .withColumn("group", F.concat_ws(":", "bucket", F.least("part", "with"), F.greatest("part", "with")))
        .select("rep", "weight", "vector", "signs", "part", "group")
    )
    found = settle(segments(dealt, "group", _compare(tables, least), "a long, b long, links long"))
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    # A repeated id ties its vectors together, as each of them has that id.
    placed = marked.join(copies, key, "left").select("vec_id", "usable", F.when(F.col("usable"), F.col("rep")).alias("rep"), "weight")
    tied = placed.where("usable").groupBy("vec_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low != high")
    ties = tied.select(F.col("vec_id").alias("a"), F.col("low").alias("b")).union(tied.select("vec_id", "high"))
    roots = connected_components(found.select("a", "b").union(ties)).select(F.col("node").alias("rep"), "component")
    component = F.coalesce("component", "rep", "vec_id")
    return placed.join(counts, "rep", "left").join(roots, "rep", "left").select(
        "vec_id",
        F.when(F.col("usable"), F.coalesce("links", F.lit(0)) + F.col("weight") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
