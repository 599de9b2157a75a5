"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target over
size of its source. Within a source the documents are ordered by size; the running
sum of expected copies, shifted by one random offset of the source, crosses some
integer boundaries inside a document, and the document is taken once for each.
Ordering by size keeps the taken words within about one document of the target.

Only DataFrame functions. The running sum is the library's range-shuffled one: a
source that holds a third of the rows is cut into slices and never sorted as one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.llm.common import broadcast_if_small, narrow
from furrow.operators.ordered import running_totals
from furrow.session import settle

WORD = r"[^\x20\x09-\x0D]+"


def offset_of(source: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the source alone."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), source), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sized: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """Per source ``source``, ``source_size``, ``n_docs`` and ``target``.

    Sources in code point order, null last, take the weights in turn and share
    ``percent`` % of all words; no target exceeds ``most`` times its source. Sharing
    the excess again until none is above ends where every source below its limit has
    the same target per weight. That level is found from running sums over the
    sources in the order of limit per weight."""
    per = settle(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")))
    one = F.lit(1).cast("long")
    ranked = running_totals(
        per.select(F.col("source").isNull().cast("int").alias("last"), F.coalesce("source", F.lit("")).alias("name"), one.alias("one")),
        ["last", "name"],
        ["one"],
    )
    turn = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = ranked.select(
        F.when(F.col("last") == 0, F.col("name")).alias("source"),
        F.get(turn, (F.col("one_before") % len(weights)).cast("int")).alias("weight"),
    )
    sized_up = per.join(weighed, per["source"].eqNullSafe(weighed["source"])).select(
        per["source"], "source_size", "n_docs", "weight", (F.col("source_size") * most).alias("limit")
    )
    full = settle(
        running_totals(
            sized_up.select(
                "*",
                (F.col("limit") / F.col("weight")).alias("ratio"),
                F.col("source").isNull().cast("int").alias("last"),
                F.coalesce("source", F.lit("")).alias("name"),
            ),
            ["ratio", "last", "name"],
            ["limit", "weight"],
        )
    )
    # A source is at its limit if the level that the others would have is not lower.
    words = F.floor(F.col("limit_total") / most)
    goal = F.least(words * percent / 100.0, F.col("limit_total").cast("double"))
    level = (goal - F.col("limit_before")) / (F.col("weight_total") - F.col("weight_before"))
    free = full.select("ratio", "last", "name", level.alias("level")).where("ratio > level")
    shared = free.agg(F.min_by("level", F.struct("ratio", "last", "name"))).scalar()
    return full.withColumn("level", shared).select(
        "source",
        "source_size",
        "n_docs",
        F.when(F.col("level").isNull() | (F.col("ratio") <= F.col("level")), F.col("limit").cast("double"))
        .otherwise(F.col("weight") * F.col("level"))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    percent: int = 150,
    most: int = 2,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size`` (words), ``source``,
    ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size).

    A null text has size 0; a null source is a source of its own, the last one; a
    null id is kept. Rows alike in source, size and id are taken as one block of
    neighbours and share its copies in a fixed order, so reruns agree. A source
    without words has target 0 and nothing is taken from it. An empty table gives an
    empty one.
    """
    base = narrow(docs, doc_id=id_col, text=text_col, source=source_col)
    sized = settle(
        base.select("doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"))
    )
    goals = targets(sized, weights, percent, most)
    # Equal rows are folded, which makes the order total; null keys become flags.
    folded = sized.groupBy(
        F.col("source").isNull().cast("int").alias("no_source"),
        F.coalesce("source", F.lit("")).alias("name"),
        "size",
        F.col("doc_id").isNull().cast("int").alias("no_id"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
    ).agg(F.count("*").alias("rows"))
    placed = running_totals(folded, ["size", "no_id", "id"], ["rows"], ["no_source", "name"])
    single = placed.select(
        F.when(F.col("no_source") == 0, F.col("name")).alias("source"),
        F.when(F.col("no_id") == 0, F.col("id")).alias("doc_id"),
        "size",
        F.explode(F.sequence(F.col("rows_before"), F.col("rows_before") + F.col("rows") - 1)).alias("before"),
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = F.col("before") * F.col("rate") + F.col("offset")
    end = (F.col("before") + 1) * F.col("rate") + F.col("offset")
    known = goals.select(F.col("source").alias("name"), "source_size", "target", rate.alias("rate"), offset_of(F.col("source"), seed).alias("offset"))
    # Rounding must not add a copy where the rate is at its limit.
    copies = F.least(F.floor(end) - F.floor(start), F.lit(most).cast("long"))
    return single.join(known, single["source"].eqNullSafe(known["name"])).select(
        "doc_id", "size", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken, all
    columns kept. Rows alike in id, source and size share their copies evenly, the odd
    ones going to the first rows in the order of the text. Null and empty texts have size 0
    and cost nothing. An empty table gives an empty one."""
    taken = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **settings)
    per = broadcast_if_small(
        settle(taken.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0"))
    )
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[id_col].alias("id"),
        docs[source_col].alias("from"),
        F.coalesce(docs[text_col], F.lit("")).alias("order"),
        F.regexp_count(F.coalesce(docs[text_col], F.lit("")), F.lit(WORD)).cast("long").alias("length"),
    )
    own = packed.join(
        per, F.col("id").eqNullSafe(F.col("doc_id")) & F.col("from").eqNullSafe(F.col("source")) & (F.col("length") == F.col("size"))
    )
    # Only rows that repeat an id need an order among themselves.
    alike = Window.partitionBy("id", "from", "length").orderBy("order")
    several = own.where("rows > 1").withColumn("place", F.row_number().over(alike) - 1)
    both = own.where("rows = 1").withColumn("place", F.lit(0)).unionByName(several)
    times = F.floor(F.col("copies") / F.col("rows")) + F.when(F.col("place") < F.col("copies") % F.col("rows"), 1).otherwise(0)
    return both.select("row", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select("row.*")
