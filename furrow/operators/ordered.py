"""Ranks, running sums and quantiles over a global order.

A window without partition keys moves every row into one task, and a window per
group moves a whole group. Here the rows are range-shuffled instead: each slice
holds a contiguous stretch of the order, a small table of slice totals says
what came before it, and only the running sum inside a slice needs a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.session import settle


def _slices(df: DataFrame, order_by: Sequence[str], sums: Sequence[str], within: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with their slice number, and per slice and group of each column:
    the sum here, the sum carried in from earlier slices and the group's total."""
    # The slice number is part of the settled rows: both branches have to agree
    # on it, and range boundaries are sampled anew if a shuffle is redone.
    rows = settle(df.repartitionByRange(*within, *order_by).withColumn("_slice", F.spark_partition_id()))
    here = rows.groupBy(*within, "_slice").agg(*[F.sum(c).alias(f"_{c}_here") for c in sums])
    # At most one row per slice and group, so this window is over a short table.
    whole = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return rows, here.select(
        "*",
        *[F.coalesce(F.sum(f"_{c}_here").over(earlier), F.lit(0)).alias(f"_{c}_carried") for c in sums],
        *[F.sum(f"_{c}_here").over(whole).alias(f"{c}_total") for c in sums],
    )


def _run_inside(rows: DataFrame, slices: DataFrame, order_by: Sequence[str], sums: Sequence[str], within: Sequence[str]) -> DataFrame:
    """Running sums of the rows in ``slices``; rows of other slices are dropped."""
    inside = Window.partitionBy(*within, "_slice").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(slices, [*within, "_slice"])
        .withColumns({f"{c}_before": F.col(f"_{c}_carried") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
        .drop("_slice", *[f"_{c}_{part}" for c in sums for part in ("here", "carried")])
    )


def running_totals(df: DataFrame, order_by: Sequence[str], sums: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Adds ``<c>_before`` and ``<c>_total`` for each column in ``sums``.

    ``_before`` sums the rows of the same ``within`` group that sort earlier;
    ``_total`` sums the whole group. The ``(within, order_by)`` key must be
    unique, so callers aggregate first; that also folds hot values into one row.
    """
    rows, slices = _slices(df, order_by, sums, within)
    return _run_inside(rows, slices, order_by, sums, within)


def _holding(slices: DataFrame, ranks: Sequence[Column], column: str) -> DataFrame:
    """The slices in which any of the 0-based ``ranks`` falls."""
    first, last = F.col(f"_{column}_carried"), F.col(f"_{column}_carried") + F.col(f"_{column}_here")
    held = F.lit(False)
    for rank in ranks:
        held = held | ((first <= rank) & (rank < last))
    return slices.where(held)


def dense_ids(df: DataFrame, name: str, id_name: str) -> DataFrame:
    """The distinct values of ``name`` numbered 1..n in their own order."""
    names = df.select(name).where(F.col(name).isNotNull()).distinct().withColumn("_one", F.lit(1).cast("long"))
    return running_totals(names, [name], ["_one"]).select((F.col("_one_before") + 1).alias(id_name), name)


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), times: str | None = None
) -> DataFrame:
    """Linearly interpolated quantiles per group, exact whatever the group size.
    With ``times``, each row stands for that many equal values.

    Returns the ``by`` columns, ``n`` (non-null values) and ``quantiles``, an
    array in the order of ``probs``. The built-in exact percentile keeps every
    distinct value of a group in one task's memory; this keeps none.
    """
    by = list(by)
    present = df.where(F.col(value).isNotNull())
    for key in by:
        present = present.where(F.col(key).isNotNull())
    if times:
        present = present.where(F.col(times) > 0)
    weight = F.col(times).cast("long") if times else F.lit(1).cast("long")
    counted = (
        present.select(*by, F.col(value).cast("double").alias("_v"), weight.alias("_n"))
        .groupBy(*by, "_v")
        .agg(F.sum("_n").alias("_n"))
    )
    first, last = F.col("_n_before"), F.col("_n_before") + F.col("_n")

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_n_total") - 1)

    def covers(rank: Column) -> Column:
        return (first <= rank) & (rank < last)

    lows = [F.floor(position(p)) for p in probs]
    highs = [F.ceil(position(p)) for p in probs]
    # Only the slices a wanted rank falls into are sorted and summed.
    rows, slices = _slices(counted, ["_v"], ["_n"], by)
    ranked = _run_inside(rows, _holding(slices, [*lows, *highs], "_n"), ["_v"], ["_n"], by)
    picked = ranked.groupBy(*by).agg(
        F.max("_n_total").alias("_n_total"),
        *[F.max(F.when(covers(rank), F.col("_v"))).alias(f"_lo{i}") for i, rank in enumerate(lows)],
        *[F.max(F.when(covers(rank), F.col("_v"))).alias(f"_hi{i}") for i, rank in enumerate(highs)],
    )
    between = [
        F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (position(p) - F.floor(position(p)))
        for i, p in enumerate(probs)
    ]
    return picked.select(*by, F.col("_n_total").alias("n"), F.array(*between).alias("quantiles"))


def rows_at(df: DataFrame, order_by: Sequence[str], ranks: Sequence[Column]) -> DataFrame:
    """The rows at the given 0-based ranks of the global order, with ``position``.

    ``ranks`` are expressions and may use ``_one_total``, the number of rows.
    ``order_by`` must be unique over the rows.
    """
    rows, slices = _slices(df.withColumn("_one", F.lit(1).cast("long")), order_by, ["_one"], [])
    ranked = _run_inside(rows, _holding(slices, ranks, "_one"), order_by, ["_one"], [])
    kept = F.lit(False)
    for rank in ranks:
        kept = kept | (F.col("_one_before") == rank)
    return ranked.where(kept).withColumnRenamed("_one_before", "position").drop("_one")
