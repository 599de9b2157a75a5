"""Joins of the fact table to its context, and group-statistic lookups.

No side is broadcast by hint unless its size is bounded by the number of
columns or parameters: the planner compares real sizes with the session's
threshold and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.session import settle

CONTEXT = {"pesticides": "pesticides_tonnes", "rainfall": "rainfall_mm", "temp": "avg_temp_c"}


def merge_sources(yields: DataFrame, pesticides: DataFrame, rainfall: DataFrame, temp: DataFrame) -> DataFrame:
    """Every yield row with the context of its area and year, where there is any.

    Left joins in a row on the same keys: a context table under the session's
    threshold is broadcast and the facts stay where they are; otherwise the facts are
    shuffled once, as each later join finds them dealt by its keys. A key that repeats
    on a side multiplies the matching rows.
    """
    keys = ["area_key", "year"]
    sides = [side.select(*keys, CONTEXT[name]) for name, side in (("pesticides", pesticides), ("rainfall", rainfall), ("temp", temp))]
    return reduce(lambda left, right: left.join(right, keys, "left"), sides, yields).select("area", "crop", "year", "yield_hg_ha", *CONTEXT.values())


def merge_by_name(yields: DataFrame, sides: Sequence[DataFrame]) -> DataFrame:
    """Variant joined on the area name as it is written, without normalising it."""
    return reduce(lambda left, right: left.join(right, ["area", "year"], "left"), sides, yields)


def with_group_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str], defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Look up per-group statistics, with a value for groups that have none.

    The statistics are a written table, whose size the planner knows: small ones are
    broadcast and the rows are not shuffled on a key with few values."""
    joined = df.join(settle(stats), list(keys), "left")
    if not defaults:
        return joined
    return joined.withColumns({name: F.coalesce(F.col(name), value) for name, value in defaults.items()})


def previous_year(history: DataFrame, keys: Sequence[str], value: str, name: str, refuse_repeats: bool = False) -> DataFrame:
    """``history`` keyed so that a join on (keys, year) finds the value of the
    calendar year before. A gap in the years finds nothing. Where a year has several values
    the largest counts, or the job fails if ``refuse_repeats``."""
    found = F.max(value)
    if refuse_repeats:
        named = F.concat_ws("/", *[F.col(k).cast("string") for k in keys], (F.col("year")).cast("string"))
        problem = F.raise_error(F.concat(F.lit(f"several values of {value} a year: "), F.first(named)))
        found = F.when(F.min(value).eqNullSafe(found), found).otherwise(problem)
    return history.groupBy(*keys, (F.col("year") + 1).alias("year")).agg(found.alias(name))


def with_previous_year(df: DataFrame, history: DataFrame, keys: Sequence[str] = ("area", "crop"), value: str = "yield_hg_ha", name: str = "lag1_yield", refuse_repeats: bool = False) -> DataFrame:
    return df.join(previous_year(history, keys, value, name, refuse_repeats), [*keys, "year"], "left")
