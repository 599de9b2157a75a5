"""Small arithmetic expressions with the null and zero rules spelled out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hg_to_kg(col: Column) -> Column:
    return col / F.lit(10)


def period_start(year: Column, length: int) -> Column:
    """First year of the ``length``-year period, rounding down for negative years too."""
    return year - F.pmod(year, F.lit(length))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def share(condition: Column) -> Column:
    """Percentage of rows for which ``condition`` holds (an aggregate)."""
    return F.lit(100.0) * F.avg(flag(condition))


def safe_ratio(top: Column, bottom: Column, default: float | None = None) -> Column:
    ratio = F.try_divide(top.cast("double"), F.nullif(bottom.cast("double"), F.lit(0.0)))
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def correlation(left: Column, right: Column) -> Column:
    """Pearson correlation (an aggregate) over rows that have both values; null
    where a side never varies, on which the built-in ``corr`` fails in ANSI mode."""
    both = left.isNotNull() & right.isNotNull()
    x, y = F.when(both, left.cast("double")), F.when(both, right.cast("double"))
    return safe_ratio(F.covar_pop(x, y), F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y)))


def percent_change(base: Column, new: Column) -> Column:
    """Change against ``base`` in percent; null where the base is 0 or unknown."""
    return safe_ratio(F.lit(100.0) * (new - base), base)


def band(col: Column, cuts: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first cut the value stays below, else ``top``."""
    label = None
    for limit, name in cuts:
        below = col < F.lit(limit)
        label = F.when(below, name) if label is None else label.when(below, name)
    return label.otherwise(top)


def tier(value: Column, mean: Column, variance: Column) -> Column:
    """low / medium / high by one standard deviation around the mean."""
    spread = F.sqrt(variance)
    return F.when(value < mean - spread, "low").when(value > mean + spread, "high").otherwise("medium")


def one_hot(col: Column, categories: Sequence[str], prefix: str) -> dict[str, Column]:
    """One 0/1 column per known category; an unknown category gives zeros throughout."""
    return {f"{prefix}{name}": flag(col == F.lit(name)) for name in categories}
