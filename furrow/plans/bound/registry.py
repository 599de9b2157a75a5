"""Names, callables and SQL of the bound queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.plans.bound.tables import Tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def widened(df: DataFrame) -> DataFrame:
    """Integers as bigint and decimals as double, the types both engines agree on."""
    casts = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            casts[field.name] = F.col(f"`{field.name}`").cast("bigint")
        elif isinstance(field.dataType, T.DecimalType):
            casts[field.name] = F.col(f"`{field.name}`").cast("double")
    return df.withColumns(casts) if casts else df


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Sums of doubles depend on the order they are added in; compare them rounded.
    Adding 0 turns a rounded -0.0 into 0.0."""
    return df.withColumns({c: F.round(F.col(c), places) + F.lit(0.0) for c in columns})


def bound(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under ``name``, with its SQL."""

    def register(work: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = lambda spark, folder: widened(work(Tables(spark, folder)))
        if sql is not None:
            _ORACLES[name] = sql
        return work

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
