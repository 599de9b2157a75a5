"""Key, reference and match-rate checks; each returns the violations or counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each full-row copy; nulls count as equal."""
    folded = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return folded.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls per column."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def match_rates(curated: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Row count and, per context column, the percentage of rows with a value."""
    rates = [
        F.bround(F.lit(100.0) * F.avg(F.col(column).isNotNull().cast("int")), 1).alias(name)
        for column, name in columns.items()
    ]
    return curated.agg(F.count(F.lit(1)).alias("total_rows"), *rates)


def functional_dependency_violations(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys under which any of ``values`` differs, a null differing from a number."""
    # min and max of a struct fold map-side; a distinct count per key would not.
    whole = F.struct(*values)
    spread = df.groupBy(*keys).agg(F.min(whole).alias("_least"), F.max(whole).alias("_most"))
    return spread.where(~F.col("_least").eqNullSafe(F.col("_most"))).select(*keys)


def constraint_violations(
    tables: Mapping[str, DataFrame],
    unique: Sequence[tuple[str, Sequence[str]]],
    not_null: Sequence[tuple[str, str]],
    references: Sequence[tuple[str, str, str, str]],
) -> DataFrame:
    """How many rows or keys break each declared constraint."""
    checks = []

    def tell(rule: str, broken: DataFrame) -> None:
        checks.append(broken.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule).alias("rule"), "violations"))

    for table, keys in unique:
        tell(f"unique {table}({', '.join(keys)})", duplicate_keys(tables[table], keys))
    for table, column in not_null:
        tell(f"not null {table}.{column}", tables[table].where(F.col(column).isNull()))
    for table, column, parent, parent_key in references:
        used = tables[table].select(F.col(column).alias("_k")).where(F.col("_k").isNotNull())
        known = tables[parent].select(F.col(parent_key).alias("_k"))
        tell(f"{table}.{column} in {parent}.{parent_key}", used.join(known, "_k", "left_anti"))
    return reduce(DataFrame.unionByName, checks)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)
