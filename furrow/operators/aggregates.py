"""Group means, rates, coverage and rankings over the curated table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.functions.numeric import flag, period_start, share


def group_mean(df: DataFrame, by: Sequence[str], value: str = "yield_hg_ha", name: str = "mean") -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias(name), F.count(value).alias("n"))


def mean_of_crop(records: DataFrame, crop: str) -> DataFrame:
    """Mean yield of one crop. Fails when the crop has no record at all."""
    tally = records.where(F.col("crop") == crop).agg(F.avg("yield_hg_ha").alias("mean"), F.count(F.lit(1)).alias("n"))
    missing = F.raise_error(F.lit(f"no records found for crop '{crop}'")).cast("double")
    return tally.select(F.lit(crop).alias("crop"), F.when(F.col("n") > 0, F.col("mean")).otherwise(missing).alias("mean_yield"), "n")


def largest_record(records: DataFrame, crop: str) -> DataFrame:
    """The record with the highest yield of a crop; ties go to the first area, then year."""
    of_crop = records.where(F.col("crop") == crop)
    return of_crop.orderBy(F.desc("yield_hg_ha"), "area", "year").limit(1)


def coverage_by_period(df: DataFrame, columns: Sequence[str], length: int = 10) -> DataFrame:
    """Percentage of rows that have each column, per period of ``length`` years."""
    rates = [share(F.col(c).isNotNull()).alias(f"{c}_coverage_pct") for c in columns]
    return df.groupBy(period_start(F.col("year"), length).alias("period")).agg(*rates)


def key_figures(df: DataFrame, label: str | None = None) -> DataFrame:
    """Rows, distinct crops and areas, mean yield, and the share of rows at risk if there
    is a 0/1 ``label``.

    Both distinct counts come from the distinct (area, crop) pairs, so the
    row-level shuffle is one grouped sum however many rows a pair has.
    """
    at_risk = F.sum(label if label else F.lit(None).cast("long")).alias("r")
    pairs = df.groupBy("area", "crop").agg(F.count(F.lit(1)).alias("n"), F.count("yield_hg_ha").alias("m"), F.sum("yield_hg_ha").alias("s"), at_risk)
    told = pairs.agg(
        F.sum("n").alias("n_rows"),
        F.countDistinct("crop").alias("n_crops"),
        F.countDistinct("area").alias("n_areas"),
        F.try_divide(F.sum("s").cast("double"), F.sum("m")).alias("mean_yield"),
        F.try_divide(F.sum("r").cast("double"), F.sum("n")).alias("high_risk_rate"),
    )
    return told if label else told.drop("high_risk_rate")


def key_figure_sketches(df: DataFrame, by: Sequence[str], precision: int = 12) -> DataFrame:
    """Per group of ``by`` the rows, the sum of yields and HyperLogLog sketches of crops and
    areas. Sketches of parts can be kept and merged later; the rows are not shuffled by
    value. The standard error is about 1.04 / sqrt(2 ** ``precision``), 1.6 % at 12."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("yield_hg_ha").alias("yields"), F.count("yield_hg_ha").alias("n_yields"),
        F.hll_sketch_agg("crop", precision).alias("crops"), F.hll_sketch_agg("area", precision).alias("areas"),
    )


def merged_key_figures(sketches: DataFrame) -> DataFrame:
    """Key figures of all parts together, distinct counts estimated from the merged sketches."""
    return sketches.agg(
        F.sum("n_rows").alias("n_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("crops")).alias("n_crops"),
        F.hll_sketch_estimate(F.hll_union_agg("areas")).alias("n_areas"),
        F.try_divide(F.sum("yields").cast("double"), F.sum("n_yields")).alias("mean_yield"),
    )


def group_rate(df: DataFrame, by: str, label: str, min_support: int = 5, top: int = 10) -> DataFrame:
    """Share of positive labels per group with enough rows, highest first."""
    rates = df.groupBy(by).agg(F.avg(label).alias("rate"), F.count(F.lit(1)).alias("n"))
    return rates.where(F.col("n") >= min_support).orderBy(F.desc("rate"), by).limit(top)


def options(df: DataFrame, column: str, **chosen: object) -> DataFrame:
    """What can still be picked for ``column`` once the ``chosen`` columns are set."""
    for name, value in chosen.items():
        df = df.where(F.col(name) == F.lit(value))
    return df.select(column).distinct().orderBy(column)


def lookup_rows(requests: DataFrame, history: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The history rows of the requested keys, and the requests that have none."""
    wanted = requests.select(*keys).distinct()
    found = history.join(wanted, list(keys), "left_semi")
    return found, wanted.join(history.select(*keys), list(keys), "left_anti")


def best_and_worst(scores: DataFrame, score: str, label: str, best: int, worst: int) -> DataFrame:
    """The top and bottom groups of a ranking, marked as such."""
    head = scores.orderBy(F.desc(score), label).limit(best).withColumn("side", F.lit("top"))
    tail = scores.orderBy(F.asc(score), label).limit(worst).withColumn("side", F.lit("bottom"))
    return head.unionByName(tail)


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def condition_rate(df: DataFrame, condition: Column, name: str) -> DataFrame:
    """How many rows meet a condition, and which share of all."""
    return df.agg(F.sum(flag(condition)).alias(f"n_{name}"), F.avg(flag(condition)).alias(f"{name}_rate"))
