"""Descriptive and inferential statistics, per group or for a whole frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.functions.distributions import normal_quantile, t_p_value
from furrow.functions.numeric import correlation, safe_ratio
from furrow.session import settle
from furrow.operators.ordered import exact_quantiles

Y = "yield_hg_ha"


def _with_quantiles(df: DataFrame, stats: DataFrame, value: str, named: dict[str, float], by: Sequence[str]) -> DataFrame:
    """Attach exact quantiles as named columns to per-group statistics."""
    cuts = exact_quantiles(df, value, list(named.values()), by)
    picked = [F.col("quantiles")[i].alias(name) for i, name in enumerate(named)]
    if by:
        return stats.join(cuts.select(*by, *picked), list(by), "left")
    # Two one-row frames: the second is read as a scalar, not joined.
    row = cuts.select(F.struct(*picked).alias("q")).scalar()
    return stats.withColumn("_q", row).select("*", *[F.col(f"_q.{name}").alias(name) for name in named]).drop("_q")


def describe(df: DataFrame, value: str = Y, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max."""
    stats = df.groupBy(*by).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )
    return _with_quantiles(df, stats, value, {"p25": 0.25, "median": 0.5, "p75": 0.75}, by)


def array_summary(df: DataFrame, value: str = Y, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std (population), min and max."""
    return df.groupBy(*by).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )


def distribution(df: DataFrame, value: str = Y, by: Sequence[str] = ("crop",)) -> DataFrame:
    """Moments with n-1, the sample-adjusted skew and five percentiles."""
    n = F.count(value)
    adjust = F.try_divide(F.sqrt(n * (n - 1)), (n - 2).cast("double"))
    stats = df.groupBy(*by).agg(
        n.alias("count"), F.avg(value).alias("mean"), F.var_samp(value).alias("variance"),
        F.stddev_samp(value).alias("std"), (F.skewness(value) * adjust).alias("skew"),
    )
    cuts = {"p10": 0.10, "p25": 0.25, "median": 0.50, "p75": 0.75, "p90": 0.90}
    return _with_quantiles(df, stats, value, cuts, by)


def regional_averages(df: DataFrame, top: int | None = 10) -> DataFrame:
    """Per crop and area: mean, count and distance from the crop mean in crop
    standard deviations; the ``top`` areas of each crop, or all of them."""
    per_crop = df.groupBy("crop").agg(F.avg(Y).alias("_m"), F.stddev_samp(Y).alias("_s"))
    per_area = df.groupBy("crop", "area").agg(F.avg(Y).alias("mean"), F.count(Y).alias("count"))
    scored = per_area.join(per_crop, "crop").select(
        "crop", "area", "mean", "count", safe_ratio(F.col("mean") - F.col("_m"), F.col("_s")).alias("z_vs_global")
    )
    if top is None:
        return scored
    place = F.row_number().over(Window.partitionBy("crop").orderBy(F.desc("mean"), "area"))
    return scored.withColumn("_place", place).where(F.col("_place") <= top).drop("_place")


def crop_z_scores(df: DataFrame, name: str = "z") -> DataFrame:
    """Each row's distance from its crop's mean in sample standard deviations.

    The statistics are grouped and joined back: a window over the crop would
    hold all rows of a crop in one task.
    """
    # Written, so that the planner knows its size and need not shuffle the rows on crop.
    stats = settle(df.groupBy("crop").agg(F.avg(Y).alias("_m"), F.stddev_samp(Y).alias("_s")))
    return df.join(stats, "crop", "left").withColumn(name, safe_ratio(F.col(Y) - F.col("_m"), F.col("_s"))).drop("_m", "_s")


def mean_z_by(df: DataFrame, by: Sequence[str], name: str = "mean_z") -> DataFrame:
    return crop_z_scores(df, "_z").groupBy(*by).agg(F.avg("_z").alias(name))


def global_z_scores(df: DataFrame, value: str = Y, name: str = "z") -> DataFrame:
    """Distance from the overall mean in population standard deviations."""
    overall = df.agg(F.struct(F.avg(value).alias("m"), F.stddev_pop(value).alias("s")).alias("o")).scalar()
    return df.withColumn("_o", overall).withColumn(name, safe_ratio(F.col(value) - F.col("_o.m"), F.col("_o.s"))).drop("_o")


def correlation_matrix(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlations over complete cases in long form (left, right, r),
    with the number of complete cases."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    whole = df.dropna(subset=list(columns)).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_complete"), *[correlation(F.col(a), F.col(b)).alias(f"_{i}") for i, (a, b) in enumerate(pairs)]
    )
    cells = [F.struct(F.lit(c).alias("left"), F.lit(c).alias("right"), F.lit(1.0).alias("r")) for c in columns]
    for i, (a, b) in enumerate(pairs):
        cells += [F.struct(F.lit(x).alias("left"), F.lit(y).alias("right"), F.col(f"_{i}").alias("r")) for x, y in ((a, b), (b, a))]
    return whole.select(*by, "n_complete", F.inline(F.array(*cells)))


def correlation_by_group(df: DataFrame, by: str, left: str, right: str, above: int = 30) -> DataFrame:
    """Correlation per group with more than ``above`` complete cases."""
    complete = df.dropna(subset=[left, right])
    stats = complete.groupBy(by).agg(correlation(F.col(left), F.col(right)).alias("r"), F.count(F.lit(1)).alias("n"))
    return stats.where(F.col("n") > above)


def linear_trend(df: DataFrame, x: str, y: str, by: Sequence[str] = (), points: int | None = None) -> DataFrame:
    """Least-squares line per group; with ``points``, that many evenly spaced
    positions on it between the smallest and the largest x."""
    fit = df.dropna(subset=[x, y]).groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.min(x).alias("x_min"), F.max(x).alias("x_max"), F.count(F.lit(1)).alias("n"),
    )
    if points is None:
        return fit
    step = (F.col("x_max") - F.col("x_min")) / F.lit(points - 1)
    along = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    along = along.withColumn("x", F.col("x_min") + F.col("point") * step)
    return along.select(*by, "point", "x", (F.col("intercept") + F.col("slope") * F.col("x")).alias("y"))


def iqr_outliers(df: DataFrame, value: str = Y, by: Sequence[str] = ("crop",)) -> DataFrame:
    """Bounds at 1.5 interquartile ranges beyond the quartiles, and how many
    values fall outside them."""
    cuts = exact_quantiles(df, value, [0.25, 0.75], by)
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[1]
    bounds = settle(cuts.select(*by, (q1 - 1.5 * (q3 - q1)).alias("lower_bound"), (q3 + 1.5 * (q3 - q1)).alias("upper_bound")))
    outside = (F.col(value) < F.col("lower_bound")) | (F.col(value) > F.col("upper_bound"))
    kept = df.select(*by, value).where(F.col(value).isNotNull())
    return (
        kept.join(bounds, list(by))
        .groupBy(*by)
        .agg(
            F.max("lower_bound").alias("lower_bound"), F.max("upper_bound").alias("upper_bound"),
            F.count_if(outside).alias("outlier_count"), F.count(F.lit(1)).alias("n"),
        )
        .withColumn("outlier_pct", F.bround(F.lit(100.0) * F.col("outlier_count") / F.col("n"), 2))
    )


def mean_interval(df: DataFrame, value: str = Y, by: Sequence[str] = ("crop",), confidence: float = 0.95) -> DataFrame:
    """Mean with its normal-approximation confidence interval."""
    stats = df.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("_s"))
    half = F.lit(normal_quantile(confidence)) * F.col("_s") / F.sqrt("n")
    return stats.select(*by, "n", "mean", (F.col("mean") - half).alias("ci_low"), (F.col("mean") + half).alias("ci_high"))


def welch_test(df: DataFrame, split_year: int, value: str = Y, by: Sequence[str] = ("crop",), alpha: float = 0.05) -> DataFrame:
    """Unequal-variance t-test of the years before against those from ``split_year``."""
    before, after = F.col("year") < split_year, F.col("year") >= split_year
    sides = {"before": F.when(before, F.col(value)), "after": F.when(after, F.col(value))}
    stats = df.groupBy(*by).agg(
        *[f(v).alias(f"{side}_{name}") for side, v in sides.items() for name, f in (("mean", F.avg), ("n", F.count), ("var", F.var_samp))]
    )
    share_b = safe_ratio(F.col("before_var"), F.col("before_n"))
    share_a = safe_ratio(F.col("after_var"), F.col("after_n"))
    freedom = safe_ratio(
        F.pow(share_b + share_a, 2),
        safe_ratio(F.pow(share_b, 2), F.col("before_n") - 1) + safe_ratio(F.pow(share_a, 2), F.col("after_n") - 1),
    )
    tested = stats.select(
        *by, "before_mean", "after_mean", "before_n", "after_n",
        safe_ratio(F.col("before_mean") - F.col("after_mean"), F.sqrt(share_b + share_a)).alias("t_statistic"),
        freedom.alias("degrees_of_freedom"),
    )
    tested = tested.withColumn("p_value", t_p_value(F.col("t_statistic"), F.col("degrees_of_freedom")))
    return tested.withColumn("significant", F.col("p_value") < alpha)
