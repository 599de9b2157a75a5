"""How far a later population has moved from the one a model was trained on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.functions.distributions import EXACT_UP_TO, ks_p_value
from furrow.functions.numeric import band, flag, safe_ratio
from furrow.operators.features import long_form
from furrow.operators.ordered import exact_quantiles, running_totals
from furrow.session import settle

# The watched features and the thresholds of the verdicts.
DRIFT_FEATURES = ("rainfall_mm", "avg_temp_c", "pesticides_tonnes", "lag1_yield")
PSI_NO_SHIFT, PSI_MODERATE_SHIFT = 0.1, 0.25
SMALLEST_SHARE = 1e-6
R2_MARGIN, LOWEST_R2 = 0.02, 0.85


def shift_label(psi: Column) -> Column:
    return band(psi, [(PSI_NO_SHIFT, "no significant shift"), (PSI_MODERATE_SHIFT, "moderate shift")], "significant shift")


def value_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value of each column occurs in either population, as
    (feature, value, n_ref, n_cur). Everything below works on this table, so the
    rows themselves are read once."""
    left = long_form(reference, tuple(columns)).withColumn("_cur", F.lit(0))
    both = left.unionByName(long_form(current, tuple(columns)).withColumn("_cur", F.lit(1)))
    return settle(both.groupBy("feature", "value").agg(F.sum(1 - F.col("_cur")).alias("n_ref"), F.sum("_cur").alias("n_cur")))


def population_stability(counts: DataFrame, bins: int = 10) -> DataFrame:
    """PSI per feature over equal-count bins of the reference population.

    Bin edges that coincide are kept, which leaves the bins between them empty;
    an empty bin counts as a share of one in a million on that side.
    """
    inner = [i / bins for i in range(1, bins)]
    edges = exact_quantiles(counts, "value", inner, ["feature"], times="n_ref").select("feature", F.col("quantiles").alias("_edges"))
    # One row per watched column, whatever the data size.
    placed = counts.join(F.broadcast(edges), "feature").withColumn(
        "bin", F.size(F.filter("_edges", lambda e: e <= F.col("value")))
    )
    counted = placed.groupBy("feature", "bin").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    totals = counted.groupBy("feature").agg(F.sum("n_ref").alias("_ref"), F.sum("n_cur").alias("_cur"))
    grid = edges.select("feature", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(counted, ["feature", "bin"], "left").join(totals, "feature")

    def portion(n: str, total: str) -> Column:
        return F.greatest(F.coalesce(F.try_divide(F.coalesce(F.col(n), F.lit(0)).cast("double"), F.col(total)), F.lit(0.0)), F.lit(SMALLEST_SHARE))

    ref, cur = portion("n_ref", "_ref"), portion("n_cur", "_cur")
    return full.groupBy("feature").agg(F.sum((cur - ref) * F.log(cur / ref)).alias("psi"))


def ks_two_sample(counts: DataFrame, exact_up_to: int = EXACT_UP_TO) -> DataFrame:
    """Largest distance between the two empirical distribution functions, per feature, and
    its p-value: exact for samples up to a size, from the limit distribution beyond."""
    ranked = running_totals(counts, ["value"], ["n_ref", "n_cur"], ["feature"])
    left = F.try_divide((F.col("n_ref_before") + F.col("n_ref")).cast("double"), F.col("n_ref_total"))
    right = F.try_divide((F.col("n_cur_before") + F.col("n_cur")).cast("double"), F.col("n_cur_total"))
    gaps = ranked.groupBy("feature").agg(
        F.max(F.abs(left - right)).alias("ks_statistic"),
        F.max("n_ref_total").alias("n_reference"), F.max("n_cur_total").alias("n_current"),
    )
    return gaps.withColumn("ks_pvalue", ks_p_value(F.col("ks_statistic"), F.col("n_reference"), F.col("n_current"), exact_up_to))


def sample_means(counts: DataFrame) -> DataFrame:
    def mean(n: str) -> Column:
        return safe_ratio(F.sum(F.col("value") * F.col(n)), F.sum(n))

    return counts.groupBy("feature").agg(mean("n_ref").alias("reference_mean"), mean("n_cur").alias("current_mean"))


def drift_report(reference: DataFrame, current: DataFrame, columns: Sequence[str] = DRIFT_FEATURES, mean_places: int = 2) -> DataFrame:
    counts = value_counts(reference, current, columns)
    joined = population_stability(counts).join(ks_two_sample(counts), "feature").join(sample_means(counts), "feature")
    return joined.select(
        "feature",
        F.bround("psi", 4).alias("psi"),
        shift_label(F.col("psi")).alias("psi_interpretation"),
        F.bround("ks_statistic", 4).alias("ks_statistic"),
        "ks_pvalue",
        F.bround("reference_mean", mean_places).alias("reference_mean"),
        F.bround("current_mean", mean_places).alias("current_mean"),
    )


def prediction_drift(scored: DataFrame, last_early_year: int, prediction: str = "prediction") -> DataFrame:
    """The same report for one model's predictions, early years against late ones."""
    early = scored.where(F.col("year") <= last_early_year)
    late = scored.where(F.col("year") > last_early_year)
    return drift_report(early, late, [prediction], mean_places=1)


def retrain_verdict(drift: DataFrame, periods: DataFrame) -> DataFrame:
    """One row: the R2 trend over the periods and whether to train again.

    Both inputs are reports, one row per watched feature and one per period.
    """
    moved = drift.agg(
        F.array_sort(F.collect_list(F.when(F.col("psi") >= PSI_MODERATE_SHIFT, F.col("feature")))).alias("drifted_features")
    ).select(F.struct("drifted_features").alias("d"))
    trend = periods.agg(
        (F.max_by("r2", "period_start") - F.min_by("r2", "period_start")).alias("r2_change"), F.min("r2").alias("min_r2")
    ).withColumn("_d", moved.scalar())
    verdict = F.when(F.abs("r2_change") < R2_MARGIN, "held up").when(F.col("r2_change") < 0, "degraded").otherwise("improved")
    return trend.select(
        "r2_change", verdict.alias("r2_trend"), "min_r2", F.col("_d.drifted_features").alias("drifted_features"),
        flag((F.size("_d.drifted_features") > 0) | (F.col("min_r2") < LOWEST_R2)).alias("retrain"),
    )
