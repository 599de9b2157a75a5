"""Drift, the retrain rule and run roll-ups (X-7 to X-10, M-22, A-24)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.models.baseline import HistoricalMean
from furrow.operators import drift as d
from furrow.operators.evaluation import metrics_by_period
from furrow.plans.batch import roll_up
from furrow.plans.bound.gate import _SCORES
from furrow.plans.bound.registry import bound, rounded
from furrow.plans.bound.tables import CUTOFF, SPLIT, TRAIN_CTES, Tables, on_curated
from furrow.plans.curate import SOURCES
from furrow.session import settle

_SAMPLES = "samples AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, year >= {CUTOFF} AS cur FROM feat" for c in ("rainfall_mm", "pesticides_tonnes", "lag1_yield")
) + f" UNION ALL SELECT 'avg_temp_c', round(avg_temp_c, 6), year >= {CUTOFF} FROM feat)"

_PREDICTED = f"samples AS (SELECT 'prediction' AS feature, round(prediction, 4) AS value, year >= {SPLIT} AS cur FROM base)"

_PSI_CTES = """
edges AS (SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM samples WHERE NOT cur GROUP BY feature),
binned AS (SELECT s.feature, len(list_filter(e, lambda x: x <= s.value)) AS bin, count(*) FILTER (WHERE NOT cur) AS r, count(*) FILTER (WHERE cur) AS c
           FROM samples s JOIN edges g ON s.feature = g.feature GROUP BY 1, 2),
shares AS (SELECT g.feature, i.bin, greatest(coalesce(r, 0) / (SELECT sum(r) FROM binned t WHERE t.feature = g.feature), 1e-6) AS r,
                  greatest(coalesce(c, 0) / (SELECT sum(c) FROM binned t WHERE t.feature = g.feature), 1e-6) AS c
           FROM edges g CROSS JOIN range(10) i(bin) LEFT JOIN binned b ON b.feature = g.feature AND b.bin = i.bin),
psi AS (SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM shares GROUP BY feature)"""

_KS_CTES = """
folded AS (SELECT feature, value, count(*) FILTER (WHERE NOT cur) AS r, count(*) FILTER (WHERE cur) AS c FROM samples GROUP BY 1, 2),
cdf AS (SELECT feature, sum(r) OVER w / sum(r) OVER (PARTITION BY feature) AS fr, sum(c) OVER w / sum(c) OVER (PARTITION BY feature) AS fc
        FROM folded WINDOW w AS (PARTITION BY feature ORDER BY value)),
ks AS (SELECT feature, max(abs(fr - fc)) AS ks_statistic FROM cdf GROUP BY feature)"""

_LABEL = "CASE WHEN psi < 0.1 THEN 'no significant shift' WHEN psi < 0.25 THEN 'moderate shift' ELSE 'significant shift' END"


def _ctes(samples: str) -> str:
    return ", ".join([TRAIN_CTES, samples, _PSI_CTES, _KS_CTES])


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The drift features of both periods; temperatures rounded as in the SQL."""
    return tuple(rows.select(*d.DRIFT_FEATURES[:1], F.round("avg_temp_c", 6).alias("avg_temp_c"), *d.DRIFT_FEATURES[2:]) for rows in t.features)


@bound("x7_population_stability", on_curated("SELECT feature, round(psi, 6) AS psi FROM psi", _ctes(_SAMPLES)))
def x7(t: Tables) -> DataFrame:
    return rounded(d.population_stability(d.value_counts(*_sides(t), d.DRIFT_FEATURES)), 6, "psi")


@bound("x8_ks_two_sample", on_curated("SELECT feature, round(ks_statistic, 8) AS ks_statistic FROM ks", _ctes(_SAMPLES)))
def x8(t: Tables) -> DataFrame:
    told = d.ks_two_sample(d.value_counts(*_sides(t), d.DRIFT_FEATURES))
    return rounded(told.select("feature", "ks_statistic"), 8, "ks_statistic")


# Kolmogorov's series; a hundred terms settle it from a scaled distance of 0.1 on.
@bound("x8_ks_p_value_series", on_curated("""
    SELECT feature, round(least(1, greatest(0, 2 * sum((-1) ** (i - 1) * exp(-2 * i * i * x * x)))), 5) AS ks_pvalue
    FROM (SELECT k.feature, ks_statistic * sqrt(n.r * n.c / (n.r + n.c)) AS x
          FROM ks k JOIN (SELECT feature, CAST(sum(r) AS DOUBLE) AS r, CAST(sum(c) AS DOUBLE) AS c FROM folded WHERE value IS NOT NULL GROUP BY feature) n USING (feature)) s,
         range(1, 101) g(i) GROUP BY feature""", _ctes(_SAMPLES)))
def x8_series(t: Tables) -> DataFrame:
    return rounded(d.ks_two_sample(d.value_counts(*_sides(t), d.DRIFT_FEATURES), exact_up_to=0).select("feature", "ks_pvalue"), 5, "ks_pvalue")


@bound("x8_ks_p_values", on_curated("""
    SELECT feature, any_value(d) AS ks_statistic, round(least(1, greatest(0, 2 * sum((-1) ** (i - 1) * exp(-2 * i * i * x * x)))), 5) AS ks_pvalue
    FROM (SELECT k.feature, round(ks_statistic, 8) AS d, ks_statistic * sqrt(n.r * n.c / (n.r + n.c)) AS x
          FROM ks k JOIN (SELECT feature, CAST(sum(r) AS DOUBLE) AS r, CAST(sum(c) AS DOUBLE) AS c FROM folded WHERE value IS NOT NULL GROUP BY feature) n USING (feature)) s,
         range(1, 101) g(i) GROUP BY feature""", _ctes(_SAMPLES)))
def x8_p(t: Tables) -> DataFrame:
    return rounded(d.ks_two_sample(d.value_counts(*_sides(t), d.DRIFT_FEATURES), exact_up_to=0).select("feature", "ks_statistic", "ks_pvalue"), 5, "ks_pvalue").withColumn("ks_statistic", F.round("ks_statistic", 8))


# Balances of the suppliers of nation 0 against those of each other nation. The walk on the
# lattice of ranks, diagonal by diagonal, as a share of all walks.
_BALANCES = """vals AS (SELECT k AS f, s_acctbal AS v, 1 AS r, 0 AS c FROM supplier, range(1, 25) g(k) WHERE s_nationkey = 0
    UNION ALL SELECT s_nationkey, s_acctbal, 0, 1 FROM supplier WHERE s_nationkey > 0),
folded AS (SELECT f, v, sum(r) AS r, sum(c) AS c FROM vals GROUP BY 1, 2),
placed AS (SELECT f, sum(r) OVER w AS r, sum(c) OVER w AS c, sum(r) OVER (PARTITION BY f) AS n, sum(c) OVER (PARTITION BY f) AS m
    FROM folded WINDOW w AS (PARTITION BY f ORDER BY v ROWS UNBOUNDED PRECEDING)),
asked AS (SELECT f, CAST(max(n) AS BIGINT) AS n, CAST(max(m) AS BIGINT) AS m, CAST(max(abs(r * m - c * n)) AS BIGINT) AS reach FROM placed GROUP BY f HAVING max(n) > 0 AND max(m) > 0),
walk(f, s, i, share) AS (
    SELECT f, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS DOUBLE) FROM asked
    UNION ALL
    SELECT f, s, i, sum(part) FROM (
        SELECT w.f, w.s + 1 AS s, w.i + d.up AS i, w.share * CASE d.up WHEN 1 THEN w.i + 1 ELSE w.s + 1 - w.i END / (w.s + 1) AS part
        FROM walk w JOIN asked a ON w.f = a.f, (VALUES (0), (1)) d(up)
        WHERE w.s < a.n + a.m AND w.i + d.up <= a.n AND w.s + 1 - w.i - d.up <= a.m AND abs((w.i + d.up) * a.m - (w.s + 1 - w.i - d.up) * a.n) < a.reach) x
    GROUP BY f, s, i)"""


@bound("x8_exact_p_values", f"""WITH RECURSIVE {_BALANCES}
    SELECT CAST(a.f AS VARCHAR) AS feature, n AS n_reference, m AS n_current, round(1 - coalesce(share, 0), 6) AS ks_pvalue
    FROM asked a LEFT JOIN walk w ON w.f = a.f AND w.s = a.n + a.m AND w.i = a.n""")
def x8_exact(t: Tables) -> DataFrame:
    suppliers = t.table("supplier").select("s_nationkey", F.col("s_acctbal").cast("double").alias("value"))
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    ours = suppliers.where("s_nationkey = 0").select(F.explode(F.sequence(F.lit(1), F.lit(24))).alias("k"), "value", one.alias("r"), none.alias("c"))
    theirs = suppliers.where("s_nationkey > 0").select(F.col("s_nationkey").cast("int").alias("k"), "value", none.alias("r"), one.alias("c"))
    counts = ours.unionByName(theirs).groupBy(F.col("k").cast("string").alias("feature"), "value").agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    told = d.ks_two_sample(settle(counts)).where("ks_statistic is not null").select("feature", "n_reference", "n_current", "ks_pvalue")
    return rounded(told, 6, "ks_pvalue")


@bound("x9_drift_report", on_curated(f"""
    SELECT p.feature, round(psi, 4) AS psi, {_LABEL} AS psi_interpretation, round(ks_statistic, 4) AS ks_statistic,
           (SELECT round(avg(value), 2) FROM samples s WHERE s.feature = p.feature AND NOT cur) AS reference_mean,
           (SELECT round(avg(value), 2) FROM samples s WHERE s.feature = p.feature AND cur) AS current_mean
    FROM psi p JOIN ks k ON p.feature = k.feature""", _ctes(_SAMPLES)))
def x9(t: Tables) -> DataFrame:
    return d.drift_report(*_sides(t)).drop("ks_pvalue")


def _predicted(t: Tables) -> DataFrame:
    return HistoricalMean.fit(t.split[0]).predict(t.settled).withColumn("prediction", F.round("prediction", 4))


@bound("x10_prediction_drift", on_curated(f"""
    SELECT p.feature, round(psi, 4) AS psi, {_LABEL} AS psi_interpretation, round(ks_statistic, 4) AS ks_statistic,
           (SELECT round(avg(value), 1) FROM samples WHERE NOT cur) AS reference_mean, (SELECT round(avg(value), 1) FROM samples WHERE cur) AS current_mean
    FROM psi p JOIN ks k ON p.feature = k.feature""", _ctes(_PREDICTED)))
def x10(t: Tables) -> DataFrame:
    return d.prediction_drift(_predicted(t), SPLIT - 1).drop("ks_pvalue")


@bound("m22_retrain_verdict", on_curated("""
    SELECT round(max_by(r2, period_start) - min_by(r2, period_start), 4) AS r2_change, round(min(r2), 4) AS min_r2,
           CASE WHEN abs(max_by(r2, period_start) - min_by(r2, period_start)) < 0.02 THEN 'held up'
                WHEN max_by(r2, period_start) < min_by(r2, period_start) THEN 'degraded' ELSE 'improved' END AS r2_trend,
           coalesce((SELECT string_agg(feature, ',' ORDER BY feature) FROM psi WHERE round(psi, 4) >= 0.25), '') AS drifted,
           CAST(min(r2) < 0.85 OR EXISTS (SELECT 1 FROM psi WHERE round(psi, 4) >= 0.25) AS BIGINT) AS retrain
    FROM (SELECT CAST(floor(year / 3.0) * 3 AS BIGINT) AS period_start, round(1 - avg((yield_hg_ha - round(prediction, 4)) ** 2) / var_pop(yield_hg_ha), 4) AS r2
          FROM base GROUP BY 1) m""", _ctes(_SAMPLES)))
def m22(t: Tables) -> DataFrame:
    told = d.retrain_verdict(d.drift_report(*_sides(t)), metrics_by_period(_predicted(t)))
    named = told.withColumn("drifted", F.concat_ws(",", "drifted_features")).drop("drifted_features")
    return rounded(named, 4, "r2_change", "min_r2")


@bound("a24_stage_roll_up", f"""
    SELECT 'this run' AS run_id, CAST(sum(total_records) AS BIGINT) AS records_received, CAST(sum(accepted_records) AS BIGINT) AS records_accepted,
           CAST(sum(rejected_records) AS BIGINT) AS records_rejected, round(100.0 * sum(accepted_records) / sum(total_records), 2) AS overall_quality_score_pct
    FROM ({_SCORES}) s""")
def a24(t: Tables) -> DataFrame:
    reports = reduce(DataFrame.unionByName, [t.gate(s).report() for s in SOURCES])
    return roll_up(reports.select(
        F.lit("this run").alias("run_id"), F.col("total_records").alias("received"),
        F.col("accepted_records").alias("accepted"), F.col("rejected_records").alias("rejected"),
    ))
