"""Aggregates, windows, rankings and statistics over the curated table (A, W, T, U-3, X)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions.distributions import normal_quantile
from furrow.functions.numeric import period_start, share
from furrow.operators import aggregates as a
from furrow.operators import statistics as x
from furrow.operators.features import CONDITIONS
from furrow.operators.ordered import exact_quantiles, rows_at
from furrow.plans.bound.registry import bound, rounded
from furrow.models.risk import label_risk, risk_thresholds
from furrow.plans.bound.tables import LINE_SQL, SPLIT, TRAIN_CTES, Tables, on_curated, plain
from furrow.plans.curate import MATCHED

Y = "yield_hg_ha"


@bound("a1_mean_of_crop", on_curated("SELECT 'Maize' AS crop, round(avg(yield_hg_ha), 4) AS mean_yield, count(*) AS n FROM curated WHERE crop = 'Maize'"))
def a1(t: Tables) -> DataFrame:
    return rounded(a.mean_of_crop(t.curated, "Maize"), 4, "mean_yield")


@bound("a2_largest_record", on_curated("SELECT area, crop, year, yield_hg_ha FROM curated WHERE crop = 'Maize' ORDER BY yield_hg_ha DESC, area, year LIMIT 1"))
def a2(t: Tables) -> DataFrame:
    return a.largest_record(t.curated, "Maize").select("area", "crop", "year", Y)


@bound("a3_mean_by_area", on_curated("SELECT area, round(avg(yield_hg_ha), 4) AS mean, count(*) AS n FROM curated WHERE crop = 'Maize' GROUP BY area"))
def a3(t: Tables) -> DataFrame:
    return rounded(a.group_mean(t.curated.where("crop = 'Maize'"), ["area"]), 4, "mean")


@bound("a9_match_rate", on_curated("""
    SELECT crop, round(100.0 * count(rainfall_mm) / count(*), 4) AS rainfall_pct, round(100.0 * count(pesticides_tonnes) / count(*), 4) AS pesticides_pct
    FROM curated GROUP BY crop"""))
def a9(t: Tables) -> DataFrame:
    rates = t.curated.groupBy("crop").agg(
        share(F.col("rainfall_mm").isNotNull()).alias("rainfall_pct"), share(F.col("pesticides_tonnes").isNotNull()).alias("pesticides_pct")
    )
    return rounded(rates, 4, "rainfall_pct", "pesticides_pct")


@bound("a10_coverage_by_decade", on_curated("""
    SELECT CAST(floor(year / 10.0) * 10 AS BIGINT) AS period, round(100.0 * count(pesticides_tonnes) / count(*), 4) AS pesticides_tonnes_coverage_pct,
           round(100.0 * count(rainfall_mm) / count(*), 4) AS rainfall_mm_coverage_pct, round(100.0 * count(avg_temp_c) / count(*), 4) AS avg_temp_c_coverage_pct
    FROM curated GROUP BY 1"""))
def a10(t: Tables) -> DataFrame:
    return rounded(a.coverage_by_period(t.curated, list(MATCHED)), 4, *[f"{c}_coverage_pct" for c in MATCHED])


@bound("a11_mean_by_decade_and_crop", on_curated("""
    SELECT CAST(floor(year / 10.0) * 10 AS BIGINT) AS decade, crop, round(avg(yield_hg_ha), 4) AS mean, count(*) AS n FROM curated GROUP BY 1, 2"""))
def a11(t: Tables) -> DataFrame:
    return rounded(a.group_mean(t.curated.withColumn("decade", period_start(F.col("year"), 10)), ["decade", "crop"]), 4, "mean")


@bound("a11_top_areas", on_curated("""
    SELECT area, round(avg(yield_hg_ha), 4) AS mean, count(*) AS n FROM curated GROUP BY 1 ORDER BY avg(yield_hg_ha) DESC, area LIMIT 10"""))
def a11_top(t: Tables) -> DataFrame:
    return rounded(a.group_mean(t.curated, ["area"]).orderBy(F.desc("mean"), "area").limit(10), 4, "mean")


_DESCRIBE = """count(yield_hg_ha) AS "count", round(avg(yield_hg_ha), 4) AS mean, round(stddev_samp(yield_hg_ha), 4) AS std, min(yield_hg_ha) AS "min",
    round(quantile_cont(yield_hg_ha, 0.25), 4) AS p25, round(quantile_cont(yield_hg_ha, 0.5), 4) AS median, round(quantile_cont(yield_hg_ha, 0.75), 4) AS p75, max(yield_hg_ha) AS "max" """


@bound("a12_describe", on_curated(f"SELECT {_DESCRIBE} FROM curated"))
def a12(t: Tables) -> DataFrame:
    return rounded(x.describe(t.curated), 4, "mean", "std", "p25", "median", "p75")


@bound("a12_describe_line_values", """
    SELECT l_returnflag, count(*) AS "count", round(quantile_cont(l_extendedprice, 0.25), 4) AS p25,
           round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.75), 4) AS p75
    FROM lineitem GROUP BY 1""")
def a12_lines(t: Tables) -> DataFrame:
    told = x.describe(t.table("lineitem"), "l_extendedprice", ["l_returnflag"])
    return rounded(told.select("l_returnflag", "count", "p25", "median", "p75"), 4, "p25", "median", "p75")


@bound("a13_array_summary", on_curated("""
    SELECT crop, count(yield_hg_ha) AS "count", round(avg(yield_hg_ha), 4) AS mean, round(stddev_pop(yield_hg_ha), 4) AS std,
           min(yield_hg_ha) AS "min", max(yield_hg_ha) AS "max" FROM curated GROUP BY crop"""))
def a13(t: Tables) -> DataFrame:
    return rounded(x.array_summary(t.curated, by=["crop"]), 4, "mean", "std")


@bound("a14_distribution", on_curated("""
    SELECT crop, count(yield_hg_ha) AS "count", round(avg(yield_hg_ha), 4) AS mean, round(var_samp(yield_hg_ha), 0) AS variance,
           round(stddev_samp(yield_hg_ha), 4) AS std, round(skewness(yield_hg_ha), 6) AS skew,
           round(quantile_cont(yield_hg_ha, 0.1), 4) AS p10, round(quantile_cont(yield_hg_ha, 0.25), 4) AS p25, round(quantile_cont(yield_hg_ha, 0.5), 4) AS median,
           round(quantile_cont(yield_hg_ha, 0.75), 4) AS p75, round(quantile_cont(yield_hg_ha, 0.9), 4) AS p90
    FROM curated GROUP BY crop"""))
def a14(t: Tables) -> DataFrame:
    told = rounded(x.distribution(t.curated), 4, "mean", "std", "p10", "p25", "median", "p75", "p90")
    return rounded(rounded(told, 0, "variance"), 6, "skew")


_REGIONAL = """
    SELECT r.crop, r.area, round(r.m, 4) AS mean, r.n AS "count", round((r.m - g.m) / g.s, 6) AS z_vs_global
    FROM (SELECT crop, area, avg(yield_hg_ha) AS m, count(*) AS n FROM curated GROUP BY 1, 2) r
    JOIN (SELECT crop, avg(yield_hg_ha) AS m, stddev_samp(yield_hg_ha) AS s FROM curated GROUP BY 1) g ON r.crop = g.crop"""


@bound("a15_regional_averages", on_curated(_REGIONAL))
def a15(t: Tables) -> DataFrame:
    return rounded(rounded(x.regional_averages(t.curated, top=None), 4, "mean"), 6, "z_vs_global")


@bound("a15_regional_averages_top", on_curated(_REGIONAL + " QUALIFY row_number() OVER (PARTITION BY r.crop ORDER BY r.m DESC, r.area) <= 10"))
def a15_top(t: Tables) -> DataFrame:
    return rounded(rounded(x.regional_averages(t.curated), 4, "mean"), 6, "z_vs_global")


@bound("a19_key_figures", on_curated("""
    SELECT count(*) AS n_rows, count(DISTINCT crop) AS n_crops, count(DISTINCT area) AS n_areas, round(avg(yield_hg_ha), 4) AS mean_yield,
           round(avg(label), 8) AS high_risk_rate FROM risk""", TRAIN_CTES))
def a19(t: Tables) -> DataFrame:
    labelled = label_risk(t.settled, risk_thresholds(t.split[0]))
    return rounded(rounded(a.key_figures(labelled, "label"), 4, "mean_yield"), 8, "high_risk_rate")


@bound("a19_key_figures_from_sketches", on_curated("""
    SELECT count(*) AS n_rows, round(avg(yield_hg_ha), 4) AS mean_yield, true AS crops_within_bound, true AS areas_within_bound FROM curated"""))
def a19_sketches(t: Tables) -> DataFrame:
    """Merged over years, and within three standard errors of the exact counts."""
    near = a.merged_key_figures(a.key_figure_sketches(t.settled, ["year"]))
    exact = a.key_figures(t.settled).select(F.col("n_crops").alias("c"), F.col("n_areas").alias("r"))
    bound_of = 3 * 1.04 / 2 ** 6
    told = near.crossJoin(exact).select(
        "n_rows", "mean_yield",
        (F.abs(F.col("n_crops") - F.col("c")) <= bound_of * F.col("c")).alias("crops_within_bound"),
        (F.abs(F.col("n_areas") - F.col("r")) <= bound_of * F.col("r")).alias("areas_within_bound"),
    )
    return rounded(told, 4, "mean_yield")


# ---- windows and rankings -----------------------------------------------------------------

_Z = """z AS (SELECT c.*, (yield_hg_ha - m) / s AS z FROM curated c
    JOIN (SELECT crop AS k, avg(yield_hg_ha) AS m, stddev_samp(yield_hg_ha) AS s FROM curated GROUP BY crop) g ON c.crop = g.k)"""


@bound("w4_crop_z_scores", on_curated("SELECT area, crop, year, round(z, 6) AS z FROM z", _Z))
def w4(t: Tables) -> DataFrame:
    return rounded(x.crop_z_scores(t.curated).select("area", "crop", "year", "z"), 6, "z")


@bound("w5_global_z_scores", on_curated("""
    SELECT area, crop, year, round((yield_hg_ha - (SELECT avg(yield_hg_ha) FROM curated)) / (SELECT stddev_pop(yield_hg_ha) FROM curated), 6) AS z FROM curated"""))
def w5(t: Tables) -> DataFrame:
    return rounded(x.global_z_scores(t.curated).select("area", "crop", "year", "z"), 6, "z")


@bound("w5_count_beyond", on_curated("""
    SELECT CAST(sum(CAST((yield_hg_ha - m) / s > 2 AS BIGINT)) AS BIGINT) AS n_beyond,
           round(avg(CAST((yield_hg_ha - m) / s > 2 AS BIGINT)), 8) AS beyond_rate
    FROM curated, (SELECT avg(yield_hg_ha) AS m, stddev_pop(yield_hg_ha) AS s FROM curated) g"""))
def w5_count(t: Tables) -> DataFrame:
    return rounded(a.condition_rate(x.global_z_scores(t.curated), F.col("z") > 2, "beyond"), 8, "beyond_rate")


@bound("w6_mean_z_by_area", on_curated("SELECT area, round(avg(z), 6) AS mean_z FROM z GROUP BY area", _Z))
def w6(t: Tables) -> DataFrame:
    return rounded(x.mean_z_by(t.curated, ["area"]), 6, "mean_z")


@bound("u3_best_and_worst_areas", on_curated("""
    SELECT * FROM (SELECT area, round(avg(z), 6) AS mean_z, 'top' AS side FROM z GROUP BY area ORDER BY avg(z) DESC, area LIMIT 8) a
    UNION ALL SELECT * FROM (SELECT area, round(avg(z), 6) AS mean_z, 'bottom' AS side FROM z GROUP BY area ORDER BY avg(z), area LIMIT 5) b""", _Z))
def u3(t: Tables) -> DataFrame:
    return rounded(a.best_and_worst(x.mean_z_by(t.curated, ["area"]), "mean_z", "area", 8, 5), 6, "mean_z")


@bound("w7_duplicate_ordinal", f"""
    SELECT country, yr AS year, count(*) AS n_later_copies FROM (
        SELECT *, row_number() OVER (PARTITION BY yr, country, avg_temp) AS copy FROM ({plain(LINE_SQL["temp"])}) l) n
    WHERE copy > 1 GROUP BY 1, 2""")
def w7(t: Tables) -> DataFrame:
    later = t.gate("temp").rejected().where(F.array_contains(F.split("reject_reason", ";"), "duplicate_row"))
    return later.groupBy("country", "year").agg(F.count(F.lit(1)).alias("n_later_copies"))


@bound("t3_top_and_bottom_groups", on_curated("""
    SELECT * FROM (SELECT area, count(*) AS n, 'top' AS side FROM curated GROUP BY area ORDER BY n DESC, area LIMIT 5) a
    UNION ALL SELECT * FROM (SELECT area, count(*) AS n, 'bottom' AS side FROM curated GROUP BY area ORDER BY n, area LIMIT 5) b"""))
def t3(t: Tables) -> DataFrame:
    return a.best_and_worst(a.label_counts(t.curated, "area"), "n", "area", 5, 5)


@bound("t4_by_absolute_value", on_curated("SELECT area, crop, year, round(z, 6) AS z FROM z ORDER BY abs(z) DESC, area, crop, year LIMIT 6", _Z))
def t4(t: Tables) -> DataFrame:
    top = x.crop_z_scores(t.curated).orderBy(F.abs("z").desc(), "area", "crop", "year").limit(6)
    return rounded(top.select("area", "crop", "year", "z"), 6, "z")


@bound("t5_rows_at_positions", on_curated("""
    SELECT area, crop, year, yield_hg_ha, position FROM (
        SELECT *, row_number() OVER (ORDER BY yield_hg_ha, area, crop, year) - 1 AS position, count(*) OVER () AS n FROM curated) o
    WHERE position IN (n // 10, n - n // 10)"""))
def t5(t: Tables) -> DataFrame:
    tenth = F.floor(F.col("_one_total") / 10)
    keyed = t.curated.select("area", "crop", "year", Y)
    return rows_at(keyed, [Y, "area", "crop", "year"], [tenth, F.col("_one_total") - tenth]).drop("_one_total")


# ---- statistics ---------------------------------------------------------------------------

_FOUR = [Y, *CONDITIONS]


@bound("x1_correlation_matrix", on_curated(" UNION ALL ".join(
    f"SELECT count(*) AS n_complete, '{left}' AS \"left\", '{right}' AS \"right\", round(corr({left}, {right}), 6) AS r FROM complete"
    if left != right else f"SELECT count(*) AS n_complete, '{left}' AS \"left\", '{right}' AS \"right\", CAST(1 AS DOUBLE) AS r FROM complete"
    for left in _FOUR for right in _FOUR),
    "complete AS (SELECT * FROM curated WHERE rainfall_mm IS NOT NULL AND avg_temp_c IS NOT NULL AND pesticides_tonnes IS NOT NULL)"))
def x1(t: Tables) -> DataFrame:
    return rounded(x.correlation_matrix(t.curated, _FOUR), 6, "r")


@bound("x2_correlation_by_crop", on_curated("""
    SELECT crop, round(corr(rainfall_mm, yield_hg_ha), 6) AS r, count(*) AS n FROM curated WHERE rainfall_mm IS NOT NULL GROUP BY crop HAVING count(*) > 30"""))
def x2(t: Tables) -> DataFrame:
    return rounded(x.correlation_by_group(t.curated, "crop", "rainfall_mm", Y), 6, "r")


@bound("x3_linear_trend", on_curated("""
    SELECT crop, round(regr_slope(yield_hg_ha, rainfall_mm), 6) AS slope, round(regr_intercept(yield_hg_ha, rainfall_mm), 3) AS intercept,
           min(rainfall_mm) AS x_min, max(rainfall_mm) AS x_max, count(*) AS n
    FROM curated WHERE rainfall_mm IS NOT NULL GROUP BY crop"""))
def x3(t: Tables) -> DataFrame:
    return rounded(rounded(x.linear_trend(t.curated, "rainfall_mm", Y, ["crop"]), 6, "slope"), 3, "intercept")


@bound("x3_trend_points", on_curated("""
    SELECT crop, CAST(i AS BIGINT) AS point, round(a + i * (b - a) / 99, 6) AS x, round(c + s * (a + i * (b - a) / 99), 3) AS y
    FROM (SELECT crop, regr_slope(yield_hg_ha, rainfall_mm) AS s, regr_intercept(yield_hg_ha, rainfall_mm) AS c, min(rainfall_mm) AS a, max(rainfall_mm) AS b
          FROM curated WHERE rainfall_mm IS NOT NULL GROUP BY crop) f, range(100) g(i)"""))
def x3_points(t: Tables) -> DataFrame:
    return rounded(rounded(x.linear_trend(t.curated, "rainfall_mm", Y, ["crop"], points=100), 6, "x"), 3, "y")


@bound("x4_iqr_outliers", on_curated("""
    SELECT c.crop, min(lo) AS lower_bound, min(hi) AS upper_bound, count(*) FILTER (WHERE yield_hg_ha < lo OR yield_hg_ha > hi) AS outlier_count, count(*) AS n,
           round(100.0 * count(*) FILTER (WHERE yield_hg_ha < lo OR yield_hg_ha > hi) / count(*), 2) AS outlier_pct
    FROM curated c JOIN (SELECT crop, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
        (SELECT crop, quantile_cont(yield_hg_ha, 0.25) AS q1, quantile_cont(yield_hg_ha, 0.75) AS q3 FROM curated GROUP BY crop) b) b ON c.crop = b.crop
    GROUP BY c.crop"""))
def x4(t: Tables) -> DataFrame:
    return x.iqr_outliers(t.curated)


@bound("x5_mean_interval", on_curated(f"""
    SELECT crop, count(*) AS n, round(avg(yield_hg_ha), 4) AS mean,
           round(avg(yield_hg_ha) - {normal_quantile(0.95)!r} * stddev_samp(yield_hg_ha) / sqrt(count(*)), 4) AS ci_low,
           round(avg(yield_hg_ha) + {normal_quantile(0.95)!r} * stddev_samp(yield_hg_ha) / sqrt(count(*)), 4) AS ci_high
    FROM curated GROUP BY crop"""))
def x5(t: Tables) -> DataFrame:
    return rounded(x.mean_interval(t.curated), 4, "mean", "ci_low", "ci_high")


@bound("x6_welch_test", on_curated(f"""
    SELECT crop, round(bm, 4) AS before_mean, round(am, 4) AS after_mean, bn AS before_n, an AS after_n,
           round((bm - am) / sqrt(bv / bn + av / an), 6) AS t_statistic,
           round((bv / bn + av / an) ** 2 / ((bv / bn) ** 2 / (bn - 1) + (av / an) ** 2 / (an - 1)), 4) AS degrees_of_freedom
    FROM (SELECT crop, avg(yield_hg_ha) FILTER (WHERE year < {SPLIT}) AS bm, avg(yield_hg_ha) FILTER (WHERE year >= {SPLIT}) AS am,
                 count(*) FILTER (WHERE year < {SPLIT}) AS bn, count(*) FILTER (WHERE year >= {SPLIT}) AS an,
                 var_samp(yield_hg_ha) FILTER (WHERE year < {SPLIT}) AS bv, var_samp(yield_hg_ha) FILTER (WHERE year >= {SPLIT}) AS av
          FROM curated GROUP BY crop) s"""))
def x6(t: Tables) -> DataFrame:
    told = x.welch_test(t.curated, SPLIT).drop("p_value", "significant")
    return rounded(rounded(told, 4, "before_mean", "after_mean", "degrees_of_freedom"), 6, "t_statistic")


# The tail of Student's t by Simpson's rule over the density, from 0 to |t|.
@bound("x6_welch_p_value", on_curated(f"""
    SELECT crop, round(greatest(0, 1 - 2 * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi()) * abs(t) / 4000 / 3
        * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * (1 + (t * i / 4000) ** 2 / v) ** (-(v + 1) / 2))), 5) AS p_value
    FROM (SELECT crop, (bm - am) / sqrt(bv / bn + av / an) AS t,
                 (bv / bn + av / an) ** 2 / ((bv / bn) ** 2 / (bn - 1) + (av / an) ** 2 / (an - 1)) AS v
          FROM (SELECT crop, avg(yield_hg_ha) FILTER (WHERE year < {SPLIT}) AS bm, avg(yield_hg_ha) FILTER (WHERE year >= {SPLIT}) AS am,
                       count(*) FILTER (WHERE year < {SPLIT}) AS bn, count(*) FILTER (WHERE year >= {SPLIT}) AS an,
                       var_samp(yield_hg_ha) FILTER (WHERE year < {SPLIT}) AS bv, var_samp(yield_hg_ha) FILTER (WHERE year >= {SPLIT}) AS av
                FROM curated GROUP BY crop) s) w, range(4001) g(i)
    GROUP BY crop, t, v"""))
def x6_p(t: Tables) -> DataFrame:
    return rounded(x.welch_test(t.curated, SPLIT).select("crop", "p_value"), 5, "p_value")


@bound("x6_welch_verdict", on_curated(f"""
    SELECT crop, t_statistic, p_value, p_value < 0.05 AS significant FROM (SELECT crop, round(t, 6) AS t_statistic, round(greatest(0, 1 - 2 * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi()) * abs(t) / 4000 / 3
        * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * (1 + (t * i / 4000) ** 2 / v) ** (-(v + 1) / 2))), 5) AS p_value
    FROM (SELECT crop, (bm - am) / sqrt(bv / bn + av / an) AS t,
                 (bv / bn + av / an) ** 2 / ((bv / bn) ** 2 / (bn - 1) + (av / an) ** 2 / (an - 1)) AS v
          FROM (SELECT crop, avg(yield_hg_ha) FILTER (WHERE year < {SPLIT}) AS bm, avg(yield_hg_ha) FILTER (WHERE year >= {SPLIT}) AS am,
                       count(*) FILTER (WHERE year < {SPLIT}) AS bn, count(*) FILTER (WHERE year >= {SPLIT}) AS an,
                       var_samp(yield_hg_ha) FILTER (WHERE year < {SPLIT}) AS bv, var_samp(yield_hg_ha) FILTER (WHERE year >= {SPLIT}) AS av
                FROM curated GROUP BY crop) s) w, range(4001) g(i)
    GROUP BY crop, t, v) p"""))
def x6_verdict(t: Tables) -> DataFrame:
    return rounded(x.welch_test(t.curated, SPLIT).select("crop", "t_statistic", "p_value", "significant"), 5, "p_value").withColumn("t_statistic", F.round("t_statistic", 6))


@bound("x4_quantiles_of_events", """
    SELECT event_type, count(value) AS n, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY 1""")
def x4_events(t: Tables) -> DataFrame:
    cuts = exact_quantiles(t.table("events"), "value", [0.1, 0.9], ["event_type"])
    return rounded(cuts.select("event_type", "n", F.col("quantiles")[0].alias("p10"), F.col("quantiles")[1].alias("p90")), 6, "p10", "p90")
