"""The star schema and the eight questions over it (S-11, S-12, G-4, G-5, Q1 to Q8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.operators.integrity import constraint_violations, table_counts
from furrow.operators.ordered import dense_ids
from furrow.plans import queries as q
from furrow.plans.bound.registry import bound, rounded
from furrow.plans.bound.tables import EVENT_SQL, REGION_CTES, Tables, on_curated, plain
from furrow.sources.star import number_facts, star_violations


@bound("s11_region_dimension", on_curated("SELECT region_id, region_name FROM dim_region", REGION_CTES))
def regions(t: Tables) -> DataFrame:
    return t.star["region"]


@bound("s11_crop_dimension", on_curated("SELECT crop_id, crop_name FROM dim_crop", REGION_CTES))
def crops(t: Tables) -> DataFrame:
    return t.star["crop"]


@bound("s11_weather_observations", on_curated("""
    SELECT DISTINCT region_id, year, rainfall_mm, round(avg_temp_c, 6) AS avg_temp_c
    FROM curated JOIN dim_region ON area = region_name""", REGION_CTES))
def weather(t: Tables) -> DataFrame:
    return rounded(t.star["weather_observation"], 6, "avg_temp_c")


@bound("s11_practice_observations", on_curated("""
    SELECT DISTINCT region_id, year, pesticides_tonnes FROM curated JOIN dim_region ON area = region_name""", REGION_CTES))
def practice(t: Tables) -> DataFrame:
    return t.star["agricultural_practice_observation"]


@bound("j13_yield_observations", on_curated("""
    SELECT row_number() OVER (ORDER BY region_id, crop_id, year) AS yield_id, region_id, crop_id, year, yield_hg_ha
    FROM curated JOIN dim_region ON area = region_name JOIN dim_crop ON crop = crop_name""", REGION_CTES))
def facts(t: Tables) -> DataFrame:
    return number_facts(t.star["yield_observation"])


@bound("s12_load_counts", on_curated("""
    SELECT 'region' AS table_name, count(*) AS n_rows FROM dim_region UNION ALL SELECT 'crop', count(*) FROM dim_crop
    UNION ALL SELECT 'weather_observation', count(*) FROM (SELECT DISTINCT area, year FROM curated) w
    UNION ALL SELECT 'agricultural_practice_observation', count(*) FROM (SELECT DISTINCT area, year FROM curated) p
    UNION ALL SELECT 'yield_observation', count(*) FROM curated""", REGION_CTES))
def counts(t: Tables) -> DataFrame:
    return table_counts(t.star)


@bound("g4_dense_ids", "SELECT row_number() OVER (ORDER BY c_name) AS customer_id, c_name FROM (SELECT DISTINCT c_name FROM customer) c")
def ids(t: Tables) -> DataFrame:
    return dense_ids(t.table("customer"), "c_name", "customer_id")


@bound("g5_constraints_hold", on_curated("""
    SELECT count(*) AS n_constraints, CAST(0 AS BIGINT) AS violations
    FROM range(17) r"""))
def constraints(t: Tables) -> DataFrame:
    return star_violations(t.star).agg(F.count(F.lit(1)).alias("n_constraints"), F.sum("violations").alias("violations"))


@bound("g5_constraints_broken", """
    SELECT 'unique lines(l_orderkey, l_linenumber)' AS rule, count(*) AS violations FROM
        (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) a
    UNION ALL SELECT 'not null lines.l_shipdate', count(*) FROM lineitem WHERE l_shipdate IS NULL
    UNION ALL SELECT 'orders.o_orderkey in lines.l_orderkey', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def broken_constraints(t: Tables) -> DataFrame:
    return constraint_violations(
        {"lines": t.table("lineitem"), "orders": t.table("orders")},
        unique=[("lines", ["l_orderkey", "l_linenumber"])],
        not_null=[("lines", "l_shipdate")],
        references=[("orders", "o_orderkey", "lines", "l_orderkey")],
    )


@bound("t1_top_observations", on_curated("""
    SELECT area AS region_name, year, yield_hg_ha FROM curated WHERE crop = 'Maize' ORDER BY yield_hg_ha DESC, area, year LIMIT 10"""))
def q1(t: Tables) -> DataFrame:
    return q.top_observations(t.star)


@bound("a4_mean_by_crop", on_curated("""
    SELECT crop AS crop_name, round(avg(yield_hg_ha), 1) AS avg_yield_hg_ha, count(*) AS n_observations FROM curated GROUP BY crop"""))
def q2(t: Tables) -> DataFrame:
    return q.mean_by_crop(t.star)


@bound("a5_regions_with_history", on_curated("""
    SELECT area AS region_name, count(*) AS n_years FROM curated WHERE crop = 'Maize' GROUP BY area HAVING count(*) >= 6"""))
def q3(t: Tables) -> DataFrame:
    return q.regions_with_history(t.star, min_years=6)


@bound("a6_regions_above_average", on_curated("""
    SELECT area AS region_name, round(avg(yield_hg_ha), 1) AS avg_yield_hg_ha FROM curated WHERE crop = 'Maize' GROUP BY area
    HAVING avg(yield_hg_ha) > (SELECT avg(yield_hg_ha) FROM curated WHERE crop = 'Maize')"""))
def q4(t: Tables) -> DataFrame:
    return q.regions_above_average(t.star)


_TIERS = """
    SELECT area AS region_name, year, yield_hg_ha,
           CASE WHEN yield_hg_ha < (SELECT avg(yield_hg_ha) - stddev_pop(yield_hg_ha) FROM curated WHERE crop = 'Maize') THEN 'low'
                WHEN yield_hg_ha > (SELECT avg(yield_hg_ha) + stddev_pop(yield_hg_ha) FROM curated WHERE crop = 'Maize') THEN 'high'
                ELSE 'medium' END AS yield_tier
    FROM curated WHERE crop = 'Maize'"""


@bound("j7_yield_tiers", on_curated(_TIERS))
def q5_all(t: Tables) -> DataFrame:
    return q.yield_tiers(t.star, n=None)


@bound("t2_yield_tiers_first_twenty", on_curated(_TIERS + " ORDER BY area, year LIMIT 20"))
def q5(t: Tables) -> DataFrame:
    return q.yield_tiers(t.star)


_BEST = """
    SELECT area AS region_name, year, yield_hg_ha FROM curated c WHERE crop = 'Maize'
    AND yield_hg_ha = (SELECT max(yield_hg_ha) FROM curated m WHERE m.crop = 'Maize' AND m.area = c.area)"""


@bound("w1_rank_best_year", on_curated(_BEST))
def q6_all(t: Tables) -> DataFrame:
    return q.best_years(t.star, n=None)


@bound("w1_rank_best_year_top", on_curated(_BEST + " ORDER BY yield_hg_ha DESC, area, year LIMIT 15"))
def q6(t: Tables) -> DataFrame:
    return q.best_years(t.star)


_LAGGED = """
    SELECT area AS region_name, crop AS crop_name, year, yield_hg_ha,
           lag(yield_hg_ha) OVER (PARTITION BY area, crop ORDER BY year) AS prev_year_yield,
           yield_hg_ha - lag(yield_hg_ha) OVER (PARTITION BY area, crop ORDER BY year) AS yoy_change_hg_ha
    FROM curated"""


@bound("w2_year_over_year", on_curated(_LAGGED + " WHERE area = 'United States of America' AND crop = 'Maize'"))
def q7(t: Tables) -> DataFrame:
    return q.year_over_year(t.star)


@bound("w3_year_over_year_all", on_curated(_LAGGED))
def q7_all(t: Tables) -> DataFrame:
    return q.year_over_year(t.star, region=None, crop=None)


_CONTEXT = """
    SELECT area AS region_name, year, yield_hg_ha, rainfall_mm, round(avg_temp_c, 6) AS avg_temp_c, pesticides_tonnes
    FROM curated WHERE crop = 'Maize'"""


@bound("j5_yield_in_context", on_curated(_CONTEXT + " AND area = 'India' ORDER BY year LIMIT 20"))
def q8(t: Tables) -> DataFrame:
    return rounded(q.yield_in_context(t.star), 6, "avg_temp_c")


@bound("j5_yield_in_context_all", on_curated(_CONTEXT))
def q8_all(t: Tables) -> DataFrame:
    return rounded(q.yield_in_context(t.star, region=None, n=None), 6, "avg_temp_c")


@bound("j4_facts_with_names", on_curated("SELECT area AS region_name, crop AS crop_name, count(*) AS n, CAST(sum(yield_hg_ha) AS BIGINT) AS total FROM curated GROUP BY 1, 2"))
def named_facts(t: Tables) -> DataFrame:
    named = t.star["yield_observation"].join(t.star["region"], "region_id").join(t.star["crop"], "crop_id")
    return named.groupBy("region_name", "crop_name").agg(F.count(F.lit(1)).alias("n"), F.sum("yield_hg_ha").alias("total"))


@bound("j6_scalar_subquery", on_curated("""
    SELECT area AS region_name, round(avg(yield_hg_ha), 1) AS avg_yield_hg_ha FROM curated WHERE crop = 'Rice, paddy' GROUP BY area
    HAVING avg(yield_hg_ha) > (SELECT avg(yield_hg_ha) FROM curated WHERE crop = 'Rice, paddy')"""))
def q4_rice(t: Tables) -> DataFrame:
    return q.regions_above_average(t.star, "Rice, paddy")
