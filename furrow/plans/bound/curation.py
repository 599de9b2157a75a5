"""Sources, projections, joins and integrity over the curated table (S, P, J, G, U)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions.numeric import band, flag, hg_to_kg, one_hot, percent_change, period_start, safe_ratio, tier
from furrow.functions.text import AREA_ALIASES, area_key, number_or_null, with_area_key
from furrow.operators.aggregates import lookup_rows, options
from furrow.operators.cleaning import clean_pesticides, clean_rainfall, clean_temp, clean_yield, mean_temp_with_repeats
from furrow.operators.evaluation import temporal_split
from furrow.operators.features import CONDITIONS
from furrow.operators.integrity import duplicate_keys, functional_dependency_violations, match_rates
from furrow.operators.joining import merge_sources, with_group_stats, with_previous_year
from furrow.operators.quality import KNOWN_CROPS
from furrow.models.baseline import HistoricalMean
from furrow.plans.bound.gate import COLUMNS
from furrow.plans.bound.registry import bound, rounded
from furrow.plans.bound.tables import (
    CUTOFF, EVENT_SQL, KNOWN_SQL, LINE_SQL, SOURCE_SQL, Tables, key_sql, on_curated, plain,
)
from furrow.sources.star import one_row_per_region_year
from furrow.plans.curate import MATCHED, SOURCES, curate_by_name, curate_with_sql, transform_report

LINE_PEST = plain(LINE_SQL["pesticides"])
LINE_RAIN = plain(LINE_SQL["rainfall"])
LINE_YIELD = plain(LINE_SQL["yield"])
LINE_TEMP = plain(LINE_SQL["temp"])


# ---- projections and expressions ----------------------------------------------------------

@bound("p1_clean_yield", f"SELECT area, item AS crop, yr AS year, TRY_CAST(val AS BIGINT) AS yield_hg_ha, {key_sql('area')} AS area_key FROM ({LINE_YIELD}) r")
def p1(t: Tables) -> DataFrame:
    return clean_yield(t.raw_lines("yield"))


@bound("p2_clean_pesticides", f"SELECT area, yr AS year, CAST(val AS DOUBLE) AS pesticides_tonnes, {key_sql('area')} AS area_key FROM ({LINE_PEST}) r")
def p2(t: Tables) -> DataFrame:
    return clean_pesticides(t.raw_lines("pesticides"))


@bound("p3_clean_rainfall", f"SELECT area, yr AS year, TRY_CAST(nullif(trim(txt), '..') AS DOUBLE) AS rainfall_mm, {key_sql('area')} AS area_key FROM ({LINE_RAIN}) r")
def p3(t: Tables) -> DataFrame:
    return clean_rainfall(t.raw_lines("rainfall"))


@bound("p4_area_key", f"SELECT area, {key_sql('area')} AS area_key, count(*) AS n FROM (SELECT area FROM ({LINE_YIELD}) y UNION ALL SELECT area FROM ({LINE_RAIN}) r) x GROUP BY 1, 2")
def p4(t: Tables) -> DataFrame:
    names = t.raw_lines("yield").select(F.col("Area").alias("area")).unionByName(t.raw_lines("rainfall").select(F.col("` Area`").alias("area")))
    return names.groupBy("area").agg(F.count(F.lit(1)).alias("n")).withColumn("area_key", area_key(F.col("area")))


@bound("p4_area_key_from_a_table", f"SELECT area, {key_sql('area')} AS area_key, count(*) AS n FROM (SELECT area FROM ({LINE_YIELD}) y UNION ALL SELECT area FROM ({LINE_RAIN}) r) x GROUP BY 1, 2")
def p4_table(t: Tables) -> DataFrame:
    aliases = t.spark.createDataFrame(list(AREA_ALIASES.items()), "formal string, common string")
    names = t.raw_lines("yield").select(F.col("Area").alias("area")).unionByName(t.raw_lines("rainfall").select(F.col("` Area`").alias("area")))
    return with_area_key(names.groupBy("area").agg(F.count(F.lit(1)).alias("n")), "area", aliases)


@bound("p5_drop_helper_column", f"SELECT area, item AS crop, yr AS year, TRY_CAST(val AS BIGINT) AS yield_hg_ha FROM ({LINE_YIELD}) r")
def p5(t: Tables) -> DataFrame:
    return clean_yield(t.raw_lines("yield")).drop("area_key")


@bound("p6_comparison_filters", on_curated("SELECT area, year, yield_hg_ha FROM curated WHERE crop = 'Maize' AND year >= 1997 AND area <> 'India'"))
def p6(t: Tables) -> DataFrame:
    return t.curated.where("crop = 'Maize' and year >= 1997 and area <> 'India'").select("area", "year", "yield_hg_ha")


@bound("p7_temporal_split", on_curated(f"""
    SELECT CASE WHEN year < {CUTOFF} THEN 'train' ELSE 'test' END AS split, count(*) AS n, min(year) AS first_year, max(year) AS last_year
    FROM curated GROUP BY 1"""))
def p7(t: Tables) -> DataFrame:
    sides = zip(("train", "test"), temporal_split(t.curated, CUTOFF))
    told = [
        rows.agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year")).withColumn("split", F.lit(name))
        for name, rows in sides
    ]
    return reduce(DataFrame.unionByName, told)


@bound("p8_complete_cases", on_curated("""
    SELECT area, crop, year, rainfall_mm FROM curated
    WHERE rainfall_mm IS NOT NULL AND avg_temp_c IS NOT NULL AND pesticides_tonnes IS NOT NULL"""))
def p8(t: Tables) -> DataFrame:
    return t.curated.dropna(subset=list(CONDITIONS)).select("area", "crop", "year", "rainfall_mm")




@bound("p9_point_lookup", on_curated("""
    SELECT c.area, c.crop, c.year, c.yield_hg_ha FROM curated c
    WHERE crop = 'Wheat' AND year = 1999 AND area IN (SELECT area FROM curated WHERE crop = 'Maize')"""))
def p9(t: Tables) -> DataFrame:
    wanted = t.curated.where("crop = 'Maize'").select("area", F.lit("Wheat").alias("crop"), F.lit(1999).alias("year"))
    found, _ = lookup_rows(wanted, t.curated, ["area", "crop", "year"])
    return found.select("area", "crop", "year", "yield_hg_ha")


@bound("p9_lookup_misses", on_curated("""
    SELECT DISTINCT m.area, 'Wheat' AS crop, m.year FROM curated m WHERE m.crop = 'Maize'
    AND NOT EXISTS (SELECT 1 FROM curated c WHERE c.area = m.area AND c.crop = 'Wheat' AND c.year = m.year)"""))
def p9_misses(t: Tables) -> DataFrame:
    wanted = t.curated.where("crop = 'Maize'").select("area", F.lit("Wheat").alias("crop"), "year")
    return lookup_rows(wanted, t.curated, ["area", "crop", "year"])[1]


@bound("p10_option_lists", on_curated("""
    SELECT 'area' AS level, area AS choice FROM (SELECT DISTINCT area FROM curated) a
    UNION ALL SELECT 'crop', crop FROM (SELECT DISTINCT crop FROM curated WHERE area = 'India') c
    UNION ALL SELECT 'year', CAST(year AS VARCHAR) FROM (SELECT DISTINCT year FROM curated WHERE area = 'India' AND crop = 'Maize') y"""))
def p10(t: Tables) -> DataFrame:
    lists = {
        "area": options(t.curated, "area"),
        "crop": options(t.curated, "crop", area="India"),
        "year": options(t.curated, "year", area="India", crop="Maize"),
    }
    parts = [df.select(F.lit(level).alias("level"), F.col(level).cast("string").alias("choice")) for level, df in lists.items()]
    return reduce(DataFrame.unionByName, parts)


@bound("p11_hg_to_kg", on_curated("SELECT area, crop, year, yield_hg_ha / 10.0::DOUBLE AS yield_kg_ha FROM curated"))
def p11(t: Tables) -> DataFrame:
    return t.curated.select("area", "crop", "year", hg_to_kg(F.col("yield_hg_ha")).alias("yield_kg_ha"))


@bound("p12_period_buckets", on_curated("""
    SELECT CAST(floor(year / 10.0) * 10 AS BIGINT) AS decade, CAST(floor(year / 3.0) * 3 AS BIGINT) AS three_years,
           CAST(floor((year - 1998) / 3.0) * 3 AS BIGINT) AS around_zero, count(*) AS n
    FROM curated GROUP BY 1, 2, 3"""))
def p12(t: Tables) -> DataFrame:
    y = F.col("year")
    return t.curated.groupBy(
        period_start(y, 10).alias("decade"), period_start(y, 3).alias("three_years"), period_start(y - 1998, 3).alias("around_zero")
    ).agg(F.count(F.lit(1)).alias("n"))


@bound("p13_tiers_per_crop", on_curated("""
    SELECT c.area, c.crop, c.year,
           CASE WHEN yield_hg_ha < m - sd THEN 'low' WHEN yield_hg_ha > m + sd THEN 'high' ELSE 'medium' END AS yield_tier
    FROM curated c JOIN (SELECT crop, avg(yield_hg_ha) AS m, stddev_pop(yield_hg_ha) AS sd FROM curated GROUP BY crop) s ON c.crop = s.crop"""))
def p13(t: Tables) -> DataFrame:
    stats = t.curated.groupBy("crop").agg(F.avg("yield_hg_ha").alias("m"), F.var_pop("yield_hg_ha").alias("v"))
    return with_group_stats(t.curated, stats, ["crop"]).select(
        "area", "crop", "year", tier(F.col("yield_hg_ha"), F.col("m"), F.col("v")).alias("yield_tier")
    )


@bound("p14_flags", on_curated("""
    SELECT area, crop, year, CAST(year >= 1998 AS BIGINT) AS is_later_era, CAST(rainfall_mm IS NULL AS BIGINT) AS rainfall_mm_missing,
           CAST(pesticides_tonnes IS NULL AS BIGINT) AS pesticides_tonnes_missing FROM curated"""))
def p14(t: Tables) -> DataFrame:
    return t.curated.select(
        "area", "crop", "year", flag(F.col("year") >= 1998).alias("is_later_era"),
        flag(F.col("rainfall_mm").isNull()).alias("rainfall_mm_missing"), flag(F.col("pesticides_tonnes").isNull()).alias("pesticides_tonnes_missing"),
    )


@bound("p15_fill_missing", on_curated("""
    SELECT area, crop, year, coalesce(rainfall_mm, (SELECT max(rainfall_mm) FROM curated)) AS rainfall_mm,
           coalesce(pesticides_tonnes, rainfall_mm, -1) AS either FROM curated"""))
def p15(t: Tables) -> DataFrame:
    wettest = t.curated.agg(F.max("rainfall_mm")).scalar()
    return t.curated.select(
        "area", "crop", "year", F.coalesce("rainfall_mm", wettest).alias("rainfall_mm"),
        F.coalesce("pesticides_tonnes", "rainfall_mm", F.lit(-1.0)).alias("either"),
    )


@bound("p16_safe_ratio", on_curated("""
    SELECT area, crop, year, round(coalesce(yield_hg_ha / nullif(pesticides_tonnes - 9, 0), 1.0), 6) AS ratio FROM curated"""))
def p16(t: Tables) -> DataFrame:
    ratio = safe_ratio(F.col("yield_hg_ha"), F.col("pesticides_tonnes") - 9, 1.0)
    return rounded(t.curated.select("area", "crop", "year", ratio.alias("ratio")), 6, "ratio")


@bound("p17_one_hot", on_curated(f"""
    SELECT area, year, crop, CAST(crop = 'Maize' AS BIGINT) AS "crop_Maize", CAST(crop = 'Rice, paddy' AS BIGINT) AS "crop_Rice, paddy",
           CAST(crop = 'Potatoes' AS BIGINT) AS "crop_Potatoes" FROM curated"""))
def p17(t: Tables) -> DataFrame:
    return t.curated.select("area", "year", "crop", *[v.alias(n) for n, v in one_hot(F.col("crop"), ["Maize", "Rice, paddy", "Potatoes"], "crop_").items()])


@bound("p18_overrides", on_curated("""
    SELECT area, crop, year, CASE WHEN crop = 'Maize' THEN 100.0 ELSE rainfall_mm END AS rainfall_mm, avg_temp_c IS NULL AS no_temp FROM curated"""))
def p18(t: Tables) -> DataFrame:
    override = F.when(F.col("crop") == "Maize", F.lit(100.0))
    return t.curated.withColumn("rainfall_mm", F.coalesce(override, "rainfall_mm")).select(
        "area", "crop", "year", "rainfall_mm", F.col("avg_temp_c").isNull().alias("no_temp")
    )


@bound("p19_casts", f"SELECT val, TRY_CAST(val AS DOUBLE) AS as_double, TRY_CAST(val AS BIGINT) AS as_long, count(*) AS n FROM ({LINE_YIELD}) r GROUP BY 1, 2, 3")
def p19(t: Tables) -> DataFrame:
    counted = t.raw_lines("yield").groupBy(F.col("Value").alias("val")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("val", number_or_null(F.col("val")).alias("as_double"), number_or_null(F.col("val")).try_cast("long").alias("as_long"), "n")


@bound("p20_rounding", on_curated("""
    SELECT area, crop, year, round(yield_hg_ha / 7.0::DOUBLE, 1) AS one_place, round(yield_hg_ha / 13.0::DOUBLE, 2) AS two_places FROM curated"""))
def p20(t: Tables) -> DataFrame:
    y = F.col("yield_hg_ha")
    return t.curated.select("area", "crop", "year", F.round(y / 7, 1).alias("one_place"), F.bround(y / 13, 2).alias("two_places"))


@bound("p20_ties_to_even", on_curated("SELECT area, crop, year, round_even(yield_hg_ha / 2.0::DOUBLE, 0) AS halved FROM curated"))
def p20_ties(t: Tables) -> DataFrame:
    """Half of every odd yield is a tie."""
    return t.curated.select("area", "crop", "year", F.bround(F.col("yield_hg_ha") / 2, 0).alias("halved"))


@bound("p21_percent_change", on_curated("""
    SELECT area, crop, year, round(100.0 * (rainfall_mm - (pesticides_tonnes - 9)) / nullif(pesticides_tonnes - 9, 0), 6) AS pct FROM curated"""))
def p21(t: Tables) -> DataFrame:
    change = percent_change(F.col("pesticides_tonnes") - 9, F.col("rainfall_mm"))
    return rounded(t.curated.select("area", "crop", "year", change.alias("pct")), 6, "pct")


@bound("p22_bands", on_curated("""
    SELECT CASE WHEN avg_temp_c < 6 THEN 'cool' WHEN avg_temp_c < 8 THEN 'mild' ELSE 'warm' END AS climate, count(*) AS n FROM curated GROUP BY 1"""))
def p22(t: Tables) -> DataFrame:
    climate = band(F.col("avg_temp_c"), [(6, "cool"), (8, "mild")], "warm")
    return t.curated.groupBy(climate.alias("climate")).agg(F.count(F.lit(1)).alias("n"))


@bound("p23_membership", f"SELECT item, item IS NOT NULL AND item IN {KNOWN_SQL} AS known, count(*) AS n FROM ({LINE_YIELD}) r GROUP BY 1, 2")
def p23(t: Tables) -> DataFrame:
    known = F.coalesce(F.col("item").isin(*KNOWN_CROPS), F.lit(False))
    return t.raw_lines("yield").groupBy(F.col("Item").alias("item")).agg(F.count(F.lit(1)).alias("n")).withColumn("known", known)


# ---- joins --------------------------------------------------------------------------------

@bound("j1_curated", on_curated("SELECT area, crop, year, yield_hg_ha, pesticides_tonnes, rainfall_mm, round(avg_temp_c, 6) AS avg_temp_c FROM curated"))
def j1(t: Tables) -> DataFrame:
    return rounded(t.curated, 6, "avg_temp_c")


@bound("j2_duplicate_keys_fan_out", f"""
    WITH y AS ({plain(SOURCE_SQL["yield"])}), p AS (SELECT DISTINCT area, yr, val FROM ({LINE_PEST}) l)
    SELECT y.area, y.item AS crop, y.yr AS year, count(*) AS n_rows, count(p.val) AS n_matched
    FROM y LEFT JOIN p ON {key_sql("y.area")} = {key_sql("p.area")} AND y.yr = p.yr GROUP BY 1, 2, 3""")
def j2(t: Tables) -> DataFrame:
    several = clean_pesticides(t.raw_lines("pesticides")).distinct()
    merged = merge_sources(
        clean_yield(t.raw("yield")), several, clean_rainfall(t.raw("rainfall")), clean_temp(t.raw("temp"))
    )
    return merged.groupBy("area", "crop", "year").agg(F.count(F.lit(1)).alias("n_rows"), F.count("pesticides_tonnes").alias("n_matched"))


@bound("j3_join_by_name", f"""
    SELECT y.area, y.item AS crop, y.yr AS year, y.val AS yield_hg_ha, r.rainfall_mm, t.n IS NOT NULL AS has_temp
    FROM ({plain(SOURCE_SQL["yield"])}) y
    LEFT JOIN (SELECT area, yr, TRY_CAST(txt AS DOUBLE) AS rainfall_mm FROM ({plain(SOURCE_SQL["rainfall"])}) rr) r ON y.area = r.area AND y.yr = r.yr
    LEFT JOIN (SELECT country, yr, count(*) AS n FROM ({plain(SOURCE_SQL["temp"])}) tt GROUP BY 1, 2) t ON y.area = t.country AND y.yr = t.yr""")
def j3(t: Tables) -> DataFrame:
    merged = curate_by_name(
        clean_yield(t.raw("yield")).drop("area_key"), clean_rainfall(t.raw("rainfall")).drop("area_key"),
        mean_temp_with_repeats(t.raw("temp")).withColumn("has_temp", F.lit(True)),
    )
    return merged.select("area", "crop", "year", "yield_hg_ha", "rainfall_mm", F.coalesce("has_temp", F.lit(False)).alias("has_temp"))


@bound("s13_sql_over_views", f"""
    SELECT y.area, y.item AS crop, y.yr AS year, y.val AS yield_hg_ha, p.val AS pesticides_tonnes
    FROM ({plain(SOURCE_SQL["yield"])}) y LEFT JOIN ({plain(SOURCE_SQL["pesticides"])}) p ON y.area = p.area AND y.yr = p.yr""")
def s13(t: Tables) -> DataFrame:
    return curate_with_sql(t.raw("yield"), t.raw("pesticides"))


@bound("j8_fallback_lookup", on_curated(f"""
    SELECT t.area, t.crop, t.year, round(coalesce(pm, cm, (SELECT avg(yield_hg_ha) FROM train)), 4) AS prediction
    FROM (SELECT * FROM curated WHERE year >= {CUTOFF}) t
    LEFT JOIN (SELECT area, crop, avg(yield_hg_ha) AS pm FROM train GROUP BY 1, 2) a ON t.area = a.area AND t.crop = a.crop
    LEFT JOIN (SELECT crop, avg(yield_hg_ha) AS cm FROM train GROUP BY 1) c ON t.crop = c.crop""",
    f"train AS (SELECT * FROM curated WHERE year < {CUTOFF} AND crop <> 'Sorghum' AND (crop <> 'Wheat' OR pesticides_tonnes IS NULL))"))
def j8(t: Tables) -> DataFrame:
    train, test = temporal_split(t.curated, CUTOFF)
    # One crop is left out and one thinned out, so that every fallback is used.
    known = train.where("crop <> 'Sorghum' and (crop <> 'Wheat' or pesticides_tonnes is null)")
    return rounded(HistoricalMean.fit(known).predict(test).select("area", "crop", "year", "prediction"), 4, "prediction")


@bound("j9_cold_start", f"""
    WITH f AS ({plain(EVENT_SQL)}) SELECT area, crop, year, yield_hg_ha FROM f x WHERE year >= 8
    AND NOT EXISTS (SELECT 1 FROM f y WHERE y.year < 8 AND y.area = x.area AND y.crop = x.crop)""")
def j9(t: Tables) -> DataFrame:
    train, test = temporal_split(t.events, 8)
    return HistoricalMean.fit(train).cold_start(test)


@bound("j9_orders_without_lines", "SELECT o_orderstatus AS status, count(*) AS n FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY 1")
def j9_orders(t: Tables) -> DataFrame:
    lines = t.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    missing = t.table("orders").join(lines, "o_orderkey", "left_anti")
    return missing.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@bound("j10_calendar_lag", f"""
    WITH f AS ({plain(EVENT_SQL)}) SELECT x.area, x.crop, x.year, x.yield_hg_ha, y.yield_hg_ha AS lag1_yield
    FROM f x LEFT JOIN f y ON y.area = x.area AND y.crop = x.crop AND y.year = x.year - 1""")
def j10(t: Tables) -> DataFrame:
    # A folded table: a second value for a year would be a fault, not a choice.
    return with_previous_year(t.events, t.events, refuse_repeats=True)


@bound("w8_calendar_lag_curated", on_curated("""
    SELECT x.area, x.crop, x.year, y.yield_hg_ha AS lag1_yield
    FROM curated x LEFT JOIN curated y ON y.area = x.area AND y.crop = x.crop AND y.year = x.year - 1"""))
def w8(t: Tables) -> DataFrame:
    return with_previous_year(t.curated, t.curated).select("area", "crop", "year", "lag1_yield")


@bound("j11_group_mean_or_global", on_curated(f"""
    SELECT c.area, c.crop, c.year, round(coalesce(m, (SELECT avg(yield_hg_ha) FROM known)), 4) AS region_mean
    FROM curated c LEFT JOIN (SELECT area, avg(yield_hg_ha) AS m FROM known GROUP BY area) k ON c.area = k.area""",
    "known AS (SELECT * FROM curated WHERE year < 1996 AND crop = 'Maize')"))
def j11(t: Tables) -> DataFrame:
    known = t.curated.where("year < 1996 and crop = 'Maize'")
    means = known.groupBy("area").agg(F.avg("yield_hg_ha").alias("region_mean"))
    overall = known.agg(F.avg("yield_hg_ha")).scalar()
    out = with_group_stats(t.curated, means, ["area"], {"region_mean": overall})
    return rounded(out.select("area", "crop", "year", "region_mean"), 4, "region_mean")


@bound("j14_rankings_side_by_side", on_curated("""
    SELECT coalesce(a.area, b.area) AS area, a.n_wet, b.n_sprayed FROM
    (SELECT area, count(*) AS n_wet FROM curated WHERE rainfall_mm > 2200 GROUP BY 1) a FULL JOIN
    (SELECT area, count(*) AS n_sprayed FROM curated WHERE pesticides_tonnes > 25 GROUP BY 1) b ON a.area = b.area"""))
def j14(t: Tables) -> DataFrame:
    def tally(condition: str, name: str) -> DataFrame:
        return t.curated.where(condition).groupBy("area").agg(F.count(F.lit(1)).alias(name))

    return tally("rainfall_mm > 2200", "n_wet").join(tally("pesticides_tonnes > 25", "n_sprayed"), "area", "full")


# ---- set operations and integrity ---------------------------------------------------------

@bound("a7_clean_temp", f"""
    SELECT {key_sql("country")} AS area_key, yr AS year, min(country) AS area, round(avg(avg_temp), 6) AS avg_temp_c
    FROM (SELECT DISTINCT * FROM ({LINE_TEMP}) l) d GROUP BY 1, 2""")
def a7(t: Tables) -> DataFrame:
    return rounded(clean_temp(t.raw_lines("temp")), 6, "avg_temp_c")


@bound("a8_mean_temp_with_repeats", f"SELECT country AS area, yr AS year, round(avg(avg_temp), 6) AS avg_temp_c FROM ({LINE_TEMP}) l GROUP BY 1, 2")
def a8(t: Tables) -> DataFrame:
    return rounded(mean_temp_with_repeats(t.raw_lines("temp")), 6, "avg_temp_c")


@bound("u1_distinct_rows", f"SELECT DISTINCT yr AS year, country, avg_temp FROM ({LINE_TEMP}) l")
def u1(t: Tables) -> DataFrame:
    return t.raw_lines("temp").distinct()


@bound("u2_distinct_by_key", on_curated("SELECT area, year, min(rainfall_mm) AS rainfall_mm, min(pesticides_tonnes) AS pesticides_tonnes FROM curated GROUP BY 1, 2"))
def u2(t: Tables) -> DataFrame:
    return one_row_per_region_year(t.curated, "rainfall_mm", "pesticides_tonnes")


@bound("u4_complement", f"""
    SELECT (SELECT count(*) FROM ({LINE_TEMP}) a) AS n_all, (SELECT count(*) FROM (SELECT DISTINCT * FROM ({LINE_TEMP}) b
        WHERE NOT coalesce(yr < 1600 OR yr > 2026, false) AND NOT coalesce(avg_temp < -90 OR avg_temp > 60, false)) c) AS n_accepted""")
def u4(t: Tables) -> DataFrame:
    gate = t.gate("temp")
    both = gate.accepted().select(F.lit(1).alias("ok")).unionByName(gate.rejected().select(F.lit(0).alias("ok")))
    return both.agg(F.count(F.lit(1)).alias("n_all"), F.sum("ok").alias("n_accepted"))


@bound("g1_match_rates", on_curated("""
    SELECT count(*) AS total_rows, round(100.0 * count(pesticides_tonnes) / count(*), 1) AS pesticides_matched_pct,
           round(100.0 * count(rainfall_mm) / count(*), 1) AS rainfall_matched_pct, round(100.0 * count(avg_temp_c) / count(*), 1) AS avg_temp_matched_pct
    FROM curated"""))
def g1(t: Tables) -> DataFrame:
    return match_rates(t.curated, MATCHED)


@bound("g2_row_count_invariant", on_curated("SELECT (SELECT count(*) FROM ok_yield) AS n_accepted, (SELECT count(*) FROM curated) AS n_curated"))
def g2(t: Tables) -> DataFrame:
    accepted = t.accepted["yield"].agg(F.count(F.lit(1)).alias("n_accepted"))
    return accepted.withColumn("n_curated", t.curated.agg(F.count(F.lit(1))).scalar())


@bound("g3_duplicate_keys", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def g3(t: Tables) -> DataFrame:
    return duplicate_keys(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


@bound("g3_duplicate_join_keys", f"SELECT {key_sql('country')} AS area_key, yr AS year, count(*) AS n FROM ({LINE_TEMP}) l GROUP BY 1, 2 HAVING count(*) > 1")
def g3_join(t: Tables) -> DataFrame:
    keyed = t.raw_lines("temp").select(area_key(F.col("country")).alias("area_key"), "year")
    return duplicate_keys(keyed, ["area_key", "year"])


@bound("g6_functional_dependency", on_curated("""
    SELECT 'weather' AS checked, count(*) AS violations FROM (SELECT area, year FROM curated GROUP BY 1, 2
        HAVING count(DISTINCT coalesce(rainfall_mm, -1e9)) > 1 OR count(DISTINCT coalesce(avg_temp_c, -1e9)) > 1) a
    UNION ALL SELECT 'yield', count(*) FROM (SELECT area, year FROM curated GROUP BY 1, 2 HAVING count(DISTINCT yield_hg_ha) > 1) b"""))
def g6(t: Tables) -> DataFrame:
    def broken(name: str, *values: str) -> DataFrame:
        found = functional_dependency_violations(t.curated, ["area", "year"], values)
        return found.agg(F.count(F.lit(1)).alias("violations")).withColumn("checked", F.lit(name))

    return broken("weather", "rainfall_mm", "avg_temp_c").unionByName(broken("yield", "yield_hg_ha"))


_RAW_LINES = {"yield": LINE_YIELD, "pesticides": LINE_PEST, "rainfall": LINE_RAIN, "temp": LINE_TEMP}


_NULLS = {s: [(h, c) for h, c in COLUMNS[s].items()] for s in SOURCES}


@bound("o2_transform_report", on_curated("SELECT (SELECT count(*) FROM curated) AS total_rows, " + ", ".join(
    f"CAST((SELECT count(*) FROM ({sql}) a) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({sql}) b) c) AS BIGINT) AS duplicates_{s}" for s, sql in _RAW_LINES.items()
) + ", " + ", ".join(
    f"(SELECT count(*) FROM ({_RAW_LINES[s]}) x WHERE {c} IS NULL) AS nulls_{s}_{c}" for s in SOURCES for _, c in _NULLS[s]
) + ", " + ", ".join(
    f"(SELECT round_even(100.0 * count({column}) / count(*), 1) FROM curated) AS rate_{name}" for column, name in MATCHED.items()
)))
def o2(t: Tables) -> DataFrame:
    told = transform_report({s: t.raw_lines(s) for s in SOURCES}, t.curated)
    return told.select(
        "join_match_rates.total_rows", *[F.col(f"duplicate_rows_found_in_raw.{s}").alias(f"duplicates_{s}") for s in SOURCES],
        *[F.col(f"null_counts_in_raw.{s}.`{h}`").alias(f"nulls_{s}_{c}") for s in SOURCES for h, c in _NULLS[s]],
        *[F.col(f"join_match_rates.{name}").alias(f"rate_{name}") for name in MATCHED.values()],
    )
