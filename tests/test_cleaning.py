"""Normalisation, cleaning and the curated join on tiny frames."""

import pytest
from pyspark.sql import functions as F

from furrow.functions.text import AREA_ALIASES, area_key, number_or_null
from furrow.operators.cleaning import clean_rainfall, clean_temp, clean_yield, mean_temp_with_repeats
from furrow.operators.joining import merge_sources, with_previous_year
from furrow.operators.quality import inspect
from furrow.sources.contracts import CONTRACTS
from furrow.sources.files import as_contract_types

PEST = "area string, year int, pesticides_tonnes double, area_key string"
RAIN = "area string, year int, rainfall_mm double, area_key string"
TEMP = "area_key string, year int, area string, avg_temp_c double"
YIELD = "area string, crop string, year int, yield_hg_ha long, area_key string"


def keys_of(spark, names):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    return [r["k"] for r in df.orderBy("i").select(area_key(F.col("n")).alias("k")).collect()]


def test_alias_and_case(spark):
    assert keys_of(spark, ["Viet Nam", "  FRANCE  ", "\tCzechia\n", None]) == ["vietnam", "france", "czech republic", None]


def test_every_alias_is_applied(spark):
    assert keys_of(spark, [n.upper() for n in AREA_ALIASES]) == list(AREA_ALIASES.values())


@pytest.mark.parametrize(
    "text, number",
    [("..", None), ("450", 450.0), (" 450.5 ", 450.5), ("n/a", None), ("1e3", 1000.0), ("", None), ("1d", None), ("nan", None), ("-.5", -0.5)],
)
def test_number_or_null(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(number_or_null(F.col("t"))).first()[0] == number


def test_rainfall_sentinel_and_padded_header(spark):
    raw = spark.createDataFrame([("Chad", 2000, ".."), ("Chad", 2001, "450")], "` Area` string, Year int, average_rain_fall_mm_per_year string")
    assert [r["rainfall_mm"] for r in clean_rainfall(raw).orderBy("year").collect()] == [None, 450.0]


def test_temp_is_averaged_within_the_year(spark):
    raw = spark.createDataFrame([(2000, "Kenya", 20.0), (2000, "Kenya", 22.0), (2000, "kenya ", 24.0), (2001, "Kenya", 21.0)], "year int, country string, avg_temp double")
    got = {(r["area_key"], r["year"]): r["avg_temp_c"] for r in clean_temp(raw).collect()}
    assert got == {("kenya", 2000): 22.0, ("kenya", 2001): 21.0}


def test_repeated_reading_counts_once(spark):
    raw = spark.createDataFrame([(2000, "Kenya", 20.0), (2000, "Kenya", 20.0), (2000, "Kenya", 23.0)], "year int, country string, avg_temp double")
    assert clean_temp(raw).first()["avg_temp_c"] == 21.5


def test_variant_by_name_counts_repeats(spark):
    raw = spark.createDataFrame([(2000, "Kenya", "20"), (2000, "Kenya", "20"), (2000, "Kenya", "23"), (2000, "kenya", "x")], "year int, country string, avg_temp string")
    assert {r["area"]: r["avg_temp_c"] for r in mean_temp_with_repeats(raw).collect()} == {"Kenya": 21.0, "kenya": None}


def merged(spark, temps):
    yields = spark.createDataFrame([("Kenya", "Maize", 2000, 1, "kenya"), ("Kenya", "Wheat", 2000, 2, "kenya")], YIELD)
    return merge_sources(yields, spark.createDataFrame([], PEST), spark.createDataFrame([], RAIN), spark.createDataFrame(temps, TEMP))


def test_join_keeps_rows_on_unique_keys(spark):
    rows = merged(spark, [("kenya", 2000, "Kenya", 20.0)]).collect()
    assert len(rows) == 2 and {r["avg_temp_c"] for r in rows} == {20.0} and {r["rainfall_mm"] for r in rows} == {None}


def test_join_fans_out_on_duplicate_keys(spark):
    assert merged(spark, [("kenya", 2000, "Kenya", 20.0), ("kenya", 2000, "KENYA", 22.0)]).count() == 4


def test_clean_yield_columns(spark):
    row = ("QC", "Crops", 1, "Kenya", 5419, "Yield", 56, "Maize", 2000, 2000, "hg/ha", 1000.0)
    raw = spark.createDataFrame([row], ", ".join(f"`{n}` {t}" for n, t in CONTRACTS["yield"].items()))
    cleaned = clean_yield(raw)
    assert cleaned.columns == ["area", "crop", "year", "yield_hg_ha", "area_key"]
    assert cleaned.first()["yield_hg_ha"] == 1000


def test_calendar_lag_is_null_across_a_gap(spark):
    rows = [("a", "c", 2000, 1), ("a", "c", 2001, 2), ("a", "c", 2003, 3)]
    df = spark.createDataFrame(rows, "area string, crop string, year int, yield_hg_ha long")
    assert {r["year"]: r["lag1_yield"] for r in with_previous_year(df, df).collect()} == {2000: None, 2001: 1, 2003: None}


def test_no_value_is_cut_off(spark):
    shape = "Area string, Item string, Year string, Value string, Unit string"
    raw = spark.createDataFrame([
        ("a", "Maize", "2000.0", "1234", "hg/ha"), ("b", "Maize", "2000.5", "1234", "hg/ha"), ("c", "Maize", "2001", "0.5", "hg/ha"),
        ("d", "Maize", "2001", "1234.7", "hg/ha"), ("e", "Maize", "99999999999", "99999999999999999999999", "hg/ha"),
    ], shape)
    got = {r["area"]: (r["year"], r["yield_hg_ha"]) for r in clean_yield(raw).collect()}
    assert got == {"a": (2000, 1234), "b": (None, 1234), "c": (2001, None), "d": (2001, None), "e": (None, None)}


def test_fractions_are_rejected_and_huge_numbers_are_null(spark):
    known = {"Item": "Maize", "Unit": "hg/ha"}
    cases = [{"Area": "a", "Year": "2000.0", "Value": "1234"}, {"Area": "b", "Year": "2000.5", "Value": "7"}, {"Area": "c", "Year": "2001", "Value": "0.5"}]
    raw = spark.createDataFrame([tuple((known | c).get(n, "x") for n in CONTRACTS["yield"]) for c in cases], ", ".join(f"`{n}` string" for n in CONTRACTS["yield"]))
    gate = inspect(raw, "yield")
    why = {r["Area"]: r["reject_reason"] for r in gate.rejected().collect()}
    assert why == {"b": "year_out_of_range", "c": "fractional_yield"}
    names = CONTRACTS["pesticides"]
    huge = spark.createDataFrame([tuple("99999999999" for _ in names)], ", ".join(f"`{n}` string" for n in names))
    assert as_contract_types(huge, "pesticides").first()["Year"] is None


def test_small_context_is_broadcast_and_facts_stay(spark, tmp_path):
    facts = spark.range(2000).selectExpr("concat('a', id % 50) area", "'Maize' crop", "cast(1990 + id % 20 as int) year", "id yield_hg_ha", "concat('a', id % 50) area_key")
    side = lambda name: spark.range(40).selectExpr("concat('a', id) area_key", "2000 year", f"cast(id as double) {name}")
    paths = []
    for i, df in enumerate((facts, side("pesticides_tonnes"), side("rainfall_mm"), side("avg_temp_c"))):
        df.write.parquet(str(tmp_path / str(i)))
        paths.append(spark.read.parquet(str(tmp_path / str(i))))
    plan = merge_sources(*paths)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3 and "hashpartitioning" not in plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = merge_sources(*paths)
        assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_alias_table_gives_the_keys_of_the_alias_map(spark):
    from furrow.functions.text import AREA_ALIASES, area_key, with_area_key

    aliases = spark.createDataFrame([*AREA_ALIASES.items(), ("viet nam", "vietnam"), (None, "nowhere")], "formal string, common string")
    names = spark.createDataFrame([(n,) for n in (" Viet Nam ", "LAOS", "Kenya", "", None, *AREA_ALIASES)], "area string")
    wanted = names.withColumn("area_key", area_key(F.col("area")))
    found = with_area_key(names, "area", aliases)
    assert found.columns == wanted.columns and sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = with_area_key(names, "area", aliases)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
