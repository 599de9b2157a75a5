"""Contracts, every row rule, the null rules and the gate."""

from collections import Counter

import pytest

from furrow.operators import quality
from furrow.operators.quality import RULES, Rule, inspect, overall_quality, repeat_rows
from furrow.sources.contracts import CONTRACTS, check_contract

YIELD_DDL = ", ".join(f"`{n}` {'double' if n == 'Value' else t}" for n, t in CONTRACTS["yield"].items())


def yield_row(item="Maize", year=2000, unit="hg/ha", value=15000.0, area="Kenya"):
    return ("QC", "Crops", 1, area, 5419, "Yield", 56, item, 2000, year, unit, value)


def reasons_of(spark, source, row, ddl):
    got = inspect(spark.createDataFrame([row], ddl), source).rejected().collect()
    return got[0]["reject_reason"] if got else ""


def test_contract():
    assert check_contract(CONTRACTS["pesticides"], "pesticides").passed
    broken = check_contract(["Domain", "Area"], "pesticides")
    assert not broken.passed and broken.missing == ("Element", "Item", "Year", "Unit", "Value")
    assert check_contract([" Area", "Year", "average_rain_fall_mm_per_year"], "rainfall").passed


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, ""),
        ({"value": 0.0}, "non_positive_yield"),
        ({"value": 1_000_000.0}, "implausible_yield_over_800000_hg_ha"),
        ({"value": 800_000.0}, ""),
        ({"value": None}, ""),
        ({"item": "NotARealCrop"}, "unknown_crop_category"),
        ({"item": None}, "unknown_crop_category"),
        ({"unit": "kg/ha"}, "unexpected_unit"),
        ({"unit": None}, "unexpected_unit"),
        ({"year": 1750}, ""),
        ({"year": -5}, "year_out_of_range"),
        ({"year": 2027}, "year_out_of_range"),
        ({"year": None}, ""),
        ({"value": -1.0, "unit": None, "year": 1}, "year_out_of_range;non_positive_yield;unexpected_unit"),
    ],
)
def test_yield_rules(spark, change, reason):
    assert reasons_of(spark, "yield", yield_row(**change), YIELD_DDL) == reason


@pytest.mark.parametrize("value, reason", [("..", ""), ("-1", "implausible_rainfall"), ("15001", "implausible_rainfall"), ("15000", ""), ("x", "")])
def test_rainfall_rule(spark, value, reason):
    assert reasons_of(spark, "rainfall", ("Chad", 2000, value), "` Area` string, Year int, average_rain_fall_mm_per_year string") == reason


@pytest.mark.parametrize("value, reason", [(500.0, "implausible_temp"), (-90.5, "implausible_temp"), (60.0, ""), (None, "")])
def test_temp_rule(spark, value, reason):
    assert reasons_of(spark, "temp", (1750, "Kenya", value), "year int, country string, avg_temp double") == reason


def test_negative_pesticide_use(spark):
    ddl = "Domain string, Area string, Element string, Item string, Year int, Unit string, Value string"
    assert reasons_of(spark, "pesticides", ("d", "a", "e", "i", 2000, "t", "-0.5"), ddl) == "negative_pesticide_use"
    assert reasons_of(spark, "pesticides", ("d", "a", "e", "i", 2000, "t", "0"), ddl) == ""


def test_copies_and_counts(spark):
    rows = [(2000, "Kenya", 20.0)] * 3 + [(2000, "Kenya", 500.0)] * 2 + [(2001, "Kenya", None)]
    gate = inspect(spark.createDataFrame(rows, "year int, country string, avg_temp double"), "temp")
    assert sorted(tuple(r) for r in gate.accepted().collect() if r["avg_temp"]) == [(2000, "Kenya", 20.0)]
    assert gate.accepted().count() == 2
    rejected = Counter((r["avg_temp"], r["reject_reason"]) for r in gate.rejected().collect())
    assert rejected == {(20.0, "duplicate_row"): 2, (500.0, "implausible_temp"): 1, (500.0, "duplicate_row;implausible_temp"): 1}
    report = gate.report().first()
    assert (report["total_records"], report["accepted_records"], report["rejected_records"]) == (6, 2, 4)
    assert report["rejection_reason_counts"] == {"duplicate_row": 3, "implausible_temp": 2}
    assert report["null_counts"] == {"year": 0, "country": 0, "avg_temp": 1}
    assert report["quality_score_pct"] == 33.33 and report["validation_status"] == "FAILED"
    assert {r["reason"]: r["n"] for r in gate.reason_counts().collect()} == report["rejection_reason_counts"]


def test_missing_column_rejects_everything(spark):
    rows = [(2000, "Kenya")] * 3 + [(2001, "Kenya")]
    gate = inspect(spark.createDataFrame(rows, "year int, country string"), "temp")
    assert gate.accepted().count() == 0 and gate.accepted().columns == ["year", "country"]
    assert [r["reject_reason"] for r in gate.rejected().collect()] == ["schema_validation_failed"] * 4
    report = gate.report().first()
    assert report["schema_missing_columns"] == ["avg_temp"] and report["rejected_records"] == 4
    assert report["rejection_reason_counts"] == {"schema_validation_failed": 4} and report["null_counts"] == {}
    assert report["quality_score_pct"] == 0.0 and report["validation_status"] == "FAILED"


def test_empty_source(spark):
    report = inspect(spark.createDataFrame([], "year int, country string, avg_temp double"), "temp").report().first()
    assert report["total_records"] == 0 and report["quality_score_pct"] == 0.0 and report["rejection_reason_counts"] == {}


def test_custom_rules_without_a_copy_rule_keep_copies(spark):
    df = spark.createDataFrame([(2000, "Kenya", 1.0)] * 3 + [(2000, "Mali", -1.0)] * 2, "year int, country string, avg_temp double")
    gate = inspect(df, "temp", [Rule("cold", lambda c: c("avg_temp") < 0)])
    assert gate.accepted().count() == 3
    assert [r["reject_reason"] for r in gate.rejected().collect()] == ["cold", "cold"]
    assert gate.report().first()["accepted_records"] == 3


def test_status_bands_and_overall(spark):
    shape = "source string, total_records long, accepted_records long"
    df = spark.createDataFrame([("a", 100, 95), ("b", 100, 80), ("c", 100, 79)], shape)
    from pyspark.sql import functions as F

    got = df.select(quality.quality_status(F.col("accepted_records"), F.col("total_records"))).collect()
    assert [r[0] for r in got] == ["PASSED", "PASSED_WITH_WARNINGS", "FAILED"]
    total = overall_quality(df).first()
    assert (total["overall_total_records"], total["overall_accepted_records"], total["overall_quality_score_pct"]) == (300, 254, 84.67)


def test_repeat_rows_in_blocks(spark):
    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 0), ("d", 10)], "k string, n long")
    assert Counter(r["k"] for r in repeat_rows(df, "n", block=10).collect()) == {"a": 25, "b": 1, "d": 10}


def test_one_hot_row_of_copies_is_folded_before_the_shuffle(spark):
    """A third of all rows being one row must not land in one task."""
    base = spark.range(3000).selectExpr("2000 AS year", "'Kenya' AS country", "CASE WHEN id % 3 = 0 THEN 1.0D ELSE CAST(id % 50 AS DOUBLE) END AS avg_temp")
    gate = inspect(base, "temp")
    plan = gate.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2  # partial before, final after the exchange
    assert gate.accepted().count() == 50 and gate.rejected().count() == 2950


def test_rules_are_listed_in_order():
    assert [r.reason for r in RULES["yield"]] == [
        "duplicate_row", "year_out_of_range", "non_positive_yield", "implausible_yield_over_800000_hg_ha", "unknown_crop_category", "unexpected_unit",
    ]
