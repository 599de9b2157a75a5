"""Features, leakage, baseline and risk labels on the toy frame."""

import pytest
from pyspark.sql import functions as F

from furrow.models.baseline import HistoricalMean
from furrow.models.risk import label_risk, majority_class, risk_thresholds
from furrow.operators.evaluation import classification_report, confusion_counts, metrics_by_period, regression_metrics, temporal_split
from furrow.operators.features import (
    CONDITIONS, FeatureStats, TargetLeakage, assert_no_leakage, check_feature_order, leakage_report,
)


@pytest.fixture
def built(curated_toy):
    stats = FeatureStats.fit(curated_toy)
    return stats, stats.transform(curated_toy, curated_toy)


def test_columns_and_order(built):
    stats, features = built
    assert [c for c in features.columns if c not in ("area", "crop", "yield_hg_ha")] == stats.names
    assert stats.names == [
        "year", "is_post_1990", "rainfall_mm_missing", "rainfall_mm", "avg_temp_c_missing", "avg_temp_c", "pesticides_tonnes_missing",
        "pesticides_tonnes", "region_mean_yield", "lag1_yield_missing", "lag1_yield", "yield_trend_ratio", "crop_Maize",
    ]
    check_feature_order(stats.names, stats.names)
    with pytest.raises(ValueError):
        check_feature_order(stats.names[::-1], stats.names)


def test_nothing_is_left_missing(built):
    stats, features = built
    nulls = features.agg(*[F.count_if(F.col(f"`{n}`").isNull()).alias(n) for n in stats.names]).first()
    assert set(nulls.asDict().values()) == {0}


def rows_by_key(features):
    return {(r["area"], r["year"]): r for r in features.collect()}


def test_flags_medians_and_lag(built):
    rows = rows_by_key(built[1])
    assert [rows[k]["rainfall_mm_missing"] for k in (("Kenya", 2000), ("Kenya", 2001), ("Kenya", 2002), ("Uganda", 2002))] == [0, 1, 0, 0]
    assert rows[("Kenya", 2001)]["rainfall_mm"] == 550.0
    assert rows[("Kenya", 2001)]["lag1_yield"] == 10000 and rows[("Kenya", 2001)]["lag1_yield_missing"] == 0
    first = rows[("Kenya", 2000)]
    assert first["lag1_yield_missing"] == 1 and first["lag1_yield"] == 11000 and first["yield_trend_ratio"] == 1.0
    assert rows[("Kenya", 2002)]["yield_trend_ratio"] == pytest.approx(12000 / 11000)


def test_unseen_area_and_crop(built, spark, curated_toy):
    new = spark.createDataFrame([("Chad", "Yams", 1989, 5, None, None, None)], curated_toy.schema)
    row = built[0].transform(new, curated_toy).first()
    assert row["region_mean_yield"] == 10500 and row["crop_Maize"] == 0 and row["is_post_1990"] == 0 and row["pesticides_tonnes"] == 6.0


def test_statistics_survive_saving(built, spark, tmp_path, curated_toy):
    built[0].save(spark, str(tmp_path))
    again = FeatureStats.load(spark, str(tmp_path))
    assert (again.names, again.medians, again.global_mean) == (built[0].names, built[0].medians, built[0].global_mean)
    assert rows_by_key(again.transform(curated_toy, curated_toy)) == rows_by_key(built[1])


def test_leakage(built):
    stats, features = built
    assert_no_leakage(features, stats.names)
    for copy in (F.col("yield_hg_ha"), 2 * F.col("yield_hg_ha") + 1, -F.col("yield_hg_ha")):
        with pytest.raises(TargetLeakage, match="planted"):
            assert_no_leakage(features.withColumn("planted", copy), [*stats.names, "planted"])
    flat = leakage_report(features.withColumn("flat", F.lit(1)), ["flat"]).first()
    assert flat["constant"] and not flat["leaks"] and flat["r"] is None


SHAPE = "area string, crop string, year int, yield_hg_ha long"


def test_baseline_falls_back_twice(spark):
    train = spark.createDataFrame([("a", "x", 2000, 10), ("a", "x", 2001, 20), ("b", "x", 2000, 30), ("b", "y", 2000, 100)], SHAPE)
    test = spark.createDataFrame([("a", "x", 2005, 0), ("c", "x", 2005, 0), ("c", "z", 2005, 0)], SHAPE)
    fit = HistoricalMean.fit(train)
    got = {(r["area"], r["crop"]): r["prediction"] for r in fit.predict(test).collect()}
    assert got == {("a", "x"): 15.0, ("c", "x"): 20.0, ("c", "z"): 40.0}
    assert fit.cold_start(test).count() == 2


def test_split_and_regression_metrics(spark):
    df = spark.createDataFrame([(2004, 10, 12.0), (2005, 20, 20.0), (2006, 40, 34.0)], "year int, yield_hg_ha long, prediction double")
    train, test = temporal_split(df, 2005)
    assert train.count() == 1 and test.count() == 2
    m = regression_metrics(df).first()
    assert m["n"] == 3 and m["mae"] == pytest.approx(8 / 3) and m["rmse"] == pytest.approx((40 / 3) ** 0.5)
    assert m["r2"] == pytest.approx(1 - 40 / (10 + 20 + 40 and sum((y - 70 / 3) ** 2 for y in (10, 20, 40))))
    assert {r["period_start"]: r["n"] for r in metrics_by_period(df).collect()} == {2004: 3}


def test_risk_is_strictly_below_the_quantile(spark):
    train = spark.createDataFrame([("a", "x", 2000, v) for v in (10, 20, 30, 40, 50)], SHAPE)
    rows = spark.createDataFrame([("a", "x", 2005, 19), ("a", "x", 2005, 20), ("a", "new", 2005, 1)], SHAPE)
    cuts = risk_thresholds(train)
    assert cuts.first()["threshold"] == 20.0
    assert {(r["crop"], r["yield_hg_ha"]): r["label"] for r in label_risk(rows, cuts).collect()} == {("x", 19): 1, ("x", 20): 0, ("new", 1): 0}


def test_classification_report_and_majority(spark):
    df = spark.createDataFrame([(0, 0)] * 5 + [(0, 1)] + [(1, 0)] * 2 + [(1, 1)], "label int, prediction int")
    got = {r["class_name"]: r for r in classification_report(confusion_counts(df)).collect()}
    high = got["high_risk"]
    assert (high["precision"], high["support"]) == (0.5, 3) and high["recall"] == pytest.approx(1 / 3) and high["f1"] == pytest.approx(0.4)
    assert got["low_risk"]["precision"] == pytest.approx(5 / 7) and high["accuracy"] == pytest.approx(6 / 9)
    always = classification_report(confusion_counts(majority_class(df, df.drop("prediction"))))
    worst = {r["class_name"]: r for r in always.collect()}["high_risk"]
    assert (worst["precision"], worst["recall"], worst["f1"]) == (0.0, 0.0, 0.0)


def test_conditions_are_the_three_context_columns():
    assert CONDITIONS == ("rainfall_mm", "avg_temp_c", "pesticides_tonnes")
