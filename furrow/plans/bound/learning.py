"""Features, baselines, risk labels, models and explanations (M and V, A-16 to A-23).

Fitted MLlib models have no SQL counterpart; those queries return metrics and
invariants, and the rest is pinned by the tests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.models import bundle, clustering, explain, regression, risk, scoring, search, splits
from furrow.models.baseline import HistoricalMean
from furrow.models.scenarios import WhatIf, actual_and_predicted, curve_spread
from furrow.operators import evaluation as ev
from furrow.operators.aggregates import group_rate, label_counts
from furrow.operators.features import CONDITIONS, check_feature_order, leakage_report, long_form
from furrow.operators.ordered import exact_quantiles
from furrow.operators.statistics import mean_z_by
from furrow.plans.bound.registry import bound, rounded
from furrow.plans.bound.tables import CUTOFF, TRAIN_CTES, Tables, on_curated
from furrow.session import scratch_path, settle

Y = "yield_hg_ha"


# ---- features -----------------------------------------------------------------------------

@bound("m1_condition_medians", on_curated("""
    SELECT 'rainfall_mm' AS feature, r AS median FROM med UNION ALL SELECT 'avg_temp_c', round(t, 6) FROM med UNION ALL SELECT 'pesticides_tonnes', p FROM med""", TRAIN_CTES))
def m1(t: Tables) -> DataFrame:
    middle = exact_quantiles(long_form(t.split[0], CONDITIONS), "value", [0.5], ["feature"])
    return rounded(middle.select("feature", F.col("quantiles")[0].alias("median")), 6, "median")


@bound("a16_training_means", on_curated("""
    SELECT area, round(avg(yield_hg_ha), 4) AS region_mean_yield, (SELECT round(avg(yield_hg_ha), 4) FROM train) AS global_mean FROM train GROUP BY area""", TRAIN_CTES))
def a16(t: Tables) -> DataFrame:
    means = t.stats.region_means.withColumn("global_mean", F.lit(t.stats.global_mean))
    return rounded(means, 4, "region_mean_yield", "global_mean")


_ROUNDED = "round(avg_temp_c, 6) AS avg_temp_c, round(region_mean_yield, 4) AS region_mean_yield, round(lag1_yield, 4) AS lag1_yield, round(yield_trend_ratio, 8) AS yield_trend_ratio"
_CROP_FLAGS = ", ".join(f"CAST(crop = '{c}' AS BIGINT) AS \"crop_{c}\"" for c in ("Maize", "Potatoes", "Rice, paddy", "Sorghum", "Wheat"))


@bound("m2_features", on_curated(f"""
    SELECT area, crop, yield_hg_ha, year, is_post_1990, rainfall_mm_missing, rainfall_mm, avg_temp_c_missing, pesticides_tonnes_missing, pesticides_tonnes,
           lag1_yield_missing, {_ROUNDED}, {_CROP_FLAGS} FROM feat""", TRAIN_CTES))
def m2(t: Tables) -> DataFrame:
    table = t.stats.transform(t.settled, t.settled)
    return rounded(rounded(rounded(table, 6, "avg_temp_c"), 4, "region_mean_yield", "lag1_yield"), 8, "yield_trend_ratio")


@bound("g7_leakage_check", on_curated("""
    SELECT 'copy' AS feature, true AS identical, true AS leaks UNION ALL SELECT 'double_plus_one', false, true
    UNION ALL SELECT 'lag1_yield', false, false UNION ALL SELECT 'year', false, false
    UNION ALL SELECT 'flat', false, false WHERE EXISTS (SELECT 1 FROM curated)"""))
def g7(t: Tables) -> DataFrame:
    table = t.features[0].withColumns({"copy": F.col(Y), "double_plus_one": 2 * F.col(Y) + 1, "flat": F.lit(3)})
    return leakage_report(table, ["copy", "double_plus_one", "lag1_yield", "year", "flat"]).select("feature", "identical", "leaks")


#: Folders of the tuned forests that this application has written, by the tables they are for.
_TUNED: dict[tuple[str, str], tuple[str, list]] = {}


def _tuned(t: Tables) -> tuple[bundle.Bundle, list[tuple[int, int, float, int]]]:
    """The forest that wins the search over the whole grid and four folds, and the search's
    rows. It is searched and fitted once for a folder of tables, saved as a bundle, and
    loaded by every question that needs it."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _TUNED:
        model, found = search.tuned_forest(t.features[0], t.stats.names)
        path = scratch_path(t.spark, "tuned-forest")
        bundle.save(bundle.Bundle("yield", model, t.stats), t.spark, path)
        _TUNED[key] = (path, found)
    path, found = _TUNED[key]
    return bundle.load(t.spark, path, "yield"), found


@bound("g8_feature_order", on_curated("""
    SELECT 'year,is_post_1990,rainfall_mm_missing,rainfall_mm,avg_temp_c_missing,avg_temp_c,pesticides_tonnes_missing,pesticides_tonnes,region_mean_yield,lag1_yield_missing,lag1_yield,yield_trend_ratio,'
           || string_agg('crop_' || crop, ',' ORDER BY crop) AS feature_columns FROM (SELECT DISTINCT crop FROM train) c""", TRAIN_CTES))
def g8(t: Tables) -> DataFrame:
    # The order a saved model was trained on, as its bundle tells it; loading checks it.
    path = scratch_path(t.spark, "feature-order")
    train, names = t.features[0], t.stats.names
    bundle.save(bundle.Bundle("yield", regression.linear(train, names), t.stats), t.spark, path)
    check_feature_order(bundle.load(t.spark, path).stats.names, [c for c in train.columns if c not in ("area", "crop", Y)])
    return bundle.versions(t.spark, path).select(F.array_join("feature_columns", ",").alias("feature_columns"))


# ---- baseline and metrics -----------------------------------------------------------------

def _baseline(t: Tables) -> DataFrame:
    return HistoricalMean.fit(t.split[0]).predict(t.settled)


_METRICS = """count(*) AS n, round(avg(abs(yield_hg_ha - prediction)), 4) AS mae, round(sqrt(avg((yield_hg_ha - prediction) ** 2)), 4) AS rmse,
    round(1 - avg((yield_hg_ha - prediction) ** 2) / var_pop(yield_hg_ha), 6) AS r2"""


@bound("m3_baseline_predictions", on_curated(f"SELECT area, crop, year, yield_hg_ha, round(prediction, 4) AS prediction FROM base WHERE year >= {CUTOFF}", TRAIN_CTES))
def m3(t: Tables) -> DataFrame:
    told = HistoricalMean.fit(t.split[0]).predict(t.split[1])
    return rounded(told.select("area", "crop", "year", Y, "prediction"), 4, "prediction")


@bound("a18_two_level_means", on_curated("""
    SELECT 'pair' AS level, area, crop, round(avg(yield_hg_ha), 4) AS mean FROM train GROUP BY 2, 3
    UNION ALL SELECT 'crop', NULL, crop, round(avg(yield_hg_ha), 4) FROM train GROUP BY crop
    UNION ALL SELECT 'all', NULL, NULL, round(avg(yield_hg_ha), 4) FROM train""", TRAIN_CTES))
def a18(t: Tables) -> DataFrame:
    fit = HistoricalMean.fit(t.split[0])
    nothing = F.lit(None).cast("string")
    levels = [
        fit.by_area_crop.select(F.lit("pair").alias("level"), "area", "crop", F.col("_pair_mean").alias("mean")),
        fit.by_crop.select(F.lit("crop").alias("level"), nothing.alias("area"), "crop", F.col("_crop_mean").alias("mean")),
        fit.overall.select(F.lit("all").alias("level"), nothing.alias("area"), nothing.alias("crop"), F.col("_overall").alias("mean")),
    ]
    return rounded(reduce(DataFrame.unionByName, levels), 4, "mean")


@bound("m4_baseline_metrics", on_curated(f"""
    SELECT CASE WHEN year < {CUTOFF} THEN 'train' ELSE 'test' END AS split, {_METRICS} FROM base GROUP BY 1""", TRAIN_CTES))
def m4(t: Tables) -> DataFrame:
    split = F.when(F.col("year") < CUTOFF, "train").otherwise("test")
    told = ev.regression_metrics(_baseline(t).withColumn("split", split), by=["split"])
    return rounded(rounded(told, 4, "mae", "rmse"), 6, "r2")


@bound("m21_metrics_by_period", on_curated(f"""
    SELECT CAST(floor(year / 3.0) * 3 AS BIGINT) AS period_start, count(*) AS n, round(avg(abs(yield_hg_ha - prediction)), 1) AS mae,
           round(sqrt(avg((yield_hg_ha - prediction) ** 2)), 1) AS rmse, round(1 - avg((yield_hg_ha - prediction) ** 2) / var_pop(yield_hg_ha), 4) AS r2
    FROM base GROUP BY 1""", TRAIN_CTES))
def m21(t: Tables) -> DataFrame:
    return ev.metrics_by_period(_baseline(t))


# ---- risk ---------------------------------------------------------------------------------

@bound("a17_risk_thresholds", on_curated("SELECT crop, threshold FROM threshold", TRAIN_CTES))
def a17(t: Tables) -> DataFrame:
    return risk.risk_thresholds(t.split[0])


def _labelled(t: Tables) -> DataFrame:
    return risk.label_risk(t.settled, risk.risk_thresholds(t.split[0]))


@bound("m11_risk_labels", on_curated("SELECT area, crop, year, label FROM risk", TRAIN_CTES))
def m11(t: Tables) -> DataFrame:
    return _labelled(t).select("area", "crop", "year", "label")


@bound("m11_unseen_crop", on_curated("SELECT crop, CAST(sum(CASE WHEN crop = 'Maize' THEN 0 ELSE label END) AS BIGINT) AS n_high_risk FROM risk GROUP BY crop", TRAIN_CTES))
def m11_unseen(t: Tables) -> DataFrame:
    thresholds = risk.risk_thresholds(t.split[0].where("crop <> 'Maize'"))
    return risk.label_risk(t.settled, thresholds).groupBy("crop").agg(F.sum("label").alias("n_high_risk"))


@bound("a20_label_counts", on_curated("SELECT label, count(*) AS n FROM risk GROUP BY label", TRAIN_CTES))
def a20(t: Tables) -> DataFrame:
    return label_counts(_labelled(t), "label")


@bound("a21_risk_rate_by_area", on_curated(f"""
    SELECT area, round(avg(label), 8) AS rate, count(*) AS n FROM risk WHERE year >= {CUTOFF} GROUP BY area HAVING count(*) >= 5
    ORDER BY avg(label) DESC, area LIMIT 10""", TRAIN_CTES))
def a21(t: Tables) -> DataFrame:
    _, test = ev.temporal_split(_labelled(t), CUTOFF)
    return rounded(group_rate(test, "area", "label"), 8, "rate")


@bound("a23_class_balance", on_curated(f"""
    SELECT CASE WHEN year < {CUTOFF} THEN 'train' ELSE 'test' END AS split, round(avg(label), 8) AS high_risk_rate, CAST(sum(label) AS BIGINT) AS n_high_risk, count(*) AS n
    FROM risk GROUP BY 1""", TRAIN_CTES))
def a23(t: Tables) -> DataFrame:
    sides = zip(("train", "test"), ev.temporal_split(_labelled(t), CUTOFF))
    told = reduce(DataFrame.unionByName, [risk.class_balance(rows).withColumn("split", F.lit(name)) for name, rows in sides])
    return rounded(told, 8, "high_risk_rate")


@bound("m12_majority_class", on_curated(f"""
    SELECT CAST((SELECT label FROM risk WHERE year < {CUTOFF} GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) AS BIGINT) AS predicted, label AS actual, count(*) AS n
    FROM risk WHERE year >= {CUTOFF} GROUP BY label""", TRAIN_CTES))
def m12(t: Tables) -> DataFrame:
    train, test = ev.temporal_split(_labelled(t), CUTOFF)
    return ev.confusion_counts(risk.majority_class(train, test))


# A stand-in classifier both engines can compute: below the threshold last year.
_SCORED = f"""scored AS (SELECT f.area, f.crop, f.year, r.label, CAST(f.lag1_yield < t.threshold AS BIGINT) AS predicted, t.threshold - f.lag1_yield AS score
    FROM feat f JOIN risk r ON f.area = r.area AND f.crop = r.crop AND f.year = r.year JOIN threshold t ON f.crop = t.crop WHERE f.year >= {CUTOFF})"""


def _lag_classifier(t: Tables) -> DataFrame:
    thresholds = risk.risk_thresholds(t.split[0])
    labelled = risk.label_risk(t.features[1], thresholds).join(thresholds, "crop")
    return labelled.withColumns({
        "prediction": (F.col("lag1_yield") < F.col("threshold")).cast("int"), "score": F.round(F.col("threshold") - F.col("lag1_yield"), 4)
    })


@bound("m16_confusion_matrix", on_curated("SELECT label AS actual, predicted, count(*) AS n FROM scored GROUP BY 1, 2", TRAIN_CTES + ", " + _SCORED))
def m16(t: Tables) -> DataFrame:
    return ev.confusion_counts(_lag_classifier(t))


_CELLS = "cells AS (SELECT sum((1 - label) * (1 - predicted)) AS tn, sum((1 - label) * predicted) AS fp, sum(label * (1 - predicted)) AS fn, sum(label * predicted) AS tp FROM scored)"


@bound("m16_classification_report", on_curated("""
    SELECT 'high_risk' AS class_name, round(coalesce(tp / nullif(tp + fp, 0), 0), 8) AS "precision", round(coalesce(tp / nullif(tp + fn, 0), 0), 8) AS recall,
           round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 8) AS f1, CAST(tp + fn AS BIGINT) AS support, round((tp + tn) / (tp + tn + fp + fn), 8) AS accuracy FROM cells
    UNION ALL SELECT 'low_risk', round(coalesce(tn / nullif(tn + fn, 0), 0), 8), round(coalesce(tn / nullif(tn + fp, 0), 0), 8),
           round(coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0), 8), CAST(tn + fp AS BIGINT), round((tp + tn) / (tp + tn + fp + fn), 8) FROM cells""",
    TRAIN_CTES + ", " + _SCORED + ", " + _CELLS))
def m16_report(t: Tables) -> DataFrame:
    told = ev.classification_report(ev.confusion_counts(_lag_classifier(t)))
    return rounded(told, 8, "precision", "recall", "f1", "accuracy")


@bound("m17_roc_auc", on_curated("""
    SELECT round((sum(CASE WHEN label = 1 THEN place END) - any_value(p) * (any_value(p) + 1) / 2.0) / (any_value(p) * any_value(n)), 8) AS roc_auc,
           CAST(any_value(p) AS BIGINT) AS n_positive, CAST(any_value(n) AS BIGINT) AS n_negative
    FROM (SELECT label, rank() OVER (ORDER BY round(score, 4)) + (count(*) OVER (PARTITION BY round(score, 4)) - 1) / 2.0 AS place,
                 sum(label) OVER () AS p, sum(1 - label) OVER () AS n FROM scored) r""", TRAIN_CTES + ", " + _SCORED))
def m17(t: Tables) -> DataFrame:
    return rounded(ev.roc_auc(_lag_classifier(t), "score"), 8, "roc_auc")


# ---- conditions ---------------------------------------------------------------------------

_CONDITIONS = "cond AS (SELECT DISTINCT area, year, rainfall_mm, round(avg_temp_c, 6) AS avg_temp_c, pesticides_tonnes FROM curated WHERE rainfall_mm IS NOT NULL AND avg_temp_c IS NOT NULL AND pesticides_tonnes IS NOT NULL)"


@bound("m18_conditions_table", on_curated("SELECT * FROM cond", _CONDITIONS))
def m18(t: Tables) -> DataFrame:
    return rounded(clustering.conditions_table(t.settled), 6, "avg_temp_c")


_PROFILE_Z = """z AS (SELECT area, year, avg((yield_hg_ha - m) / s) AS z FROM curated c
    JOIN (SELECT crop AS k, avg(yield_hg_ha) AS m, stddev_samp(yield_hg_ha) AS s FROM curated GROUP BY crop) g ON c.crop = g.k GROUP BY 1, 2)"""


@bound("a22_cluster_profile", on_curated("""
    SELECT CAST(floor(c.rainfall_mm / 500) AS BIGINT) AS cluster, round(avg(c.rainfall_mm), 4) AS rainfall_mm, round(avg(c.avg_temp_c), 4) AS avg_temp_c,
           round(avg(c.pesticides_tonnes), 4) AS pesticides_tonnes, count(*) AS n_region_years, round(avg(z), 6) AS mean_yield_zscore
    FROM cond c LEFT JOIN z ON c.area = z.area AND c.year = z.year GROUP BY 1""", _CONDITIONS + ", " + _PROFILE_Z))
def a22(t: Tables) -> DataFrame:
    grouped = clustering.conditions_table(t.settled).withColumn("prediction", F.floor(F.col("rainfall_mm") / 500))
    told = clustering.profile_clusters(grouped, t.settled)
    return rounded(rounded(told, 4, *CONDITIONS), 6, "mean_yield_zscore")


@bound("j12_mean_z_of_conditions", on_curated("""
    SELECT c.area, c.year, round(z, 6) AS z FROM cond c LEFT JOIN z ON c.area = z.area AND c.year = z.year""", _CONDITIONS + ", " + _PROFILE_Z))
def j12(t: Tables) -> DataFrame:
    joined = clustering.conditions_table(t.settled).join(mean_z_by(t.settled, ["area", "year"], "z"), ["area", "year"], "left")
    return rounded(joined.select("area", "year", "z"), 6, "z")


@bound("m13_scaled_conditions", "SELECT CAST(i AS BIGINT) AS position, CAST(0 AS DOUBLE) AS mean, CAST(1 AS DOUBLE) AS sd FROM range(3) r(i)")
def m13(t: Tables) -> DataFrame:
    _, scaled = clustering.scale_conditions(clustering.conditions_table(t.settled))
    parts = scaled.select(F.posexplode(vector_to_array("features")).alias("position", "v"))
    return rounded(parts.groupBy("position").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd")), 6, "mean", "sd")


@bound("m19_cluster_search")
def m19(t: Tables) -> DataFrame:
    _, scaled = clustering.scale_conditions(clustering.conditions_table(t.settled))
    return clustering.search_k(settle(scaled))


@bound("m20_kmeans_profile")
def m20(t: Tables) -> DataFrame:
    _, scaled = clustering.scale_conditions(clustering.conditions_table(t.settled))
    scaled = settle(scaled)
    return clustering.profile_clusters(clustering.fit_clusters(scaled).transform(scaled), t.settled)


@bound("m19_search_holds", on_curated("SELECT 7 AS n_k, true AS inertia_falls, true AS silhouettes_in_range", ""))
def m19_holds(t: Tables) -> DataFrame:
    told = m19(t)
    step = F.col("inertia") - F.lag("inertia").over(Window.orderBy("k"))
    return told.withColumn("step", step).agg(
        F.count(F.lit(1)).alias("n_k"), F.every(F.coalesce(F.col("step") <= 0, F.lit(True))).alias("inertia_falls"),
        F.every(F.col("silhouette").between(-1, 1)).alias("silhouettes_in_range"),
    )


@bound("m20_clusters_hold", on_curated("SELECT count(*) AS n_region_years, true AS none_empty, true AS means_agree FROM cond", _CONDITIONS))
def m20_holds(t: Tables) -> DataFrame:
    told = m20(t)
    whole = clustering.conditions_table(t.settled).agg(F.avg("rainfall_mm")).scalar()
    mean = F.sum(F.col("rainfall_mm") * F.col("n_region_years")) / F.sum("n_region_years")
    return told.agg(F.sum("n_region_years").alias("n_region_years"), F.every(F.col("n_region_years") > 0).alias("none_empty"), (F.abs(mean - F.max(whole)) < 1e-6).alias("means_agree"))


# ---- regressors and classifiers -----------------------------------------------------------

def _forest(t: Tables):
    return _tuned(t)[0].model


def _fits(t: Tables) -> DataFrame:
    train, test = t.features
    names = t.stats.names
    models = {
        "linear": regression.linear(train, names),
        "tree_unconstrained": regression.tree(train, names),
        "tree_depth_8": regression.tree(train, names, 8),
        "forest": _forest(t),
    }
    base = HistoricalMean.fit(t.split[0])
    told = [
        ev.regression_metrics(base.predict(rows)).select(F.lit("baseline").alias("model"), F.lit(side).alias("split"), "n", "mae", "rmse", "r2")
        for side, rows in zip(("train", "test"), t.split)
    ]
    told += [regression.train_and_test(name, model, train, test) for name, model in models.items()]
    return reduce(DataFrame.unionByName, told)


@bound("m5_m7_m9_m10_model_summary")
def m10(t: Tables) -> DataFrame:
    return _fits(t)


def _both_predictions(plain: Model, flat: Model, rows: DataFrame) -> DataFrame:
    once = plain.transform(rows).withColumnRenamed("prediction", "linear").drop("features")
    return flat.transform(once).withColumnRenamed("prediction", "ridge")


@bound("m6_ridge_shrinks", on_curated("""
    SELECT count(*) AS n_train, true AS shrunk, true AS linear_is_centred, true AS ridge_is_centred, true AS linear_fits_closer FROM train""", TRAIN_CTES))
def m6(t: Tables) -> DataFrame:
    """Both fits scored on their training rows: no penalty fits closer, and as the intercept
    is not penalised neither fit errs to one side."""
    train, _ = t.features
    plain, flat = regression.linear(train, t.stats.names), regression.ridge(train, t.stats.names)
    shrunk = regression.coefficient_norm(flat) <= regression.coefficient_norm(plain)
    linear_error, ridge_error = F.col(Y) - F.col("linear"), F.col(Y) - F.col("ridge")

    def centred(error: Column) -> Column:
        return F.abs(F.avg(error)) <= 1e-6 * F.avg(Y)

    return _both_predictions(plain, flat, train).agg(
        F.count(F.lit(1)).alias("n_train"),
        F.lit(shrunk).alias("shrunk"),
        centred(linear_error).alias("linear_is_centred"),
        centred(ridge_error).alias("ridge_is_centred"),
        (F.sum(linear_error * linear_error) <= F.sum(ridge_error * ridge_error) * (1 + 1e-9)).alias("linear_fits_closer"),
    )


@bound("m8_forest_search")
def m8(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(_tuned(t)[1], "trees int, depth int, mean_mae double, n_folds int")


@bound("m8_search_holds", on_curated(f"""
    SELECT 3 AS n_sizes, 4 AS n_folds, true AS winner_is_least, true AS all_scored, (SELECT count(*) FROM train) AS n_train, true AS model_is_winner""", TRAIN_CTES))
def m8_holds(t: Tables) -> DataFrame:
    tuned, found = _tuned(t)
    rows = t.spark.createDataFrame([(i, *f) for i, f in enumerate(found)], "place int, trees int, depth int, mean_mae double, n_folds int")
    forest = regression.fitted(tuned.model)
    deep = max(tree.depth for tree in forest.trees)
    return t.features[0].agg(F.count(F.lit(1)).alias("n_train")).crossJoin(rows.agg(
        F.count(F.lit(1)).alias("n_sizes"), F.max("n_folds").alias("n_folds"),
        (F.min("mean_mae") == F.min_by("mean_mae", "place")).alias("winner_is_least"), F.every(F.col("mean_mae") > 0).alias("all_scored"),
        F.min_by((F.lit(forest.getNumTrees) == F.col("trees")) & (F.lit(deep) <= F.col("depth")), "place").alias("model_is_winner"),
    ))


@bound("m8_folds", on_curated("""
    SELECT i AS fold, CAST(sum(CASE WHEN place < cut THEN n ELSE 0 END) AS BIGINT) AS n_train,
           CAST(sum(CASE WHEN place >= cut AND place < next THEN n ELSE 0 END) AS BIGINT) AS n_check
    FROM (SELECT year, count(*) AS n, row_number() OVER (ORDER BY year) - 1 AS place, count(*) OVER () AS years FROM train GROUP BY year) y,
         (SELECT i, (i + 1) * k // 5 AS cut, CASE WHEN i = 3 THEN k ELSE (i + 2) * k // 5 END AS next FROM range(4) r(i), (SELECT count(DISTINCT year) AS k FROM train) c) f
    GROUP BY i""", TRAIN_CTES))
def m8_folds(t: Tables) -> DataFrame:
    told = []
    for i, (train, check) in enumerate(search.year_folds(t.features[0])):
        sides = train.agg(F.count(F.lit(1)).alias("n_train")).crossJoin(check.agg(F.count(F.lit(1)).alias("n_check")))
        told.append(sides.withColumn("fold", F.lit(i)))
    return reduce(DataFrame.unionByName, told)


# The exact splits, and the root of the tree that MLlib grows with a bin for each value.

_LONG_NAMES = ("year", "is_post_1990", "rainfall_mm_missing", "rainfall_mm", "avg_temp_c_missing", "pesticides_tonnes_missing", "pesticides_tonnes", "lag1_yield_missing")


def _splits_sql(target: str, columns: str) -> str:
    cells = " UNION ALL ".join(f"SELECT '{n}' AS feature, CAST({n} AS DOUBLE) AS v, CAST({target} AS DOUBLE) AS y FROM told" for n in _LONG_NAMES)
    return f"""SELECT {columns} FROM (
        SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, v) AS place FROM (
            SELECT feature, v, nb, nt - nb AS nr, yb * yb / nb + (yt - yb) * (yt - yb) / (CAST(nt AS DOUBLE) - CAST(nb AS DOUBLE)) - yt * yt / nt AS gain FROM (
                SELECT feature, v, sum(n) OVER w - n AS nb, sum(y) OVER w - y AS yb, sum(n) OVER (PARTITION BY feature) AS nt, sum(y) OVER (PARTITION BY feature) AS yt
                FROM (SELECT feature, v, count(*) AS n, sum(y) AS y FROM ({cells}) c GROUP BY 1, 2) f
                WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)) s WHERE nb > 0) g) r WHERE place = 1"""


_TOLD_YIELD = f"told AS (SELECT *, yield_hg_ha AS target FROM feat WHERE year < {CUTOFF})"
_TOLD_RISK = f"""told AS (SELECT f.*, r.label AS target FROM feat f JOIN risk r ON f.area = r.area AND f.crop = r.crop AND f.year = r.year WHERE f.year < {CUTOFF})"""
_SPLIT_COLUMNS = "feature, round(v, 6) AS split_value, CAST(nb AS BIGINT) AS n_left, CAST(nr AS BIGINT) AS n_right, round(gain / nt_all, {places}) AS gain"


def _best(rows: DataFrame, target: str, places: int) -> DataFrame:
    n = rows.count()
    told = splits.best_splits(rows, _LONG_NAMES, target).withColumn("gain", F.col("gain") / n)
    return rounded(rounded(told, 6, "split_value"), places, "gain")


def _labelled_features(t: Tables) -> DataFrame:
    return risk.label_risk(t.features[0], risk.risk_thresholds(t.split[0]))


for _name, _told, _of, _target, _places in (
    ("m7_best_splits", _TOLD_YIELD, lambda t: t.features[0], Y, 2),
    ("m15_best_splits", _TOLD_RISK, _labelled_features, "label", 8),
):
    _columns = _SPLIT_COLUMNS.format(places=_places).replace("nt_all", "(SELECT count(*) FROM told)")

    @bound(_name, on_curated(_splits_sql("target", _columns), TRAIN_CTES + ", " + _told))
    def exact(t: Tables, of=_of, target=_target, places=_places) -> DataFrame:
        return _best(of(t), target, places)


_ROOT = "SELECT n_left, n_right FROM (SELECT *, row_number() OVER (ORDER BY gain DESC, feature) AS first FROM ({best}) b) a WHERE first = 1"


def _root(model, rows: DataFrame) -> DataFrame:
    """Rows on both sides of the first split of a fitted tree."""
    top = search.nodes_of(model).iloc[0]
    goes_left = F.col(f"`{_LONG_NAMES[int(top['feature'])]}`").cast("double") <= float(top["threshold"])
    return rows.agg(F.count_if(goes_left).alias("n_left"), F.count_if(~goes_left).alias("n_right"))


def _bins(rows: DataFrame) -> int:
    """Enough for every value of every feature to be a bin of its own."""
    return max(rows.agg(*[F.count_distinct(n).alias(n) for n in _LONG_NAMES]).first()) + 1


@bound("m7_root_is_the_best_split", on_curated(_ROOT.format(best=_splits_sql("target", "feature, gain, CAST(nb AS BIGINT) AS n_left, CAST(nr AS BIGINT) AS n_right")), TRAIN_CTES + ", " + _TOLD_YIELD))
def m7_root(t: Tables) -> DataFrame:
    rows = t.features[0]
    return _root(regression.tree(rows, _LONG_NAMES, 1, _bins(rows)), rows)


@bound("m15_root_is_the_best_split", on_curated(_ROOT.format(best=_splits_sql("target", "feature, gain, CAST(nb AS BIGINT) AS n_left, CAST(nr AS BIGINT) AS n_right")), TRAIN_CTES + ", " + _TOLD_RISK))
def m15_root(t: Tables) -> DataFrame:
    # At its full depth: MLlib drops a split of a shallow tree if both sides predict alike.
    rows = _labelled_features(t)
    return _root(risk.tree(rows, _LONG_NAMES, bins=_bins(rows)), rows)


@bound("m14_m15_risk_models")
def m14(t: Tables) -> DataFrame:
    thresholds = risk.risk_thresholds(t.split[0])
    train, test = (risk.label_risk(rows, thresholds) for rows in t.features)
    names = t.stats.names
    models = {
        "logistic": risk.logistic(train, names), "logistic_balanced": risk.logistic(train, names, balanced=True),
        "tree": risk.tree(train, names), "forest": risk.forest(train, names),
    }
    told = [risk.summary_row("majority", risk.majority_class(train, test), with_auc=False)]
    told += [risk.summary_row(name, risk.score(model, test)) for name, model in models.items()]
    return reduce(DataFrame.unionByName, told)


@bound("s14_risk_bundle", on_curated(f"""
    SELECT area, crop, year, label, true AS same_risk FROM risk WHERE year >= {CUTOFF}""", TRAIN_CTES))
def s14(t: Tables) -> DataFrame:
    """The balanced classifier with its scaler, statistics and thresholds, saved, loaded and applied to new rows."""
    thresholds = risk.risk_thresholds(t.split[0])
    train = risk.label_risk(t.features[0], thresholds)
    model = risk.logistic(train, t.stats.names, balanced=True)
    path = scratch_path(t.spark, "risk-model")
    bundle.save(bundle.Bundle("risk", model, t.stats, thresholds), t.spark, path)
    again = bundle.load(t.spark, path, "risk")
    before = risk.score(model, t.features[1]).select("area", "crop", "year", F.col("risk").alias("first"))
    rows = t.settled.where(F.col("year") >= CUTOFF)
    after = risk.score(again.model, risk.label_risk(again.stats.transform(rows, t.settled), again.thresholds))
    return after.join(before, ["area", "crop", "year"]).select("area", "crop", "year", "label", (F.abs(F.col("risk") - F.col("first")) < 1e-9).alias("same_risk"))


# With one feature the fits have a closed form that SQL can follow.

_ONE = f"""one AS (SELECT regr_slope(yield_hg_ha, lag1_yield) AS slope, regr_intercept(yield_hg_ha, lag1_yield) AS intercept,
    covar_pop(yield_hg_ha, lag1_yield) * count(*) / (var_pop(lag1_yield) * count(*) + 1e10) AS shrunk FROM feat WHERE year < {CUTOFF})"""


@bound("m5_one_feature_regression", on_curated("SELECT round(slope, 6) AS slope, round(intercept, 1) AS intercept, round(shrunk, 6) AS shrunk FROM one", TRAIN_CTES + ", " + _ONE))
def m5(t: Tables) -> DataFrame:
    """The lines are read off what the fitted models predict for the training rows."""
    train, _ = t.features
    line, flat = regression.linear(train, ["lag1_yield"]), regression.ridge(train, ["lag1_yield"], alpha=1e10)
    told = _both_predictions(line, flat, train).agg(
        F.regr_slope("linear", "lag1_yield").alias("slope"),
        F.regr_intercept("linear", "lag1_yield").alias("intercept"),
        F.regr_slope("ridge", "lag1_yield").alias("shrunk"),
    )
    return rounded(rounded(told, 6, "slope", "shrunk"), 1, "intercept")


# ---- explanations and scenarios -----------------------------------------------------------

@bound("v1_v2_v3_importances")
def v3(t: Tables) -> DataFrame:
    model = regression.fitted(_forest(t))
    return explain.compare_importances(
        explain.impurity_importance(t.spark, model, t.stats.names),
        explain.permutation_importance(model, t.features[1], t.stats.names),
    )


@bound("v4_linear_contributions", on_curated(f"SELECT count(*) AS n, true AS adds_up FROM curated WHERE year >= {CUTOFF}"))
def v4_linear(t: Tables) -> DataFrame:
    train, test = t.features
    model = regression.linear(train, t.stats.names)
    told = explain.linear_contributions(regression.fitted(model), test, train, t.stats.names)
    scored = model.transform(test).select("area", "crop", "year", F.col("prediction").alias("model_prediction"))
    both = told.join(scored, ["area", "crop", "year"])
    gap = F.abs(F.col("model_prediction") - F.col("prediction")) / F.greatest(F.abs("model_prediction"), F.lit(1.0))
    return both.agg(F.count(F.lit(1)).alias("n"), (F.max(gap) < 1e-6).alias("adds_up"))


@bound("v4_sampled_contributions")
def v4_sampled(t: Tables) -> DataFrame:
    train, test = t.features
    told = explain.sampled_contributions(regression.fitted(_forest(t)), test, train, t.stats.names)
    return explain.top_contributions(told, t.stats.names)


def _adds_up(told: DataFrame) -> DataFrame:
    total = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda s, v: s + v) + F.col("sampling_error")
    gap = F.abs(total - F.col("prediction")) / F.greatest(F.abs("prediction"), F.lit(1.0))
    return told.agg(F.count(F.lit(1)).alias("n"), (F.max(gap) < 1e-6).alias("adds_up"))


@bound("v4_sampled_adds_up", on_curated(f"SELECT count(*) AS n, true AS adds_up FROM curated WHERE year >= {CUTOFF}"))
def v4_sampled_sum(t: Tables) -> DataFrame:
    train, test = t.features
    return _adds_up(explain.sampled_contributions(regression.fitted(_forest(t)), test, train, t.stats.names))


@bound("v4_repeated_keys", on_curated(f"SELECT 2 * count(*) AS n, true AS adds_up FROM curated WHERE year >= {CUTOFF}"))
def v4_repeated(t: Tables) -> DataFrame:
    """Every row twice: each is explained on its own."""
    train, test = t.features
    model = regression.fitted(regression.linear(train, t.stats.names))
    return _adds_up(explain.sampled_contributions(model, test.union(test), train, t.stats.names))


@bound("v1_v2_every_feature_is_weighed", on_curated("SELECT 12 + count(DISTINCT crop) AS n_features, true AS impurity_sums_to_one, true AS all_permuted FROM train", TRAIN_CTES))
def v1_shape(t: Tables) -> DataFrame:
    model = regression.fitted(_forest(t))
    both = explain.compare_importances(
        explain.impurity_importance(t.spark, model, t.stats.names), explain.permutation_importance(model, t.features[1], t.stats.names)
    )
    return both.agg(
        F.count(F.lit(1)).alias("n_features"),
        (F.abs(F.sum("impurity_importance") - 1) < 1e-6).alias("impurity_sums_to_one"),
        F.every(F.col("permutation_importance").isNotNull()).alias("all_permuted"),
    )


@bound("t7_top_feature_agreement")
def t7(t: Tables) -> DataFrame:
    model = regression.fitted(_forest(t))
    impurity = explain.impurity_importance(t.spark, model, t.stats.names)
    return explain.top_feature_agreement(impurity.join(explain.permutation_importance(model, t.features[1], t.stats.names), "feature"))


@bound("t7_arg_max_area", on_curated("""
    SELECT crop, area AS best_area, CAST(mean AS DOUBLE) AS best_mean FROM (
        SELECT crop, area, round(avg(yield_hg_ha), 4) AS mean, row_number() OVER (PARTITION BY crop ORDER BY round(avg(yield_hg_ha), 4) DESC, area DESC) AS place
        FROM curated GROUP BY 1, 2) r WHERE place = 1"""))
def t7_area(t: Tables) -> DataFrame:
    means = t.settled.groupBy("crop", "area").agg(F.round(F.avg(Y), 4).alias("mean"))
    return means.groupBy("crop").agg(F.max_by("area", F.struct("mean", "area")).alias("best_area"), F.max("mean").alias("best_mean"))


@bound("t5_low_and_high_examples", on_curated(f"""
    SELECT area, crop, year, yield_hg_ha, CASE WHEN position = n // 10 THEN 'low' ELSE 'high' END AS example FROM (
        SELECT *, row_number() OVER (ORDER BY yield_hg_ha, area, crop, year) - 1 AS position, count(*) OVER () AS n FROM curated WHERE year >= {CUTOFF}) o
    WHERE position IN (n // 10, n - n // 10)"""))
def t5(t: Tables) -> DataFrame:
    return explain.low_and_high_examples(t.split[1]).select("area", "crop", "year", Y, "example")


def _engine(t: Tables) -> WhatIf:
    return WhatIf(_forest(t), t.stats, t.settled)


def _requests(t: Tables) -> DataFrame:
    """One request per recorded row of the test years: wetter, and more sprayed."""
    keys = F.concat_ws("/", "area", "crop", "year").alias("request_id")
    return t.split[1].select(
        keys, "area", "crop", "year", (F.col("rainfall_mm") * 1.15).alias("rainfall_mm"),
        F.lit(None).cast("double").alias("avg_temp_c"), (F.col("pesticides_tonnes") * 1.25).alias("pesticides_tonnes"),
    )


def _straight_engine(t: Tables) -> WhatIf:
    """A regression on rainfall alone, which SQL can follow through a scenario."""
    return WhatIf(regression.linear(t.features[0], ["rainfall_mm"]), t.stats, t.settled)


_RAIN = f"""rain AS (SELECT regr_slope(yield_hg_ha, rainfall_mm) AS s, regr_intercept(yield_hg_ha, rainfall_mm) AS c FROM feat WHERE year < {CUTOFF}),
asked AS (SELECT area, crop, year, rainfall_mm, s, c, coalesce(rainfall_mm, (SELECT r FROM med)) AS known, coalesce(rainfall_mm * 1.15, (SELECT r FROM med)) AS wetter
    FROM curated, rain WHERE year >= {CUTOFF})"""


@bound("v5_scenarios_on_rainfall", on_curated("""
    SELECT area, crop, year, round(c + s * known, 1) AS baseline_prediction_hg_ha, round(c + s * wetter, 1) AS scenario_prediction_hg_ha,
           round(s * (wetter - known), 1) AS absolute_change_hg_ha, round(100.0 * s * (wetter - known) / (c + s * known), 4) AS percent_change FROM asked""", TRAIN_CTES + ", " + _RAIN))
def v5_straight(t: Tables) -> DataFrame:
    told = _straight_engine(t).scenarios(_requests(t))[0].drop("request_id")
    return rounded(rounded(told, 1, "baseline_prediction_hg_ha", "scenario_prediction_hg_ha", "absolute_change_hg_ha"), 4, "percent_change")


@bound("v6_curves_on_rainfall", on_curated("""
    SELECT area, crop, year, CAST(round(0.5 + 0.1 * i, 1) AS DOUBLE) AS multiplier, round(rainfall_mm * (0.5 + 0.1 * i), 4) AS scaled_value,
           round(c + s * rainfall_mm * (0.5 + 0.1 * i), 1) AS predicted_yield_hg_ha
    FROM asked, range(11) g(i) WHERE rainfall_mm IS NOT NULL""", TRAIN_CTES + ", " + _RAIN))
def v6_straight(t: Tables) -> DataFrame:
    curve, _ = _straight_engine(t).sensitivity(_requests(t), "rainfall_mm")
    return rounded(rounded(curve.drop("request_id"), 1, "multiplier", "predicted_yield_hg_ha"), 4, "scaled_value")


@bound("v8_actual_and_predicted_on_rainfall", on_curated("""
    SELECT area, crop, year, yield_hg_ha, round(c + s * known, 1) AS prediction, round(c + s * known - yield_hg_ha, 1) AS error
    FROM asked JOIN (SELECT area AS a, crop AS k, year AS y, yield_hg_ha FROM curated) f ON a = area AND k = crop AND y = year""", TRAIN_CTES + ", " + _RAIN))
def v8_straight(t: Tables) -> DataFrame:
    return rounded(actual_and_predicted(_straight_engine(t).model.transform(t.features[1])), 1, "prediction", "error")


@bound("v5_scenarios")
def v5(t: Tables) -> DataFrame:
    return _engine(t).scenarios(_requests(t))[0]


@bound("v5_refused_requests", on_curated(f"SELECT area, crop, year - 1000 AS year, 'no record' AS problem FROM curated WHERE year >= {CUTOFF}"))
def v5_refused(t: Tables) -> DataFrame:
    lost = _requests(t).withColumns({"year": F.col("year") - 1000, "request_id": F.concat("request_id", F.lit("-x"))})
    return _straight_engine(t).scenarios(_requests(t).unionByName(lost))[1].select("area", "crop", "year", "problem")


@bound("v5_one_row_per_request", on_curated(f"SELECT count(*) AS n, count(*) AS n_requests, true AS both_predicted FROM curated WHERE year >= {CUTOFF}"))
def v5_rows(t: Tables) -> DataFrame:
    told = _engine(t).scenarios(_requests(t))[0]
    both = F.col("baseline_prediction_hg_ha").isNotNull() & F.col("scenario_prediction_hg_ha").isNotNull()
    return told.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("request_id").alias("n_requests"), F.every(both).alias("both_predicted"))


@bound("v6_sensitivity_curves")
def v6(t: Tables) -> DataFrame:
    return _engine(t).sensitivity(_requests(t), "rainfall_mm")[0]


@bound("v6_refused_requests", on_curated(f"""
    SELECT area, crop, year, 'rainfall_mm is missing' AS problem FROM curated WHERE year >= {CUTOFF} AND rainfall_mm IS NULL
    UNION ALL SELECT area, crop, year - 1000, 'no record' FROM curated WHERE year >= {CUTOFF} AND crop = 'Maize'"""))
def v6_refused(t: Tables) -> DataFrame:
    unknown = _requests(t).where("crop = 'Maize'").withColumns({"year": F.col("year") - 1000, "request_id": F.concat("request_id", F.lit("-x"))})
    refused = WhatIf(None, t.stats, t.settled)
    wanted = _requests(t).unionByName(unknown)
    based, missing = refused.base_rows(wanted.select("request_id", "area", "crop", "year"))
    empty = based.where("base_rainfall_mm is null").select("area", "crop", "year", F.lit("rainfall_mm is missing").alias("problem"))
    return empty.unionByName(missing.select("area", "crop", "year", F.lit("no record").alias("problem")))


@bound("v7_spread_of_curves", on_curated("""
    SELECT area, crop, year, round(abs(s * rainfall_mm), 1) AS spread, round(c + s * rainfall_mm, 1) AS baseline,
           round(100.0 * abs(s * rainfall_mm) / (c + s * rainfall_mm), 4) AS spread_pct
    FROM asked WHERE rainfall_mm IS NOT NULL""", TRAIN_CTES + ", " + _RAIN))
def v7(t: Tables) -> DataFrame:
    curve, _ = _straight_engine(t).sensitivity(_requests(t), "rainfall_mm")
    return rounded(rounded(curve_spread(curve).drop("request_id"), 1, "spread", "baseline"), 4, "spread_pct")


@bound("v7_spread_of_forest_curves", on_curated(f"SELECT count(*) AS n, true AS never_negative, true AS all_based FROM curated WHERE year >= {CUTOFF} AND rainfall_mm IS NOT NULL"))
def v7_forest(t: Tables) -> DataFrame:
    curve, _ = _engine(t).sensitivity(_requests(t), "rainfall_mm")
    return curve_spread(curve).agg(
        F.count(F.lit(1)).alias("n"), F.every(F.col("spread") >= 0).alias("never_negative"), F.every(F.col("baseline").isNotNull()).alias("all_based")
    )


@bound("v8_actual_and_predicted")
def v8(t: Tables) -> DataFrame:
    return actual_and_predicted(scoring.scored(_forest(t), t.features[1]))
