"""MLlib fits, their explanations and what-if batches on generated series."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from furrow.models import bundle, clustering, explain, regression, risk, search, splits
from furrow.models.baseline import HistoricalMean
from furrow.models.scenarios import MULTIPLIERS, WhatIf, curve_spread
from furrow.operators.evaluation import regression_metrics, temporal_split
from furrow.operators.features import FeatureStats

SHAPE = "area string, crop string, year int, yield_hg_ha long, rainfall_mm double, avg_temp_c double, pesticides_tonnes double"


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(11)
    rows = []
    for area in "abcdef":
        for crop, scale in (("Maize", 4.0), ("Wheat", 2.0)):
            level = 8000 * scale + 3000 * rng.normal()
            for year in range(1988, 2004):
                level += 150 * scale + 200 * rng.normal()
                rain = None if year % 7 == 0 else float(round(600 + 150 * rng.normal(), 1))
                wet = 0 if rain is None else 8 * (rain - 600)
                rows.append((area, crop, year, int(level + wet), rain, float(round(15 + rng.normal(), 2)), float(round(abs(20 * rng.normal()), 2))))
    curated = spark.createDataFrame(rows, SHAPE).repartition(3, "area").cache()
    train, test = temporal_split(curated, 1999)
    stats = FeatureStats.fit(train)
    features = stats.transform(curated, curated).cache()
    return curated, stats, *temporal_split(features, 1999)


@pytest.fixture(scope="module")
def forest(world):
    return regression.forest(world[2], world[1].names, trees=10, depth=5)


def r2(scored):
    return regression_metrics(scored).first()["r2"]


def test_linear_solves_least_squares(world):
    _, stats, train, test = world
    model = regression.linear(train, stats.names)
    pdf = train.toPandas()
    design = np.column_stack([pdf[stats.names].to_numpy(float), np.ones(len(pdf))])
    fit = design @ np.linalg.lstsq(design, pdf["yield_hg_ha"].to_numpy(float), rcond=None)[0]
    got = model.transform(train).select("area", "crop", "year", "prediction").toPandas()
    merged = pdf.assign(want=fit).merge(got, on=["area", "crop", "year"])
    np.testing.assert_allclose(merged["prediction"], merged["want"], rtol=1e-4)


def test_ridge_matches_its_closed_form(world):
    _, _, train, _ = world
    names = ["lag1_yield", "region_mean_yield", "rainfall_mm", "avg_temp_c"]
    pdf = train.toPandas()
    x, y = pdf[names].to_numpy(float), pdf["yield_hg_ha"].to_numpy(float)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 5e6 * np.eye(4), xc.T @ yc)
    got = regression.fitted(regression.ridge(train, names, alpha=5e6)).coefficients.toArray()
    np.testing.assert_allclose(got, want, rtol=2e-3, atol=1e-3)
    assert regression.coefficient_norm(regression.ridge(train, names, 5e6)) < regression.coefficient_norm(regression.linear(train, names))


def test_models_beat_the_baseline(world, forest):
    curated, stats, train, test = world
    raw_train, raw_test = temporal_split(curated, 1999)
    base = r2(HistoricalMean.fit(raw_train).predict(raw_test))
    assert r2(regression.linear(train, stats.names).transform(test)) > base
    assert r2(forest.transform(test)) > base
    told = {(r["model"], r["split"]): r for r in regression.train_and_test("forest", forest, train, test).collect()}
    assert told[("forest", "train")]["r2"] > told[("forest", "test")]["r2"]


def test_unconstrained_tree_overfits_more(world):
    _, stats, train, test = world
    fits = {depth: regression.tree(train, stats.names, depth) for depth in (3, regression.DEEPEST)}
    on_train = {depth: r2(model.transform(train)) for depth, model in fits.items()}
    assert on_train[regression.DEEPEST] > 0.999 > on_train[3]
    assert r2(fits[regression.DEEPEST].transform(test)) < on_train[regression.DEEPEST]


def test_folds_never_look_ahead(world):
    _, stats, train, _ = world
    folds = search.year_folds(train, 3)
    assert len(folds) == 3
    for fit, check in folds:
        assert fit.agg(F.max("year")).first()[0] < check.agg(F.min("year")).first()[0]
    assert folds[-1][1].agg(F.max("year")).first()[0] == train.agg(F.max("year")).first()[0]
    model, found = search.tuned_forest(train, stats.names, ((5, 2), (8, 5), (3, 5)), 3)
    assert [f[3] for f in found] == [3, 3, 3] and [f[2] for f in found] == sorted(f[2] for f in found)
    inner = regression.fitted(model)
    assert inner.getNumTrees == found[0][0] and max(t.depth for t in inner.trees) <= found[0][1]


def test_cuts_of_one_forest_are_the_smaller_forests(world):
    """Errors of cuts, against trees walked node by node."""
    _, stats, train, test = world
    model = regression.forest(train, stats.names, trees=6, depth=7)
    grid = ((6, 7), (6, 3), (2, 0), (4, 1))
    got = search.mae_of_cuts(model, test, grid)
    nodes = {t: own.set_index("id") for t, own in search.nodes_of(model).groupby("tree")}

    def walk(x, tree, most):
        own, i = nodes[tree], 0
        for _ in range(most):
            node = own.loc[i]
            if node["leftChild"] < 0:
                break
            i = int(node["leftChild"] if x[int(node["feature"])] <= node["threshold"] else node["rightChild"])
        return own.loc[i]["prediction"]

    pdf = test.toPandas()
    rows = pdf[stats.names].to_numpy(float)
    for (trees, depth), mae in zip(grid, got, strict=True):
        p = [np.mean([walk(x, t, depth) for t in range(trees)]) for x in rows]
        assert abs(np.mean(np.abs(pdf["yield_hg_ha"] - p)) - mae) < 1e-6
    whole = model.transform(test).agg(F.avg(F.abs(F.col("prediction") - F.col("yield_hg_ha")))).first()[0]
    assert abs(got[0] - whole) < 1e-6


def test_exact_splits_and_the_root_of_a_tree(world):
    _, stats, train, _ = world
    names = ["year", "rainfall_mm", "avg_temp_c", "lag1_yield", "region_mean_yield"]
    pdf = train.toPandas()
    want = {}
    for name in names:
        x, y = pdf[name].to_numpy(float), pdf["yield_hg_ha"].to_numpy(float)
        cuts = [(((y - y.mean()) ** 2).sum() - sum(((s - s.mean()) ** 2).sum() for s in (y[x < v], y[x >= v])), v) for v in np.unique(x)[1:]]
        want[name] = max(cuts, key=lambda c: (round(c[0], 3), -c[1]))
    got = {r["feature"]: r for r in splits.best_splits(train, names).collect()}
    for name in names:
        assert got[name]["split_value"] == want[name][1] and abs(got[name]["gain"] - want[name][0]) < 1e-3 * want[name][0]
    assert splits.best_splits(train.withColumn("flat", F.lit(1)), ["flat"]).count() == 0
    root = search.nodes_of(regression.tree(train, names, 1, 400)).iloc[0]
    best = max(names, key=lambda n: got[n]["gain"])
    assert names[int(root["feature"])] == best and train.where(F.col(best) <= float(root["threshold"])).count() == got[best]["n_left"]


def test_saved_model_predicts_the_same(world, forest, spark, tmp_path):
    _, stats, train, test = world
    folder = str(tmp_path)
    bundle.save(bundle.Bundle("yield", forest, stats), spark, folder)
    again = bundle.load(spark, folder, "yield")
    assert again.stats.names == stats.names and again.thresholds is None
    want = [r["prediction"] for r in forest.transform(test).orderBy("area", "crop", "year").collect()]
    got = [r["prediction"] for r in again.model.transform(test).orderBy("area", "crop", "year").collect()]
    assert got == want and min(got) > 0
    with pytest.raises(ValueError, match="not a risk one"):
        bundle.load(spark, folder, "risk")
    card = regression.model_card(forest, stats, train, forest.transform(test)).first()
    assert card["training_year_range"] == [1988, 1998] and card["training_rows"] == train.count()
    assert card["feature_columns"] == stats.names and card["algorithm"] == "RandomForestRegressionModel"


def newton_logistic(x, y, weight, c=1.0):
    design = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([1.0 / c] * x.shape[1] + [0.0])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (weight * (p - y)) + penalty @ beta
        beta -= np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + penalty, gradient)
    return beta


@pytest.mark.parametrize("balanced", [False, True])
def test_logistic_matches_newton(world, balanced):
    curated, stats, train, test = world
    thresholds = risk.risk_thresholds(temporal_split(curated, 1999)[0])
    rows = risk.label_risk(train, thresholds)
    names = ["year", "rainfall_mm", "lag1_yield", "yield_trend_ratio"]
    model = risk.logistic(rows, names, balanced)
    pdf = rows.toPandas()
    x, y = pdf[names].to_numpy(float), pdf["label"].to_numpy(float)
    x = (x - x.mean(0)) / x.std(0, ddof=1)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum())) if balanced else np.ones(len(y))
    fitted = model.stages[-1]
    np.testing.assert_allclose([*fitted.coefficients.toArray(), fitted.intercept], newton_logistic(x, y, weight), rtol=2e-2, atol=2e-2)
    row = risk.summary_row("logistic", risk.score(model, rows)).first()
    assert 0.5 < row["roc_auc"] <= 1.0


def test_tree_classifiers_and_majority(world):
    curated, stats, train, test = world
    thresholds = risk.risk_thresholds(temporal_split(curated, 1999)[0])
    rows, check = risk.label_risk(train, thresholds), risk.label_risk(test, thresholds)
    for model in (risk.tree(rows, stats.names, 4), risk.forest(rows, stats.names, 10, 4)):
        assert risk.summary_row("m", risk.score(model, rows)).first()["accuracy"] > 0.75
    dull = risk.summary_row("majority", risk.majority_class(rows, check), with_auc=False).first()
    assert dull["recall"] == 0.0 and dull["roc_auc"] is None


def test_clusters(world):
    curated = world[0]
    conditions = clustering.conditions_table(curated)
    assert conditions.count() == curated.dropna().select("area", "year").distinct().count()
    _, scaled = clustering.scale_conditions(conditions)
    found = clustering.search_k(scaled.cache(), range(2, 5), restarts=3).collect()
    assert [r["k"] for r in found] == [2, 3, 4]
    assert found[0]["inertia"] > found[1]["inertia"] > found[2]["inertia"]
    model = clustering.fit_clusters(scaled, 4, 3)
    profile = clustering.profile_clusters(model.transform(scaled), curated).collect()
    assert len(profile) == 4 and sum(r["n_region_years"] for r in profile) == conditions.count()


def test_linear_contributions_add_up(world):
    _, stats, train, test = world
    model = regression.linear(train, stats.names)
    told = explain.linear_contributions(regression.fitted(model), test, train, stats.names)
    scored = model.transform(test).select("area", "crop", "year", F.col("prediction").alias("p"))
    for r in told.join(scored, ["area", "crop", "year"]).collect():
        assert r["base"] + sum(r["contributions"]) == pytest.approx(r["p"], rel=1e-6)


def test_sampled_contributions_add_up(world, forest):
    _, stats, train, test = world
    told = explain.sampled_contributions(regression.fitted(forest), test, train, stats.names, draws=6)
    scored = forest.transform(test).select("area", "crop", "year", F.col("prediction").alias("p"))
    rows = told.join(scored, ["area", "crop", "year"]).collect()
    assert len(rows) == test.count()
    for r in rows:
        assert r["prediction"] == pytest.approx(r["p"])
        assert r["base"] + sum(r["contributions"]) + r["sampling_error"] == pytest.approx(r["p"])
    mean = forest.transform(train).agg(F.avg("prediction")).first()[0]
    assert {round(r["base"], 6) for r in rows} == {round(mean, 6)}
    twice = explain.sampled_contributions(regression.fitted(forest), test.union(test), train, stats.names, draws=2)
    assert twice.count() == 2 * test.count()
    assert twice.where("abs(base + aggregate(contributions, 0D, (s, v) -> s + v) + sampling_error - prediction) > 1e-3").count() == 0
    top = explain.top_contributions(told, stats.names, 3).where("area = 'a' and crop = 'Maize' and year = 2000").orderBy("place").collect()
    assert [r["place"] for r in top] == [1, 2, 3]
    assert abs(top[0]["contribution"]) >= abs(top[1]["contribution"]) >= abs(top[2]["contribution"])


def test_sampled_contributions_equal_the_linear_ones(world):
    """For a linear model every order gives the same credit."""
    _, stats, train, test = world
    names = ["lag1_yield", "rainfall_mm", "avg_temp_c"]
    model = regression.fitted(regression.linear(train, names))
    # A single training row is every row's draw, whatever the number of draws.
    chosen = train.orderBy("area", "crop", "year").limit(1)
    told = explain.sampled_contributions(model, test, chosen, names, draws=3)
    exact = explain.linear_contributions(model, test, chosen, names)
    both = told.join(exact.select("area", "crop", "year", F.col("contributions").alias("want")), ["area", "crop", "year"])
    for r in both.collect():
        assert r["contributions"] == pytest.approx(r["want"], rel=1e-6, abs=1e-6)


def test_importances(world, forest, spark):
    _, stats, train, test = world
    model = regression.fitted(forest)
    impurity = explain.impurity_importance(spark, model, stats.names)
    assert impurity.agg(F.sum("impurity_importance")).first()[0] == pytest.approx(1.0)
    permuted = explain.permutation_importance(model, test, stats.names, repeats=3)
    both = explain.compare_importances(impurity, permuted).collect()
    assert len(both) == len(stats.names)
    by_name = {r["feature"]: r for r in both}
    assert by_name["is_post_1990"]["permutation_importance"] == 0.0
    assert both[0]["feature"] in ("lag1_yield", "region_mean_yield", "crop_Maize")
    assert explain.top_feature_agreement(spark.createDataFrame(both)).first()["top_permutation"] == both[0]["feature"]


class Counting:
    """Stands for a model: predicts the number of the task, and counts what it scores."""

    def __init__(self, spark):
        self.scored = spark.sparkContext.accumulator(0)

    def transform(self, rows):
        counted = self.scored

        @F.udf("int")
        def count(_):
            counted.add(1)
            return 0

        return rows.withColumn("prediction", (F.spark_partition_id() + count.asNondeterministic()(F.lit(0))).cast("double"))


def test_a_small_table_is_explained_by_several_tasks(spark):
    """Each row of some bytes is scored hundreds of times: not all of them by one task."""
    rows = spark.range(40).selectExpr("string(id) AS area", "'m' AS crop", "2000 AS year", "id AS yield_hg_ha", "double(id) AS a", "double(id % 2) AS b", "1D AS c")
    told = explain.sampled_contributions(Counting(spark), rows, rows, ["a", "b", "c"], draws=4).collect()
    assert len(told) == 40 and len({r["prediction"] for r in told}) > 1
    # Drops in R2 differ as the tasks do, whatever is shuffled.
    assert explain.permutation_importance(Counting(spark), rows, ["a", "b", "c"], repeats=2).count() == 3


def test_switches_between_equal_values_are_not_scored(spark):
    rows = spark.range(10).selectExpr("string(id) AS area", "'m' AS crop", "2000 AS year", "double(id) AS a", "1D AS b", "double('NaN') AS c")
    model = Counting(spark)
    explain.sampled_contributions(model, rows, rows.where("a = 3"), ["a", "b", "c"], draws=4).collect()
    # The base, then the start of each walk and the switch of a; row 3 walks from itself.
    assert model.scored.value == 1 + 10 * 4 + 9 * 4


def test_shuffles_that_change_nothing_are_not_scored(spark):
    rows = spark.range(10).selectExpr("string(id) AS area", "'m' AS crop", "2000 AS year", "id AS yield_hg_ha", "double(id) AS a", "1D AS b", "double('NaN') AS c")
    model = Counting(spark)
    told = {r["feature"]: r for r in explain.permutation_importance(model, rows, ["a", "b", "c"], repeats=4).collect()}
    # The untouched rows, then a of each row and repeat; no row is its own donor.
    assert model.scored.value == 10 + 10 * 4
    assert set(told) == {"a", "b", "c"} and told["b"]["permutation_importance"] == told["c"]["permutation_std"] == 0.0


def test_permutation_importance_is_the_drop_in_r2(spark):
    """Against the definition, over the pairs that the hashed order and the drawn steps give."""
    names = ["a", "b"]
    rows = spark.range(12).selectExpr("string(id) AS area", "'m' AS crop", "2000 AS year", "3 * id + id % 3 AS yield_hg_ha", "double(id) AS a", "double(id % 3) AS b")
    model = regression.fitted(regression.linear(rows, names))
    told = {r["feature"]: r["permutation_importance"] for r in explain.permutation_importance(model, rows, names, repeats=3).collect()}
    by_hash = rows.select("yield_hg_ha", *names, F.xxhash64(F.lit(42), "area", "crop", "year").alias("h")).orderBy("h").collect()
    x, y = np.array([[r["a"], r["b"]] for r in by_hash]), np.array([r["yield_hg_ha"] for r in by_hash], dtype=float)
    draw = random.Random(42)
    steps = [1 + int(draw.random() * 11) for _ in range(3)]

    def r2(x):
        return 1 - np.mean((y - x @ model.coefficients.toArray() - model.intercept) ** 2) / np.var(y)

    for f, name in enumerate(names):
        drops = []
        for step in steps:
            mixed = x.copy()
            mixed[:, f] = np.roll(x[:, f], -step)
            drops.append(r2(x) - r2(mixed))
        assert told[name] == pytest.approx(np.mean(drops))


def test_low_and_high_examples(world):
    rows = explain.low_and_high_examples(world[0].where("year = 2000")).collect()
    values = sorted(r["yield_hg_ha"] for r in world[0].where("year = 2000").collect())
    assert {r["example"]: r["yield_hg_ha"] for r in rows} == {"low": values[1], "high": values[-1]}


REQUESTS = "request_id string, area string, crop string, year int, rainfall_mm double, avg_temp_c double, pesticides_tonnes double"


def test_scenarios(world, forest, spark):
    curated, stats, _, test = world
    engine = WhatIf(forest, stats, curated)
    requests = spark.createDataFrame([
        ("same", "a", "Maize", 2000, None, None, None), ("dry", "a", "Maize", 2000, 100.0, None, None), ("none", "zz", "Maize", 2000, 1.0, None, None),
    ], REQUESTS)
    based, unknown = engine.base_rows(requests)
    assert {r["request_id"] for r in based.collect()} == {"same", "dry"} and [r["request_id"] for r in unknown.collect()] == ["none"]
    told, refused = engine.scenarios(requests)
    assert [(r["request_id"], r["problem"]) for r in refused.collect()] == [("none", "no record")]
    got = {r["request_id"]: r for r in told.collect()}
    want = forest.transform(test.where("area = 'a' and crop = 'Maize' and year = 2000")).first()["prediction"]
    assert got["same"]["baseline_prediction_hg_ha"] == pytest.approx(want) and got["same"]["absolute_change_hg_ha"] == 0.0
    dry = got["dry"]
    assert dry["percent_change"] == pytest.approx(100 * dry["absolute_change_hg_ha"] / want)


def test_overrides_reach_the_missing_flag(world, spark):
    curated, stats, train, _ = world
    model = regression.linear(train, ["rainfall_mm_missing", "lag1_yield"])
    engine = WhatIf(model, stats, curated)
    year = next(y for y in range(1990, 2004) if y % 7 == 0)
    got = engine.scenarios(spark.createDataFrame([("r", "b", "Wheat", year, 500.0, None, None)], REQUESTS))[0].first()
    assert got["absolute_change_hg_ha"] == pytest.approx(-float(regression.fitted(model).coefficients[0]))


def test_sensitivity(world, forest, spark):
    curated, stats, _, _ = world
    missing = next(y for y in range(1990, 2004) if y % 7 == 0)
    requests = spark.createDataFrame([("ok", "c", "Maize", 2000, None, None, None), ("null", "c", "Maize", missing, None, None, None), ("none", "c", "Rye", 2000, None, None, None)], REQUESTS)
    curve, refused = WhatIf(forest, stats, curated).sensitivity(requests, "rainfall_mm")
    rows = curve.orderBy("multiplier").collect()
    assert [r["multiplier"] for r in rows] == pytest.approx(list(MULTIPLIERS)) and {r["request_id"] for r in rows} == {"ok"}
    assert {r["request_id"]: r["problem"] for r in refused.collect()} == {"null": "rainfall_mm is missing", "none": "no record"}
    spread = curve_spread(curve).first()
    values = [r["predicted_yield_hg_ha"] for r in rows]
    assert spread["spread"] == pytest.approx(max(values) - min(values)) and spread["baseline"] == pytest.approx(values[5])


def test_risk_bundle_scores_new_rows_alike_and_survives_a_half_written_save(world, spark, tmp_path):
    curated, stats, train, test = world
    raw_train, raw_test = temporal_split(curated, 1999)
    thresholds = risk.risk_thresholds(raw_train)
    model = risk.logistic(risk.label_risk(train, thresholds), stats.names, balanced=True)
    folder = str(tmp_path)
    first = bundle.save(bundle.Bundle("risk", model, stats, thresholds), spark, folder)
    # A later save that died before its version entered the list.
    model.write().save(f"{folder}/half/model")
    assert [r["version"] for r in bundle.versions(spark, folder).collect()] == [first]
    again = bundle.load(spark, folder, "risk")
    assert sorted(map(tuple, again.thresholds.collect())) == sorted(map(tuple, thresholds.collect()))
    keys = ["area", "crop", "year"]
    want = risk.score(model, risk.label_risk(test, thresholds)).select(*keys, "label", "risk").orderBy(*keys).collect()
    rows = again.stats.transform(raw_test, curated)
    got = risk.score(again.model, risk.label_risk(rows, again.thresholds)).select(*keys, "label", "risk").orderBy(*keys).collect()
    assert got == want
    second = bundle.save(bundle.Bundle("yield", regression.linear(train, stats.names), stats), spark, folder)
    assert bundle.versions(spark, folder).first()["version"] == second and bundle.load(spark, folder).kind == "yield"
