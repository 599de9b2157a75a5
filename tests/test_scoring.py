"""Rows that are scored in blocks, and what is sent to the driver while they are made."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.models import explain, regression, scoring, search
from furrow.models.scenarios import WhatIf

NAMES = ["year", "wet", "a, b"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(11)
    told = [(f"a{i % 7}", f"c{i % 3}", 1990 + i % 6, float(w), int(draw.integers(2)), int(9000 + 1000 * w * w + 50 * draw.normal())) for i, w in enumerate(draw.normal(size=500).round(2))]
    return spark.createDataFrame(told, "area string, crop string, year int, wet double, `a, b` int, yield_hg_ha long")


@pytest.fixture(scope="module")
def model(rows):
    return regression.forest(rows, NAMES, 7, 9)


def test_blocks_are_told_what_mllib_tells(rows, model, monkeypatch):
    monkeypatch.setattr(scoring, "ROWS", 64)
    want = {(r["area"], r["crop"], r["year"], r["wet"], r["a, b"]): r["prediction"] for r in model.transform(rows).collect()}
    found = scoring.scored(model, rows)
    assert "told(" in found._jdf.queryExecution().executedPlan().toString()
    for r in found.collect():
        assert r["prediction"] == want[(r["area"], r["crop"], r["year"], r["wet"], r["a, b"])]


def test_a_value_on_a_threshold_goes_left(spark, rows, model):
    forest = regression.fitted(model)
    edges = search.nodes_of(model).query("feature == 1")["threshold"].drop_duplicates().tolist()
    asked = spark.createDataFrame([(1992, e + d, 1) for e in edges for d in (0.0, 1e-9)], "year int, wet double, `a, b` int")
    told = scoring.predicted(forest, asked, [F.col(f"`{n}`") for n in NAMES]).select("wet", "prediction").collect()
    want = {r["wet"]: r["prediction"] for r in model.transform(asked).collect()}
    assert {r["wet"]: r["prediction"] for r in told} == want


def test_forest_of_roots_alone(spark, rows):
    flat = regression.forest(rows.withColumn("yield_hg_ha", F.lit(5)), NAMES, 3, 4)
    assert {r["prediction"] for r in scoring.scored(flat, rows).collect()} == {5.0}


def test_large_forests_and_other_models_are_scored_by_mllib(rows, model, monkeypatch):
    line = regression.linear(rows, NAMES)
    assert scoring.scored(line, rows).agg(F.sum("prediction")).first()[0] == pytest.approx(line.transform(rows).agg(F.sum("prediction")).first()[0])
    monkeypatch.setattr(scoring, "NODES", 1)
    found = scoring.scored(model, rows)
    assert "told(" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.agg(F.sum("prediction")).first()[0] == pytest.approx(model.transform(rows).agg(F.sum("prediction")).first()[0])


def test_walks_are_not_sent_to_the_driver(rows, model):
    """Sixteen walks a row used to be broadcast, as the planner counts them as one."""
    told = explain.sampled_contributions(regression.fitted(model), rows, rows, NAMES)
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.split("\n") if "BroadcastHashJoin" in line and ("_pick" in line or "_row" in line)]
    assert told.count() == 500


def test_donors_are_not_sent_to_the_driver(rows, model):
    told = explain.permutation_importance(regression.fitted(model), rows, NAMES)
    assert not [line for line in told._jdf.queryExecution().executedPlan().toString().split("\n") if "BroadcastHashJoin" in line and "_donor" in line]


def test_scenarios_are_scored_in_blocks(rows, model):
    class Stats:
        def transform(self, asked, history, keep):
            return asked.select(*[c for c in keep if c != "year"], *[F.col(f"`{n}`") for n in NAMES])

    told = WhatIf(model, Stats(), rows).predict(rows, ["area", "crop", "year"])
    assert told.columns == ["area", "crop", "year", "prediction"] and "told(" in told._jdf.queryExecution().executedPlan().toString()
