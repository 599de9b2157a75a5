"""Global order operators against brute force."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from furrow.operators.evaluation import roc_auc
from furrow.operators.ordered import dense_ids, exact_quantiles, rows_at, running_totals

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def test_quantiles_match_pandas_on_a_skewed_group(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([np.repeat(7.0, 400), rng.normal(50, 20, 500).round(1), rng.exponential(5, 300)])
    groups = np.where(np.arange(len(values)) < 1100, "hot", "cold")
    pdf = pd.DataFrame({"g": groups, "v": values})
    got = {r["g"]: r for r in exact_quantiles(spark.createDataFrame(pdf).repartition(5), "v", PROBS, ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        assert got[g]["n"] == len(part)
        np.testing.assert_allclose(got[g]["quantiles"], part["v"].quantile(PROBS), rtol=1e-12)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=30))
def test_quantiles_of_any_list(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = exact_quantiles(df, "v", PROBS).first()
    np.testing.assert_allclose(got["quantiles"], np.quantile(values, PROBS), rtol=1e-12, atol=1e-12)


def test_running_totals_within_groups(spark):
    rows = [(g, i, (i * 7) % 5) for g in "ab" for i in range(40)]
    got = running_totals(spark.createDataFrame(rows, "g string, i int, v long").repartition(6), ["i"], ["v"], ["g"]).collect()
    assert len(got) == 80
    for r in got:
        earlier = [v for g, i, v in rows if g == r["g"] and i < r["i"]]
        assert r["v_before"] == sum(earlier)
        assert r["v_total"] == sum(v for g, _, v in rows if g == r["g"])


def test_dense_ids_follow_name_order(spark):
    names = ["b", "a", "c", "a", "é", None, "B"]
    got = {r["n"]: r["id"] for r in dense_ids(spark.createDataFrame([(n,) for n in names], "n string"), "n", "id").collect()}
    assert got == {n: i + 1 for i, n in enumerate(sorted({n for n in names if n}))}


def test_rows_at_positions(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("v"))
    got = rows_at(df, ["v"], [F.lit(10), F.col("_one_total") - 10]).collect()
    assert sorted((r["v"], r["position"]) for r in got) == [(10, 10), (90, 90)]


@pytest.mark.parametrize("seed", [0, 1])
def test_auc_matches_pair_counting(spark, seed):
    rng = np.random.default_rng(seed)
    label, score = rng.integers(0, 2, 60), rng.integers(0, 8, 60) / 8
    pairs = [(s > z) + 0.5 * (s == z) for s in score[label == 1] for z in score[label == 0]]
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(label, score)], "label int, s double")
    assert roc_auc(df, "s").first()["roc_auc"] == pytest.approx(np.mean(pairs))
