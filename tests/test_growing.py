"""The forests that the search over sizes grows and scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.models import growing, regression, search

NAMES = ["year", "wet", "flag"]
GRID = ((30, 4), (30, 30), (10, 2), (30, 0))


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(7)
    wet = draw.normal(size=600).round(3)
    told = [(1990 + i % 6, float(w), int(draw.integers(2)), int(1000 * w * w + 200 * draw.normal())) for i, w in enumerate(wet)]
    return spark.createDataFrame(told, "year int, wet double, flag int, yield_hg_ha long")


def test_search_holds_no_forest_of_a_fold(rows, monkeypatch):
    """Each fold used to be fitted as one MLlib model, whose passes and nodes grow with the leaves."""
    monkeypatch.setattr(regression, "forest", None)
    found = search.search_forest(rows, NAMES, GRID, 3).collect()
    assert {(r["trees"], r["depth"], r["n_folds"]) for r in found} == {(t, d, 3) for t, d in GRID}
    assert [r["mean_mae"] for r in found] == sorted(r["mean_mae"] for r in found)


def test_errors_are_those_of_mllib_forests(rows):
    train, check = rows.where("year < 1994"), rows.where("year >= 1994")
    got = growing.fold_errors(rows, NAMES, [(1994, 1996)], GRID)[0]
    want = search.mae_of_cuts(regression.forest(train, NAMES, 30, 30), check, GRID)
    assert got == pytest.approx(want, rel=0.06)


def test_large_nodes_are_split_over_all_partitions(rows):
    """Whatever part of a tree is grown by sums over the partitions, only ties that rounding breaks differ."""
    cuts = [(1993, 1994), (1994, 1996)]
    whole = growing.fold_errors(rows, NAMES, cuts, GRID)
    for limit in (100, 5):
        parts = growing.fold_errors(rows, NAMES, cuts, GRID, node_rows=limit)
        assert np.array(parts) == pytest.approx(np.array(whole), rel=0.01)


def test_rows_alike_in_everything_are_one_leaf(rows):
    same = rows.select("year", F.lit(1.5).alias("wet"), F.lit(1).alias("flag"), F.lit(7).alias("yield_hg_ha"))
    assert np.array(growing.fold_errors(same, ["wet", "flag"], [(1994, 1996)], GRID, node_rows=50)) == pytest.approx(0.0)


def test_a_tree_grown_to_the_end_tells_its_own_rows():
    draw = np.random.default_rng(3)
    b = np.stack([np.arange(200), draw.integers(3, size=200)], axis=1)
    y = draw.normal(size=200)
    told = growing.grow(b, np.ones(200), y, b, [200, 3], 0, [0, 30])
    assert told[:, 0] == pytest.approx(y.mean()) and told[:, 1] == pytest.approx(y)


def test_folds_are_told_their_candidates_together(rows, spark):
    """Each fold used to be told its own by passes of its own."""
    cuts = [(1992, 1993), (1994, 1996)]
    group = "folds told together"
    spark.sparkContext.setJobGroup(group, group)
    told = growing.candidates(rows, NAMES, cuts, 32)
    many = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup(group + ", one", group)
    for place, cut in enumerate(cuts):
        learned = [r for r in rows.collect() if r["year"] < cut[0]]
        edges, n, mean = told[place]
        assert n == len(learned) and mean == pytest.approx(np.mean([r["yield_hg_ha"] for r in learned]))
        assert list(edges[0]) == [y + 0.5 for y in range(1990, cut[0] - 1)] and list(edges[2]) == [0.5]
        assert np.array_equal(edges[1], growing.candidates(rows.where(F.col("year") < cut[0]), NAMES, [cut], 32)[0][0][1]) and len(edges[1]) == 31
    spark.sparkContext.setJobGroup(group + ", four", group)
    growing.candidates(rows, NAMES, [(y, y + 1) for y in (1992, 1993, 1994, 1995)], 32)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group + ", four")) == many
    spark.sparkContext._jsc.clearJobGroup()


def test_large_nodes_take_no_job_of_their_own(rows, spark):
    """Each level of large nodes used to be a job over all rows, which every tree then was dealt anew."""
    many = []
    for limit in (10_000, 5):
        group = f"nodes of {limit}"
        spark.sparkContext.setJobGroup(group, group)
        growing.fold_errors(rows, NAMES, [(1994, 1996)], GRID, node_rows=limit)
        many.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext._jsc.clearJobGroup()
    assert many[0] == many[1]


def test_only_nodes_that_rows_are_asked_of_are_grown(monkeypatch):
    draw = np.random.default_rng(5)
    b, y, kept, nodes = draw.integers(8, size=(400, 3)), draw.normal(size=400), growing._gains, []
    monkeypatch.setattr(growing, "_gains", lambda cells, *more: nodes.append(cells.shape[-1]) or kept(cells, *more))
    whole = growing.grow(b, np.ones(400), y, b, [8, 8, 8], 0, [0, 30])
    every = sum(nodes)
    nodes.clear()
    assert np.array_equal(growing.grow(b, np.ones(400), y, b[:1], [8, 8, 8], 0, [0, 30]), whole[:1])
    assert sum(nodes) < every / 4


def test_rows_of_a_task_are_read_in_the_order_of_their_places():
    held = growing.Rows(2, "u1")
    for place in (2, 0, 1):
        ids = np.arange(10 * place, 10 * place + 10)
        held.add(place, True, 10, growing._packed(ids, ids / 2, np.stack([ids, ids + 1]).astype("u1")))
    held.add(0, False, 1, growing._packed(np.array([5]), np.array([1.5]), np.array([[1], [2]], dtype="u1")))
    ids, y, b = (np.concatenate(part, axis=-1) for part in zip(*held.blocks(True)))
    assert list(ids) == list(range(30)) and list(y) == [i / 2 for i in range(30)] and list(b[1]) == list(range(1, 31))
    assert [list(b.ravel()) for _, _, b in held.blocks(False)] == [[1, 2]]
