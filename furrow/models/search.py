"""Searching forest sizes with one fit per fold.

A forest of many trees holds the smaller ones, and a deep tree the shallower ones: every
split is chosen from all features, so the first levels of a tree do not depend on how deep
it goes on. Each fold is therefore fitted once, with the most trees and the greatest depth
of the grid, and every (trees, depth) is scored from that fit. ``models.growing`` fits all
folds in one job, which holds no forest as a whole. Of a fitted MLlib forest the cuts are
scored in one pass: it names the leaf of each tree, and a table says what the ancestor of
that leaf at a depth predicts.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.models import growing, regression
from furrow.operators.evaluation import LABEL
from furrow.session import scratch_path

#: The forests that are compared (trees, depth).
FOREST_GRID = ((100, 8), (200, 12), (200, regression.DEEPEST))


def year_cuts(features: DataFrame, folds: int = 4) -> list[tuple[int, int]]:
    """The first year that each fold validates on, and the one after its last."""
    years = [r["year"] for r in features.select("year").distinct().orderBy("year").collect()]
    cuts = [years[(i + 1) * len(years) // (folds + 1)] for i in range(folds)] + [years[-1] + 1]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a > years[0] and b > a]


def year_folds(features: DataFrame, folds: int = 4) -> list[tuple[DataFrame, DataFrame]]:
    """Forward-chaining folds cut between years: train on all earlier years,
    validate on the next stretch."""
    return [
        (features.where(F.col("year") < a), features.where((F.col("year") >= a) & (F.col("year") < b)))
        for a, b in year_cuts(features, folds)
    ]


def nodes_of(model: PipelineModel) -> pd.DataFrame:
    """The nodes of a fitted tree model, one row each, in the order of tree and node.

    The model itself is held by the driver, so its nodes are no larger."""
    forest = regression.fitted(model)
    spark = SparkSession.active()
    path = scratch_path(spark, "model-nodes")
    forest.write().save(path)
    held = spark.read.parquet(f"{path}/data")
    node = "nodeData." if "nodeData" in held.columns else ""
    tree = F.col("treeID") if node else F.lit(0)
    return (
        held.select(
            tree.alias("tree"),
            *[F.col(f"{node}{c}").alias(c) for c in ("id", "prediction", "leftChild", "rightChild")],
            F.col(f"{node}split.featureIndex").alias("feature"),
            F.get(F.col(f"{node}split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
        )
        .toPandas()
        .sort_values(["tree", "id"], ignore_index=True)
    )


def values_by_depth(nodes: pd.DataFrame, depths: Sequence[int]) -> dict[int, np.ndarray]:
    """Per depth a table (tree, leaf): what the tree predicts there if it ends at that depth.
    Leaves are numbered from left to right, which is the order of the node ids."""
    tree = nodes["tree"].to_numpy()
    first = np.searchsorted(tree, tree)  # the node ids of a tree start at 0
    left, right = (nodes[c].to_numpy() for c in ("leftChild", "rightChild"))
    inner = np.flatnonzero(left >= 0)
    parent = np.arange(len(nodes))
    for child in (left, right):
        parent[first[inner] + child[inner]] = inner
    depth, level = np.zeros(len(nodes), dtype=np.int64), np.flatnonzero(parent == np.arange(len(nodes)))
    while len(level):
        grown = level[left[level] >= 0]
        level = np.concatenate([first[grown] + left[grown], first[grown] + right[grown]])
        depth[level] = depth[parent[level]] + 1
    leaves = np.flatnonzero(left < 0)
    row = tree[leaves]
    column = np.arange(len(leaves)) - np.searchsorted(row, row)
    out = {}
    for most in depths:
        at = leaves.copy()
        while (over := depth[at] > most).any():
            at[over] = parent[at[over]]
        out[most] = np.zeros((int(tree.max()) + 1, int(column.max()) + 1))
        out[most][row, column] = nodes["prediction"].to_numpy()[at]
    return out


def mae_of_cuts(model: PipelineModel, rows: DataFrame, grid: Sequence[tuple[int, int]]) -> list[float]:
    """Mean absolute error of each (trees, depth) cut out of one forest, in one pass."""
    values = values_by_depth(nodes_of(model), sorted({d for _, d in grid}))

    @F.pandas_udf("array<double>")
    def told(leaves: pd.Series) -> pd.Series:
        at = np.vstack(leaves.to_numpy()).astype(np.int64) if len(leaves) else np.empty((0, 1), dtype=np.int64)
        out = []
        for trees, depth in grid:
            k = np.arange(trees)
            out.append(values[depth][k[None, :], at[:, :trees]].mean(axis=1))
        return pd.Series(list(np.stack(out, axis=1)))

    regression.fitted(model).setLeafCol("leaves")
    scored = model.transform(rows).select(F.col(LABEL).cast("double").alias("y"), told(vector_to_array("leaves")).alias("p"))
    means = scored.agg(F.array(*[F.avg(F.abs(F.col("y") - F.col("p")[i])) for i in range(len(grid))]).alias("mae"))
    return means.first()["mae"]


def search_forest(
    features: DataFrame, names: Sequence[str], grid: Sequence[tuple[int, int]] = FOREST_GRID, folds: int = 4, bins: int = regression.BINS
) -> DataFrame:
    """Mean validation MAE of each (trees, depth) over the year folds, best first."""
    cuts = year_cuts(features, folds)
    if not cuts:
        raise ValueError("too few years to cut folds from")
    told = growing.fold_errors(features, names, cuts, grid, bins)
    rows = [(t, d, i, float(m)) for i, own in enumerate(told) for (t, d), m in zip(grid, own, strict=True)]
    cells = [F.struct(F.lit(t).alias("trees"), F.lit(d).alias("depth"), F.lit(i).alias("fold"), F.lit(m).alias("mae")) for t, d, i, m in rows]
    # Literals, as a table made from rows would be read by a Python worker a core.
    every = features.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*cells)))
    return every.groupBy("trees", "depth").agg(F.avg("mae").alias("mean_mae"), F.count(F.lit(1)).alias("n_folds")).orderBy("mean_mae", "trees", "depth")


def tuned_forest(
    features: DataFrame, names: Sequence[str], grid: Sequence[tuple[int, int]] = FOREST_GRID, folds: int = 4, bins: int = regression.BINS
) -> tuple[PipelineModel, list[tuple[int, int, float, int]]]:
    """The forest of the winning size, fitted on all rows, and the search's rows, best first."""
    found = [(r["trees"], r["depth"], r["mean_mae"], r["n_folds"]) for r in search_forest(features, names, grid, folds, bins).collect()]
    trees, depth = found[0][:2]
    return regression.forest(features, names, trees, depth, bins), found
