"""Predictions for rows that are made by the million from others.

MLlib walks a forest row by row, and each row's walk brings all trees into the cache again.
Here a block of rows walks down one tree after the other. A row is told the same number:
the trees' predictions are added up in their order and divided by how many they are.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.models import search

#: Nodes of a forest that every task may hold; MLlib scores a larger one.
NODES = 1_000_000
#: Rows that walk down together.
ROWS = 4_096


class Forest:
    """The nodes of a forest as arrays, with a place for each side of a node: a row at an
    even one goes on to what is written there, or one further. A leaf leads to itself."""

    def __init__(self, nodes: pd.DataFrame, features: int) -> None:
        tree, inner = nodes["tree"].to_numpy(), nodes["leftChild"].to_numpy() >= 0
        feature = np.where(inner, nodes["feature"].to_numpy(), 0).astype(np.int64)
        threshold = nodes["threshold"].to_numpy()
        # A row's place among the thresholds of a feature says which of them it passes.
        self.thresholds = [np.unique(threshold[inner & (feature == f)]) for f in range(features)]
        self.kind = np.min_scalar_type(max(map(len, self.thresholds)))
        cut = np.zeros(len(nodes), dtype=self.kind)
        for f, own in enumerate(self.thresholds):
            here = np.flatnonzero(inner & (feature == f))
            cut[here] = np.searchsorted(own, threshold[here])
        first = np.searchsorted(tree, tree)  # the node ids of a tree start at 0, and it holds all of them
        sides = [np.where(inner, first + nodes[c].to_numpy(), np.arange(len(nodes))) for c in ("leftChild", "rightChild")]
        self.next = 2 * np.stack(sides, axis=1).ravel()
        self.feature, self.cut, self.value = np.repeat(feature, 2), np.repeat(cut, 2), np.repeat(nodes["prediction"].to_numpy(), 2)
        self.roots, self.depths = 2 * np.unique(first), []
        for root in self.roots:
            level, depth = np.array([root]), -1
            while len(level):
                level, depth = level[self.next[level] != level], depth + 1
                level = np.concatenate([self.next[level], self.next[level + 1]])
            self.depths.append(depth)

    def predict(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        return np.concatenate([self._block([c[i:i + ROWS] for c in columns]) for i in range(0, len(columns[0]), ROWS)] or [np.empty(0)])

    def _block(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        places = np.concatenate([np.searchsorted(own, c, side="left").astype(self.kind) for own, c in zip(self.thresholds, columns)])
        many = len(columns[0])
        row, start, total = np.arange(many), self.feature * many, np.zeros(many)
        at, cell = np.empty(many, dtype=np.int64), np.empty(many, dtype=np.int64)
        place, cut, told = np.empty(many, dtype=self.kind), np.empty(many, dtype=self.kind), np.empty(many)
        # No place is out of range; numpy is only spared to check it.
        for root, depth in zip(self.roots, self.depths):
            at.fill(root)
            for _ in range(depth):
                start.take(at, out=cell, mode="wrap")
                cell += row
                places.take(cell, out=place, mode="wrap")
                self.cut.take(at, out=cut, mode="wrap")
                np.add(at, place > cut, out=cell)
                self.next.take(cell, out=at, mode="wrap")
            total += self.value.take(at, out=told, mode="wrap")
        return total / len(self.roots)


def predicted(model: Model, rows: DataFrame, values: Sequence[Column]) -> DataFrame:
    """``rows`` with the model's ``prediction`` for the features ``values``."""
    if not isinstance(model, RandomForestRegressionModel) or model.totalNumNodes > NODES:
        return model.transform(rows.withColumn("features", array_to_vector(F.array(*[v.cast("double") for v in values])))).drop("features")
    forest = Forest(search.nodes_of(PipelineModel(stages=[model])), len(values))

    @F.pandas_udf("double")
    def told(*columns: pd.Series) -> pd.Series:
        return pd.Series(forest.predict([c.to_numpy() for c in columns]))

    return rows.withColumn("prediction", told(*[v.cast("double") for v in values]))


def scored(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with the ``prediction`` of a model whose features are columns of theirs."""
    first, *_, last = model.stages
    if len(model.stages) != 2 or not isinstance(first, VectorAssembler) or not isinstance(last, RandomForestRegressionModel):
        return model.transform(rows)
    return predicted(last, rows, [F.col(f"`{n}`") for n in first.getInputCols()])
