"""Yield regressors, fitted with MLlib on the feature table."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.operators.evaluation import LABEL, regression_metrics
from furrow.operators.features import FeatureStats
from furrow.sources.files import now

SEED = 42
DEEPEST = 30  # MLlib's limit
#: Candidate thresholds of a feature in a forest, and in a single tree. ``models.splits``
#: finds the exact ones.
BINS, TREE_BINS = 32, 256
#: Memory a task may use for the candidate sums of the nodes it splits in one pass.
NODE_MB = 128


def spread(rows: DataFrame) -> DataFrame:
    """Rows in at least as many partitions as there are cores: a small table is one file,
    and MLlib would grow every tree in a single task."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def _train(features: DataFrame, names: Sequence[str], estimator) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(names), outputCol="features")
    return Pipeline(stages=[assembler, estimator]).fit(features)


def linear(features: DataFrame, names: Sequence[str]) -> PipelineModel:
    return _train(features, names, LinearRegression(labelCol=LABEL, solver="normal"))


def ridge(features: DataFrame, names: Sequence[str], alpha: float = 10.0) -> PipelineModel:
    """Least squares with ``alpha`` on the squared norm of the coefficients.

    MLlib averages the loss over the rows and scales by the label's deviation,
    which is undone here.
    """
    size = features.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(LABEL).alias("s")).first()
    penalty = alpha * size["s"] / size["n"]
    return _train(features, names, LinearRegression(labelCol=LABEL, solver="normal", regParam=penalty, elasticNetParam=0.0, standardization=False))


def tree(features: DataFrame, names: Sequence[str], depth: int = DEEPEST, bins: int = TREE_BINS) -> PipelineModel:
    estimator = DecisionTreeRegressor(labelCol=LABEL, maxDepth=depth, maxBins=bins, seed=SEED, maxMemoryInMB=NODE_MB)
    return _train(spread(features), names, estimator)


def forest(features: DataFrame, names: Sequence[str], trees: int = 100, depth: int = 8, bins: int = BINS) -> PipelineModel:
    """``cacheNodeIds`` keeps each row's node of every tree, so that a level costs no
    walk from the root."""
    estimator = RandomForestRegressor(
        labelCol=LABEL, numTrees=trees, maxDepth=depth, maxBins=bins, seed=SEED, featureSubsetStrategy="all", maxMemoryInMB=NODE_MB, cacheNodeIds=True
    )
    return _train(spread(features), names, estimator)


def fitted(model: PipelineModel) -> Model:
    return model.stages[-1]


def coefficient_norm(model: PipelineModel) -> float:
    return float(fitted(model).coefficients.norm(2))


def train_and_test(name: str, model: PipelineModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """Metrics of one model on both sides of the split, one row each."""
    sides = [
        regression_metrics(model.transform(rows)).select(F.lit(name).alias("model"), F.lit(side).alias("split"), "n", "mae", "rmse", "r2")
        for side, rows in (("train", train), ("test", test))
    ]
    return reduce(DataFrame.unionByName, sides)


def model_card(model: PipelineModel, stats: FeatureStats, train: DataFrame, scored_test: DataFrame, version: str = "yield_rf_v1") -> DataFrame:
    """One row that says what was trained, on what and how well it did."""
    inner = fitted(model)
    settings = {p.name: inner.getOrDefault(p) for p in inner.params if inner.isDefined(p)}
    span = train.agg(F.struct(F.count(F.lit(1)).alias("n"), F.min("year").alias("a"), F.max("year").alias("b")).alias("t"))
    metrics = regression_metrics(scored_test).select(F.struct("mae", "rmse", "r2", "n").alias("test_metrics_at_training_time"))
    return metrics.withColumn("_t", span.scalar()).select(
        F.lit(version).alias("model_version"), F.lit(now()).alias("trained_at"), F.lit(type(inner).__name__).alias("algorithm"),
        F.lit(json.dumps(settings, default=str)).alias("hyperparameters"),
        F.array(*[F.lit(n) for n in stats.names]).alias("feature_columns"),
        F.col("_t.n").alias("training_rows"), F.array("_t.a", "_t.b").alias("training_year_range"),
        "test_metrics_at_training_time",
    )
