"""Risk of a yield below its crop's usual range, and the classifiers for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions.numeric import flag
from furrow.models.regression import BINS, NODE_MB, SEED, TREE_BINS, spread
from furrow.operators.evaluation import classification_report, confusion_counts, roc_auc
from furrow.operators.ordered import exact_quantiles
from furrow.session import settle

# Fixed value: the quantile of a crop's training yields below which a yield is at risk.
RISK_QUANTILE = 0.25


def risk_thresholds(train: DataFrame, quantile: float = RISK_QUANTILE) -> DataFrame:
    cuts = exact_quantiles(train, "yield_hg_ha", [quantile], ["crop"])
    # Written: one row per crop, whose size the planner then knows when labels are joined.
    return settle(cuts.select("crop", F.col("quantiles")[0].alias("threshold")))


def label_risk(rows: DataFrame, thresholds: DataFrame, name: str = "label") -> DataFrame:
    """1 strictly below the crop's threshold, else 0; a crop without one is 0."""
    return rows.join(thresholds, "crop", "left").withColumn(name, flag(F.col("yield_hg_ha") < F.col("threshold"))).drop("threshold")


def class_balance(rows: DataFrame, label: str = "label") -> DataFrame:
    return rows.agg(F.avg(label).alias("high_risk_rate"), F.sum(label).alias("n_high_risk"), F.count(F.lit(1)).alias("n"))


def majority_class(train: DataFrame, rows: DataFrame, label: str = "label") -> DataFrame:
    """Predict the most frequent training label everywhere; the lower one on a tie."""
    common = train.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), label).limit(1).select(label)
    return rows.withColumn("prediction", common.scalar().cast("double"))


def _fit(train: DataFrame, names: Sequence[str], estimator, scaled: bool) -> PipelineModel:
    stages = [VectorAssembler(inputCols=list(names), outputCol="raw_features" if scaled else "features")]
    if scaled:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    return Pipeline(stages=[*stages, estimator]).fit(train)


def logistic(train: DataFrame, names: Sequence[str], balanced: bool = False, c: float = 1.0) -> PipelineModel:
    """Logistic regression on standardised features with penalty 1 / ``c``.

    ``balanced`` weighs each class by the inverse of its share.
    """
    sizes = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    n = sum(sizes.values())
    weight = F.lit(1.0)
    if balanced:
        weight = F.when(F.col("label") == 1, n / (2.0 * sizes.get(1, n))).otherwise(n / (2.0 * sizes.get(0, n)))
    estimator = LogisticRegression(regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=1000, weightCol="_weight")
    return _fit(train.withColumn("_weight", weight), names, estimator, scaled=True)


def tree(train: DataFrame, names: Sequence[str], depth: int = 8, bins: int = TREE_BINS) -> PipelineModel:
    return _fit(spread(train), names, DecisionTreeClassifier(maxDepth=depth, maxBins=bins, seed=SEED), scaled=False)


def forest(train: DataFrame, names: Sequence[str], trees: int = 200, depth: int = 10, bins: int = BINS) -> PipelineModel:
    estimator = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=bins, seed=SEED, maxMemoryInMB=NODE_MB, cacheNodeIds=True)
    return _fit(spread(train), names, estimator, scaled=False)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``prediction`` and ``risk``, the probability of class 1."""
    ready = rows if "_weight" in rows.columns else rows.withColumn("_weight", F.lit(1.0))
    scored = model.transform(ready)
    return scored.withColumn("risk", vector_to_array("probability")[1]).drop("_weight", "raw_features", "features", "rawPrediction", "probability")


def summary_row(name: str, scored: DataFrame, with_auc: bool = True) -> DataFrame:
    """Accuracy, AUC and the high-risk precision, recall and F1 of one classifier. Rows are
    scored once, as the report and the curve read what was written."""
    if with_auc:
        scored = settle(scored.select("label", "prediction", "risk"))
    report = classification_report(confusion_counts(scored)).where("class_name = 'high_risk'")
    auc = roc_auc(scored, "risk").select("roc_auc").scalar() if with_auc else F.lit(None).cast("double")
    return report.select(F.lit(name).alias("model"), "accuracy", auc.alias("roc_auc"), "precision", "recall", "f1", "support")
