"""Groups of growing conditions by area and year."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.operators.features import CONDITIONS
from furrow.operators.statistics import mean_z_by
from furrow.sources.star import one_row_per_region_year

# The cluster counts that are tried, the one used, the restarts.
K_RANGE = range(2, 9)
K, RESTARTS = 4, 10


def conditions_table(curated: DataFrame) -> DataFrame:
    """Area-years with all conditions known, each once."""
    return one_row_per_region_year(curated, *CONDITIONS).dropna(subset=list(CONDITIONS))


def scale_conditions(conditions: DataFrame) -> tuple[PipelineModel, DataFrame]:
    assembler = VectorAssembler(inputCols=list(CONDITIONS), outputCol="raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    fitted = Pipeline(stages=[assembler, scaler]).fit(conditions)
    return fitted, fitted.transform(conditions)


def fit_clusters(scaled: DataFrame, k: int = K, restarts: int = RESTARTS):
    """The restart with the smallest within-cluster sum of squares."""
    models = [KMeans(k=k, seed=seed).fit(scaled) for seed in range(restarts)]
    return min(models, key=lambda m: m.summary.trainingCost)


def search_k(scaled: DataFrame, ks=K_RANGE, restarts: int = RESTARTS, at_once: int = 4) -> DataFrame:
    """Within-cluster sum of squares and silhouette for each cluster count; so many
    counts are fitted ``at_once``, as jobs side by side."""

    def one(k: int) -> tuple[int, float, float]:
        model = fit_clusters(scaled, k, restarts)
        return k, float(model.summary.trainingCost), float(ClusteringEvaluator().evaluate(model.transform(scaled)))

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        jobs = [pool.submit(inheritable_thread_target(scaled.sparkSession)(one), k) for k in ks]
        rows = [job.result() for job in jobs]
    return scaled.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def profile_clusters(assigned: DataFrame, curated: DataFrame, cluster: str = "prediction") -> DataFrame:
    """Mean conditions and size of each cluster, with the mean crop-relative
    yield of its area-years, which took no part in forming it."""
    yields = mean_z_by(curated, ["area", "year"], "_z")
    return (
        assigned.join(yields, ["area", "year"], "left")
        .groupBy(F.col(cluster).alias("cluster"))
        .agg(
            *[F.avg(c).alias(c) for c in CONDITIONS],
            F.count(F.lit(1)).alias("n_region_years"),
            F.avg("_z").alias("mean_yield_zscore"),
        )
    )
