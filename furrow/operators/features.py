"""Features for the yield and risk models, built from training data only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions.numeric import correlation, flag, one_hot, safe_ratio
from furrow.operators.joining import previous_year
from furrow.operators.ordered import exact_quantiles
from furrow.session import settle
from furrow.sources.files import write_table

CONDITIONS = ("rainfall_mm", "avg_temp_c", "pesticides_tonnes")
KEYS = ("area", "crop", "year")
# Fixed value: first year of the later era.
ERA_START = 1990


def long_form(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(feature, value) rows of several numeric columns, nulls left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.inline(cells)).where(F.col("value").isNotNull())


@dataclass(frozen=True)
class FeatureStats:
    """What is learned from the training rows. The region means stay a frame;
    the rest is one number per condition and one name per crop."""

    medians: dict[str, float]
    region_means: DataFrame
    global_mean: float
    crops: tuple[str, ...]
    era_start: int = ERA_START

    @staticmethod
    def fit(train: DataFrame, era_start: int = ERA_START) -> FeatureStats:
        middle = exact_quantiles(long_form(train, CONDITIONS), "value", [0.5], ["feature"])
        medians = {r["feature"]: r["quantiles"][0] for r in middle.collect()}
        overall = train.agg(F.avg("yield_hg_ha").alias("m")).first()["m"]
        crops = tuple(sorted(r["crop"] for r in train.select("crop").where("crop is not null").distinct().collect()))
        # Written: one row per area, whose size the planner then knows when rows look theirs up.
        means = settle(train.groupBy("area").agg(F.avg("yield_hg_ha").alias("region_mean_yield")))
        return FeatureStats(medians, means, overall, crops, era_start)

    @property
    def names(self) -> list[str]:
        """Feature columns in the order models are trained on."""
        pairs = [name for c in CONDITIONS for name in (f"{c}_missing", c)]
        history = ["region_mean_yield", "lag1_yield_missing", "lag1_yield", "yield_trend_ratio"]
        return ["year", "is_post_1990", *pairs, *history, *[f"crop_{c}" for c in self.crops]]

    def transform(self, df: DataFrame, history: DataFrame, keep: tuple[str, ...] = ("area", "crop", "yield_hg_ha")) -> DataFrame:
        """``keep`` columns, then the features. ``history`` is where last year's
        yield is looked up; the row's own yield is never read."""
        return self.apply(
            df.join(previous_year(history, KEYS[:2], "yield_hg_ha", "_lag"), list(KEYS), "left").join(
                self.region_means.withColumnRenamed("region_mean_yield", "_region"), "area", "left"
            ),
            keep,
        )

    def apply(self, looked_up: DataFrame, keep: tuple[str, ...]) -> DataFrame:
        """Features of rows that already carry ``_lag`` and ``_region``."""
        region = F.coalesce(F.col("_region"), F.lit(self.global_mean))
        lag = F.coalesce(F.col("_lag").cast("double"), region)
        columns = {"year": F.col("year"), "is_post_1990": flag(F.col("year") >= self.era_start)}
        for c in CONDITIONS:
            columns[f"{c}_missing"] = flag(F.col(c).isNull())
            columns[c] = F.coalesce(F.col(c), F.lit(self.medians.get(c)))
        columns["region_mean_yield"] = region
        columns["lag1_yield_missing"] = flag(F.col("_lag").isNull())
        columns["lag1_yield"] = lag
        columns["yield_trend_ratio"] = safe_ratio(lag, region, default=1.0)
        columns |= one_hot(F.col("crop"), self.crops, "crop_")
        kept = [F.col(c) for c in keep if c not in columns]
        return looked_up.select(*kept, *[value.alias(name) for name, value in columns.items()])

    def save(self, spark: SparkSession, folder: str) -> None:
        write_table(self.region_means, f"{folder}/region_means")
        row = (self.medians, self.global_mean, list(self.crops), self.era_start)
        shape = "medians map<string,double>, global_mean double, crops array<string>, era_start int"
        write_table(spark.createDataFrame([row], shape), f"{folder}/summary")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> FeatureStats:
        row = spark.read.parquet(f"{folder}/summary").first()
        means = spark.read.parquet(f"{folder}/region_means")
        return FeatureStats(dict(row["medians"]), means, row["global_mean"], tuple(row["crops"]), row["era_start"])


class TargetLeakage(AssertionError):
    """A feature gives the target away."""


def leakage_report(features: DataFrame, names: list[str], target: str = "yield_hg_ha") -> DataFrame:
    """Per feature: whether it equals the target on every row, whether it is
    constant, and its correlation with the target. One pass over the rows."""
    cells = []
    for i, name in enumerate(names):
        c = F.col(f"`{name}`").cast("double")
        t = F.col(target).cast("double")
        cells += [
            F.min(c.eqNullSafe(t)).alias(f"_same{i}"),
            F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(f"_flat{i}"),
            correlation(c, t).alias(f"_r{i}"),
        ]
    shape = [
        F.struct(F.lit(n).alias("feature"), F.col(f"_same{i}").alias("identical"), F.col(f"_flat{i}").alias("constant"), F.col(f"_r{i}").alias("r"))
        for i, n in enumerate(names)
    ]
    found = features.agg(*cells).select(F.inline(F.array(*shape)))
    # A feature that never varies has no correlation to speak of.
    return found.withColumn("r", F.when(~F.col("constant"), F.col("r"))).withColumn(
        "leaks", F.col("identical") | F.coalesce(F.abs("r") > 0.999, F.lit(False))
    )


def assert_no_leakage(features: DataFrame, names: list[str], target: str = "yield_hg_ha") -> None:
    leaks = leakage_report(features, names, target).where("leaks").collect()
    if leaks:
        raise TargetLeakage("; ".join(f"{r['feature']} (identical={r['identical']}, r={r['r']})" for r in leaks))


def check_feature_order(found: list[str], saved: list[str]) -> None:
    """A model must get the columns it was trained on, in that order."""
    if list(found) != list(saved):
        raise ValueError(f"feature columns differ from the saved ones: {found} != {saved}")
