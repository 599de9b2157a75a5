"""What-if questions answered in bulk: a table of requests, scored together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions.numeric import percent_change, safe_ratio
from furrow.models.scoring import scored
from furrow.operators.features import CONDITIONS, FeatureStats

KEYS = ("area", "crop", "year")
# Eleven steps from half to one and a half.
MULTIPLIERS = tuple(0.5 + 0.1 * i for i in range(11))


def actual_and_predicted(scored: DataFrame) -> DataFrame:
    return scored.select(*KEYS, "yield_hg_ha", F.col("prediction"), (F.col("prediction") - F.col("yield_hg_ha")).alias("error"))


@dataclass(frozen=True)
class WhatIf:
    model: PipelineModel
    stats: FeatureStats
    history: DataFrame

    def base_rows(self, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Requests with the recorded conditions of their key as ``base_*``, and
        the requests no record exists for. ``request_id`` must be unique."""
        kept = self.history.select(*KEYS, F.struct(*CONDITIONS).alias("_c"))
        found = requests.join(kept, list(KEYS)).groupBy(*requests.columns).agg(F.min("_c").alias("_c"))
        told = found.select(*requests.columns, *[F.col(f"_c.{c}").alias(f"base_{c}") for c in CONDITIONS])
        return told, requests.join(self.history.select(*KEYS), list(KEYS), "left_anti")

    def predict(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        features = self.stats.transform(rows, self.history, tuple(keep))
        return scored(self.model, features).select(*keep, "prediction")

    def scenarios(self, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Predictions as recorded and with the request's overrides, and the requests
        that no record exists for.

        A request sets any of the condition columns; a null leaves the recorded
        value. Area, crop, year and history cannot be changed.
        """
        based, unknown = self.base_rows(requests)
        as_is = F.struct(F.lit("baseline").alias("variant"), *[F.col(f"base_{c}").alias(c) for c in CONDITIONS])
        changed = F.struct(F.lit("scenario").alias("variant"), *[F.coalesce(F.col(c), F.col(f"base_{c}")).alias(c) for c in CONDITIONS])
        both = based.select("request_id", *KEYS, F.inline(F.array(as_is, changed)))
        found = self.predict(both, ["request_id", "variant", *KEYS[:2], "year"])
        sides = found.groupBy("request_id", *KEYS).agg(
            F.max(F.when(F.col("variant") == "baseline", F.col("prediction"))).alias("baseline_prediction_hg_ha"),
            F.max(F.when(F.col("variant") == "scenario", F.col("prediction"))).alias("scenario_prediction_hg_ha"),
        )
        base, new = F.col("baseline_prediction_hg_ha"), F.col("scenario_prediction_hg_ha")
        told = sides.withColumns({"absolute_change_hg_ha": new - base, "percent_change": percent_change(base, new)})
        return told, unknown.select("request_id", *KEYS, F.lit("no record").alias("problem"))

    def sensitivity(self, requests: DataFrame, column: str, multipliers: Sequence[float] = MULTIPLIERS) -> tuple[DataFrame, DataFrame]:
        """Predictions as one condition is scaled, and the requests that cannot
        be scaled because the condition or the whole record is missing."""
        wanted = requests.select("request_id", *KEYS)
        based, unknown = self.base_rows(wanted)
        usable = based.where(F.col(f"base_{column}").isNotNull())
        scaled = usable.select("*", F.explode(F.lit([float(m) for m in multipliers])).alias("multiplier")).select(
            "request_id", *KEYS, "multiplier",
            *[(F.col(f"base_{c}") * F.col("multiplier") if c == column else F.col(f"base_{c}")).alias(c) for c in CONDITIONS],
            (F.col(f"base_{column}") * F.col("multiplier")).alias("scaled_value"),
        )
        curve = self.predict(scaled, ["request_id", *KEYS[:2], "year", "multiplier", "scaled_value"])
        empty = based.where(F.col(f"base_{column}").isNull()).select("request_id", *KEYS, F.lit(f"{column} is missing").alias("problem"))
        refused = unknown.select("request_id", *KEYS, F.lit("no record").alias("problem")).unionByName(empty)
        return curve.withColumnRenamed("prediction", "predicted_yield_hg_ha"), refused


def curve_spread(curve: DataFrame) -> DataFrame:
    """How far each curve moves in all, also in percent of its unscaled point."""
    p = F.col("predicted_yield_hg_ha")
    at_one = F.max(F.when(F.abs(F.col("multiplier") - 1.0) < 1e-9, p))
    moved = curve.groupBy("request_id", *KEYS).agg((F.max(p) - F.min(p)).alias("spread"), at_one.alias("baseline"))
    return moved.withColumn("spread_pct", safe_ratio(F.lit(100.0) * F.col("spread"), F.col("baseline")))
