"""Splits and scores of predictions, as aggregates over (label, prediction) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions.numeric import period_start, safe_ratio
from furrow.operators.ordered import running_totals

LABEL, PREDICTION = "yield_hg_ha", "prediction"


def temporal_split(df: DataFrame, cutoff: int) -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff year, and rows from it on."""
    return df.where(F.col("year") < cutoff), df.where(F.col("year") >= cutoff)


def regression_metrics(scored: DataFrame, label: str = LABEL, prediction: str = PREDICTION, by: Sequence[str] = ()) -> DataFrame:
    """n, MAE, RMSE and R2 = 1 - SSE/SST."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    sums = scored.where(y.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(y - p)).alias("mae"),
        F.avg(F.pow(y - p, 2)).alias("_mse"), F.var_pop(y).alias("_var"),
    )
    return sums.select(*by, "n", "mae", F.sqrt("_mse").alias("rmse"), (1 - safe_ratio(F.col("_mse"), F.col("_var"))).alias("r2"))


def metrics_by_period(scored: DataFrame, length: int = 3, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    staged = scored.withColumn("period_start", period_start(F.col("year"), length))
    m = regression_metrics(staged, label, prediction, ["period_start"])
    return m.select("period_start", "n", F.bround("mae", 1).alias("mae"), F.bround("rmse", 1).alias("rmse"), F.bround("r2", 4).alias("r2"))


def confusion_counts(scored: DataFrame, label: str = "label", prediction: str = PREDICTION) -> DataFrame:
    return scored.groupBy(F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_report(confusion: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of classes 0 and 1, with the accuracy;
    a ratio over nothing is 0."""
    n = F.col("n")

    def cell(actual: int, predicted: int):
        return F.coalesce(F.sum(F.when((F.col("actual") == actual) & (F.col("predicted") == predicted), n)), F.lit(0))

    cells = confusion.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))
    correct = F.col("tn") + F.col("tp")
    total = correct + F.col("fp") + F.col("fn")

    def of(name: str, hit: str, wrong: str, lost: str):
        h, w, m = F.col(hit), F.col(wrong), F.col(lost)
        return F.struct(
            F.lit(name).alias("class_name"),
            safe_ratio(h, h + w, 0.0).alias("precision"),
            safe_ratio(h, h + m, 0.0).alias("recall"),
            safe_ratio(2 * h, 2 * h + w + m, 0.0).alias("f1"),
            (h + m).alias("support"),
            safe_ratio(correct, total, 0.0).alias("accuracy"),
        )

    return cells.select(F.inline(F.array(of("low_risk", "tn", "fn", "fp"), of("high_risk", "tp", "fp", "fn"))))


def roc_auc(scored: DataFrame, score: str, label: str = "label") -> DataFrame:
    """Chance that a positive row outscores a negative one, ties counting half.

    Equal scores are folded first, then ranked by running sums over the score
    order, so the curve never has to fit one task.
    """
    folded = scored.groupBy(F.col(score).cast("double").alias("_score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg")
    )
    ranked = running_totals(folded, ["_score"], ["pos", "neg"])
    won = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.max(F.col("pos_total")).cast("double") * F.max("neg_total")
    return ranked.agg(safe_ratio(won, pairs).alias("roc_auc"), F.max("pos_total").alias("n_positive"), F.max("neg_total").alias("n_negative"))
