import pytest
from pyspark.sql import functions as F

from furrow.models import risk


def test_rows_are_scored_once_for_the_report_and_the_curve(spark):
    scored = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(i):
        scored.add(1)
        return i / 10.0

    rows = spark.range(10).select((F.col("id") % 2).alias("label"), score("id").alias("risk")).withColumn("prediction", (F.col("risk") > 0.45).cast("double"))
    told = risk.summary_row("m", rows).first()
    assert scored.value == 10
    assert told["accuracy"] == pytest.approx(0.6) and told["roc_auc"] == pytest.approx(15 / 25)
