"""The exact best split of each feature, which a tree with few bins only comes near.

Rows are folded to one per feature and value; running sums over the sorted values give
the sums left of each value, and totals less those the right. The fall of the squared
error needs no more. Splitting a 0/1 label this way is splitting by the Gini impurity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.operators.evaluation import LABEL
from furrow.operators.ordered import running_totals


def splits(rows: DataFrame, names: Sequence[str], target: str = LABEL) -> DataFrame:
    """Each split ``value < split_value`` of each feature: ``feature``, ``split_value`` (the
    least value on the right), ``n_left``, ``n_right`` and ``gain``, by which the sum of
    squared errors falls. A feature with one value has none."""
    cells = F.inline(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").cast("double").alias("value")) for n in names]))
    long = rows.select(F.col(target).cast("double").alias("y"), cells).where("value is not null and y is not null")
    folded = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))
    n, y = F.col("n_before").cast("double"), F.col("y_before")
    m, z = F.col("n_total") - n, F.col("y_total") - y
    gain = y * y / n + z * z / m - F.col("y_total") * F.col("y_total") / F.col("n_total")
    return running_totals(folded, ["value"], ["n", "y"], ["feature"]).where("n_before > 0").select(
        "feature", F.col("value").alias("split_value"), F.col("n_before").alias("n_left"), (F.col("n_total") - F.col("n_before")).alias("n_right"), gain.alias("gain")
    )


def best_splits(rows: DataFrame, names: Sequence[str], target: str = LABEL) -> DataFrame:
    """The split of the greatest gain per feature; of equals the one of the least value."""
    best = F.max_by(F.struct("split_value", "n_left", "n_right", "gain"), F.struct("gain", -F.col("split_value")))
    return splits(rows, names, target).groupBy("feature").agg(best.alias("best")).select("feature", "best.*")
