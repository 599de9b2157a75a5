"""Landing and gating files as they arrive.

The batch lands whole sources. Here the same step picks up whatever files are
new since the last run, with the same contract and rules, and appends. Each
micro-batch writes its own folder, so a batch that is run again after a failure
replaces what it wrote the first time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from furrow.operators.quality import DUPLICATE, inspect
from furrow.sources.contracts import CONTRACTS
from furrow.sources.files import write_table


def arriving(spark: SparkSession, folder: str, source: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV files of one source as a stream of text columns."""
    names = list(columns or CONTRACTS[source])
    shape = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.readStream.schema(shape).option("header", True).option("escape", '"').csv(folder)


def _same_row(columns: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(f"new.`{c}`").eqNullSafe(F.col(f"old.`{c}`")) for c in columns])


def _earlier(spark: SparkSession, accepted: str, batch: int) -> DataFrame | None:
    try:
        return spark.read.parquet(accepted).where(F.col("batch") != batch).drop("batch")
    except AnalysisException as problem:
        # Only a folder that is not there yet means that nothing came before.
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def gate_arrivals(stream: DataFrame, source: str, home: str) -> StreamingQuery:
    """Gate everything that has arrived and stop; run again for what comes later.

    A row that an earlier batch accepted is a copy and goes to the quarantine.
    """
    accepted, quarantine = f"{home}/accepted/{source}", f"{home}/quarantine/{source}"

    def one_batch(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        gate = inspect(rows, source).settled(f"{home}/_checked/{source}/batch={batch}")
        fresh, rejected = gate.accepted(), gate.rejected()
        before = _earlier(spark, accepted, batch)
        if before is not None:
            new, old = fresh.alias("new"), before.alias("old")
            seen = new.join(old, _same_row(rows.columns), "left_semi")
            rejected = rejected.unionByName(seen.withColumn("reject_reason", F.lit(DUPLICATE)))
            fresh = new.join(old, _same_row(rows.columns), "left_anti")
        write_table(fresh, f"{accepted}/batch={batch}")
        write_table(rejected, f"{quarantine}/batch={batch}")

    writer = stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", f"{home}/_progress/{source}")
    return writer.trigger(availableNow=True).start()
