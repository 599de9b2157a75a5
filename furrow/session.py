"""Session settings and the shared folder that long lineages are cut into."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "furrow", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit
    configuration decides, and adaptive execution sizes the shuffles.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def use_checkpoint_folder(spark: SparkSession) -> str:
    """The folder checkpoints go to: the one the cluster names, if it names one.

    A machine-local folder is made only for a ``local`` master, where it is
    shared by construction.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="furrow-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir() or named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table under the checkpoint folder."""
    return f"{use_checkpoint_folder(spark)}/{name}-{os.urandom(8).hex()}"


#: Paths of the tables that operators have settled and that still stand.
_SETTLED: list[str] = []


def remove_settled(spark: SparkSession, paths: list[str]) -> None:
    """Removes settled tables, whatever file system they are on."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
        if path in _SETTLED:
            _SETTLED.remove(path)


@contextmanager
def settled_for_a_while(spark: SparkSession) -> Iterator[None]:
    """Tables that are settled inside are removed at the end. Frames that still read them
    must have been written elsewhere by then. Not for work on several threads."""
    before = len(_SETTLED)
    try:
        yield
    finally:
        remove_settled(spark, _SETTLED[before:])


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and go on from that.

    Used where several branches must see the very same rows, for instance the
    slice numbers of a range shuffle, even if an executor is lost in between. A
    written table is computed once, and the branches read only their columns.
    """
    path = scratch_path(df.sparkSession, "settled")
    _SETTLED.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
