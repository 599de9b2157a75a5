"""Reading raw files and writing every table and report the jobs produce."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Collection, Iterable, Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.functions.text import number_or_null
from furrow.sources.contracts import CONTRACTS

log = logging.getLogger(__name__)

RECEIPT = "source_name string, source_path string, raw_path string, columns array<string>, record_count long, ingested_at string, load_id string, torn_count long"
LANDING = "source_name string, landed boolean, record_count long, torn_count long, problem string"
#: Column with the text of a torn record, and why such a record is refused.
TORN, TORN_REASON = "_torn_record", "torn_record"


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


def scan_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A headed CSV with every column as text; no inference pass over the file.

    ``multiline`` reads line breaks inside quotes, at the price that a file is read by one
    task: set it for the sources that have them, and hand such sources over in many files."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=multiline, escape='"')


def scan_records(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """As ``scan_text``, with the whole text of a torn record in ``TORN`` beside whatever
    could be read of it: one with too few or too many fields, or a quote that never
    closes. The column is null for a sound record. Read line by line, a record with a line
    break is cut; its first part is torn, the rest may pass for a record of its own."""
    names = scan_text(spark, path, multiline).columns
    shape = T.StructType([T.StructField(n, T.StringType()) for n in (*names, TORN)])
    return spark.read.csv(
        path, schema=shape, header=True, multiLine=multiline, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=TORN
    )


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def as_contract_types(df: DataFrame, source: str) -> DataFrame:
    """The contract columns in their clean-file types; unreadable numbers become null."""
    named = strip_headers(df)
    columns = []
    for name, kind in CONTRACTS[source].items():
        quoted = F.col(f"`{name}`")
        if kind == "string":
            columns.append(quoted)
        else:
            columns.append(number_or_null(quoted, sentinel=None).try_cast(kind).alias(name))
    return named.select(*columns)


def scan_typed(spark: SparkSession, path: str, source: str, multiline: bool = False) -> DataFrame:
    return as_contract_types(scan_text(spark, path, multiline), source)


def land(
    spark: SparkSession, source: str, source_path: str, raw_dir: str, multiline: bool = False, load_id: str | None = None
) -> dict:
    """Take custody of one source: copy it into the raw zone and count it.

    The file is parsed once. Torn records are kept beside the others, with their text, and
    are no part of what ``read_raw`` gives. A load that is repeated under its ``load_id``
    replaces its copy and counts once in the manifest.
    """
    incoming = scan_records(spark, source_path, multiline)
    names = [c for c in incoming.columns if c != TORN]
    if not names:
        raise ValueError(f"{source_path} has no header")
    raw_path = f"{raw_dir}/{source}"
    write_table(incoming.withColumn("_is_torn", F.col(TORN).isNotNull()), raw_path, ["_is_torn"])
    receipt = {
        "source_name": source,
        "source_path": source_path,
        "raw_path": raw_path,
        "columns": names,
        # Counted on the landed copy, whose footers hold the row counts. A metric
        # observed during the write would leave the session unable to ship MLlib
        # closures to the executors.
        "record_count": read_raw(spark, raw_dir, source).count(),
        "ingested_at": now(),
        "load_id": load_id or uuid.uuid4().hex,
        "torn_count": read_torn(spark, raw_dir, source).count(),
    }
    append_manifest(spark, f"{raw_dir}/_manifest", receipt)
    return receipt


def land_all(
    spark: SparkSession, sources: Mapping[str, str], raw_dir: str, multiline: Collection[str] = (), load_id: str | None = None
) -> DataFrame:
    """Land each named source; a source that cannot be read is logged and skipped.
    ``multiline`` names the sources with line breaks inside quotes."""
    outcome = []
    for source, path in sources.items():
        try:
            receipt = land(spark, source, path, raw_dir, source in multiline, load_id)
            outcome.append((source, True, receipt["record_count"], receipt["torn_count"], None))
        except (AnalysisException, ValueError) as problem:
            log.error("skipping %s: %s", source, problem)
            outcome.append((source, False, None, None, str(problem).splitlines()[0]))
    return spark.createDataFrame(outcome, LANDING)


def append_manifest(spark: SparkSession, path: str, receipt: dict) -> None:
    row = tuple(receipt[field.split()[0]] for field in RECEIPT.split(", "))
    spark.createDataFrame([row], RECEIPT).write.mode("append").parquet(path)


def latest_by_key(rows: DataFrame, keys: Collection[str], order: str) -> DataFrame:
    """Of the rows appended under one key the one with the greatest ``order``: what is
    appended twice, by a repeated run, has effect once."""
    kept = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max_by(F.struct(*rows.columns), F.col(order)).alias("_row"))
    return kept.select("_row.*")


def read_manifest(spark: SparkSession, raw_dir: str) -> DataFrame:
    """One receipt per load and source, the latest if a load was repeated."""
    return latest_by_key(spark.read.schema(RECEIPT).parquet(f"{raw_dir}/_manifest"), ["load_id", "source_name"], "ingested_at")


def _landed(spark: SparkSession, raw_dir: str, source: str, torn: bool) -> DataFrame:
    whole = spark.read.parquet(f"{raw_dir}/{source}")
    return whole.where(F.col("_is_torn") == torn).drop("_is_torn")


def read_raw(spark: SparkSession, raw_dir: str, source: str) -> DataFrame:
    """The sound records of a landed source; the others' folder is not read."""
    return _landed(spark, raw_dir, source, False).drop(TORN)


def read_torn(spark: SparkSession, raw_dir: str, source: str) -> DataFrame:
    """The torn records: ``record``, their text, and ``reject_reason``."""
    return _landed(spark, raw_dir, source, True).select(F.col(TORN).alias("record"), F.lit(TORN_REASON).alias("reject_reason"))


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Replace a derived table. Spark decides the file count; nothing is coalesced."""
    writer = df.write.mode("overwrite")
    keys = list(partition_by)
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Replace a small report: a handful of rows, one JSON object each."""
    df.write.mode("overwrite").json(path)
