"""The corpus pipeline: five stages over ``documents``, each written and read again.

Each stage keeps all columns. Null and empty texts pass the first four unchanged unless
the toxicity model scores an empty text 0.5 or more; null ids are no ground to drop a
row. An empty table gives an empty one in the stages that learn nothing from labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from furrow.llm import decontaminate, entries, mixing, ngram_join, pii, toxicity
from furrow.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5 stay."""
    return toxicity.clean_rows(docs, entries.toxicity_model(spark, sf_dir))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, 80 %."""
    return ngram_join.one_of_each(docs, k=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark stay."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, with personal data replaced by its kind."""
    return pii.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources; a document stands in it as often as it is taken."""
    return mixing.mixed_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("PII", mask_private),
    ("mixing sources to target weights", mix_sources),
]

#: The learned stages have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are written before the next one reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
