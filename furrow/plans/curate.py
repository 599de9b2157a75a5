"""From raw or accepted source frames to the curated table and its report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.operators.cleaning import clean_pesticides, clean_rainfall, clean_temp, clean_yield
from furrow.operators.integrity import duplicate_row_count, match_rates, null_counts
from furrow.operators.joining import merge_by_name, merge_sources
from furrow.operators.quality import inspect
from furrow.sources.files import read_raw

SOURCES = ("yield", "pesticides", "rainfall", "temp")
MATCHED = {
    "pesticides_tonnes": "pesticides_matched_pct",
    "rainfall_mm": "rainfall_matched_pct",
    "avg_temp_c": "avg_temp_matched_pct",
}


def curate(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per accepted yield row, with the context of its area and year."""
    return merge_sources(
        clean_yield(frames["yield"]), clean_pesticides(frames["pesticides"]),
        clean_rainfall(frames["rainfall"]), clean_temp(frames["temp"]),
    )


def accepted_frames(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {source: inspect(frames[source], source).accepted() for source in SOURCES}


def curate_unfiltered(spark: SparkSession, raw_dir: str) -> DataFrame:
    """The curated table straight from the raw zone, without the gate."""
    return curate({source: read_raw(spark, raw_dir, source) for source in SOURCES})


def curate_with_sql(yields: DataFrame, pesticides: DataFrame) -> DataFrame:
    """Yield rows beside pesticide use, joined by name in SQL over views."""
    spark = yields.sparkSession
    yields.createOrReplaceTempView("yield_raw")
    pesticides.createOrReplaceTempView("pesticides_raw")
    return spark.sql("""
        SELECT y.Area AS area, y.Item AS crop, y.Year AS year,
               try_cast(y.Value AS BIGINT) AS yield_hg_ha, try_cast(p.Value AS DOUBLE) AS pesticides_tonnes
        FROM yield_raw y LEFT JOIN pesticides_raw p ON y.Area = p.Area AND y.Year = p.Year""")


def curate_by_name(yields: DataFrame, *sides: DataFrame) -> DataFrame:
    return merge_by_name(yields, sides)


def transform_report(frames: Mapping[str, DataFrame], curated: DataFrame) -> DataFrame:
    """Duplicates and nulls of each source and the match rates, as one row of
    structs. Every part is a single aggregate."""
    duplicates, nulls = [], []
    for source in SOURCES:
        count = duplicate_row_count(frames[source]).scalar()
        duplicates.append(count.alias(source))
        profile = null_counts(frames[source])
        nulls.append(profile.select(F.struct(*[F.col(f"`{c}`") for c in profile.columns])).scalar().alias(source))
    return match_rates(curated, MATCHED).select(
        F.struct(*duplicates).alias("duplicate_rows_found_in_raw"),
        F.struct(*nulls).alias("null_counts_in_raw"),
        F.struct("total_rows", *MATCHED.values()).alias("join_match_rates"),
    )
