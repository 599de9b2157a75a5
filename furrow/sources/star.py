"""The star schema: two dimensions, two context tables and the yield facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.operators.integrity import constraint_violations
from furrow.operators.ordered import dense_ids, running_totals
from furrow.sources.files import write_table

TABLES = ("region", "crop", "weather_observation", "agricultural_practice_observation", "yield_observation")


def one_row_per_region_year(curated: DataFrame, *values: str) -> DataFrame:
    """The context values of each area and year; they do not depend on the crop."""
    kept = F.min(F.struct(*values)).alias("_kept")
    return curated.groupBy("area", "year").agg(kept).select("area", "year", "_kept.*")


def build_star(curated: DataFrame) -> dict[str, DataFrame]:
    region = dense_ids(curated.withColumnRenamed("area", "region_name"), "region_name", "region_id")
    crop = dense_ids(curated.withColumnRenamed("crop", "crop_name"), "crop_name", "crop_id")
    by_area = region.withColumnRenamed("region_name", "area")
    by_crop = crop.withColumnRenamed("crop_name", "crop")
    context = one_row_per_region_year(curated, "rainfall_mm", "avg_temp_c", "pesticides_tonnes").join(by_area, "area")
    return {
        "region": region,
        "crop": crop,
        "weather_observation": context.select("region_id", "year", "rainfall_mm", "avg_temp_c"),
        "agricultural_practice_observation": context.select("region_id", "year", "pesticides_tonnes"),
        "yield_observation": curated.join(by_area, "area").join(by_crop, "crop").select("region_id", "crop_id", "year", "yield_hg_ha"),
    }


def number_facts(facts: DataFrame) -> DataFrame:
    """The facts with a dense ``yield_id`` in key order. Kept apart from the load:
    the natural key identifies a fact, and numbering sorts the whole table."""
    ranked = running_totals(facts.withColumn("_one", F.lit(1).cast("long")), ["region_id", "crop_id", "year"], ["_one"])
    return ranked.select((F.col("_one_before") + 1).alias("yield_id"), *facts.columns)


def write_star(star: Mapping[str, DataFrame], folder: str) -> None:
    """Facts lie in a folder per crop, as most questions name one, and by region and year
    inside; a crop with very many of them is cut into several files by the range shuffle."""
    for name, table in star.items():
        if name == "yield_observation":
            table = table.repartitionByRange("crop_id", "region_id", "year").sortWithinPartitions("crop_id", "region_id", "year")
            write_table(table, f"{folder}/{name}", ["crop_id"])
        else:
            write_table(table, f"{folder}/{name}")


def read_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    star = {name: spark.read.parquet(f"{folder}/{name}") for name in TABLES}
    # A folder's name has no type of its own, so it is read as what the crops' ids are.
    found = star["yield_observation"].schema
    shape = T.StructType([T.StructField(f.name, star["crop"].schema["crop_id"].dataType if f.name == "crop_id" else f.dataType) for f in found])
    facts = spark.read.schema(shape).parquet(f"{folder}/yield_observation")
    return star | {"yield_observation": facts.select("region_id", "crop_id", "year", "yield_hg_ha")}


def register_star(star: Mapping[str, DataFrame]) -> None:
    for name, table in star.items():
        table.createOrReplaceTempView(name)


def star_violations(star: Mapping[str, DataFrame]) -> DataFrame:
    return constraint_violations(
        star,
        unique=[
            ("region", ["region_id"]), ("region", ["region_name"]),
            ("crop", ["crop_id"]), ("crop", ["crop_name"]),
            ("weather_observation", ["region_id", "year"]),
            ("agricultural_practice_observation", ["region_id", "year"]),
            ("yield_observation", ["region_id", "crop_id", "year"]),
        ],
        not_null=[
            ("region", "region_name"), ("crop", "crop_name"),
            ("weather_observation", "year"), ("agricultural_practice_observation", "year"),
            ("yield_observation", "year"), ("yield_observation", "yield_hg_ha"),
        ],
        references=[
            ("weather_observation", "region_id", "region", "region_id"),
            ("agricultural_practice_observation", "region_id", "region", "region_id"),
            ("yield_observation", "region_id", "region", "region_id"),
            ("yield_observation", "crop_id", "crop", "crop_id"),
        ],
    )
