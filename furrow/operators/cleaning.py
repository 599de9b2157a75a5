"""Raw source frames to typed, keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions.text import MISSING_SENTINEL, area_key, number_in, whole
from furrow.sources.files import strip_headers


def clean_yield(raw: DataFrame) -> DataFrame:
    """Yields are whole hectograms; a fractional one is null here and rejected by the gate."""
    named = strip_headers(raw)
    return named.select(
        F.col("Area").alias("area"),
        F.col("Item").alias("crop"),
        whole(number_in(named, "Year"), "int").alias("year"),
        whole(number_in(named, "Value"), "long").alias("yield_hg_ha"),
        area_key(F.col("Area")).alias("area_key"),
    )


def clean_pesticides(raw: DataFrame) -> DataFrame:
    named = strip_headers(raw)
    return named.select(
        F.col("Area").alias("area"),
        whole(number_in(named, "Year"), "int").alias("year"),
        number_in(named, "Value").alias("pesticides_tonnes"),
        area_key(F.col("Area")).alias("area_key"),
    )


def clean_rainfall(raw: DataFrame) -> DataFrame:
    named = strip_headers(raw)
    return named.select(
        F.col("Area").alias("area"),
        whole(number_in(named, "Year"), "int").alias("year"),
        number_in(named, "average_rain_fall_mm_per_year", MISSING_SENTINEL).alias("rainfall_mm"),
        area_key(F.col("Area")).alias("area_key"),
    )


def clean_temp(raw: DataFrame) -> DataFrame:
    """The mean reading of each area key and year. Equal rows are one reading; of several
    spellings of a key the first in order names it. Readings are added up by the country as
    it is written, so that a key is made once for each and not for every reading."""
    named = strip_headers(raw)
    reading = number_in(named, "avg_temp")
    written = named.distinct().groupBy("country", "year").agg(F.sum(reading).alias("_sum"), F.count(reading).alias("_n"))
    keyed = written.select(
        F.col("country").alias("area"),
        whole(number_in(written, "year"), "int").alias("year"),
        "_sum", "_n",
        area_key(F.col("country")).alias("area_key"),
    )
    mean = F.try_divide(F.sum("_sum"), F.sum("_n"))
    return keyed.groupBy("area_key", "year").agg(F.min("area").alias("area"), mean.alias("avg_temp_c"))


def mean_temp_with_repeats(raw: DataFrame) -> DataFrame:
    """Variant by area name: repeated readings all count."""
    named = strip_headers(raw)
    readings = named.select(
        F.col("country").alias("area"),
        whole(number_in(named, "year"), "int").alias("year"),
        number_in(named, "avg_temp").alias("avg_temp_c"),
    )
    return readings.groupBy("area", "year").agg(F.avg("avg_temp_c").alias("avg_temp_c"))
