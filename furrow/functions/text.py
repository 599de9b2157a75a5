"""Text normalisation and untrusted-number parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formal area names and the common name each one is joined under.
AREA_ALIASES = {
    "lao people's democratic republic": "laos",
    "viet nam": "vietnam",
    "bolivia (plurinational state of)": "bolivia",
    "venezuela (bolivarian republic of)": "venezuela",
    "republic of moldova": "moldova",
    "democratic republic of the congo": "democratic republic of congo",
    "congo": "congo",
    "iran (islamic republic of)": "iran",
    "republic of korea": "south korea",
    "democratic people's republic of korea": "north korea",
    "russian federation": "russia",
    "syrian arab republic": "syria",
    "united republic of tanzania": "tanzania",
    "china, taiwan province of": "taiwan",
    "brunei darussalam": "brunei",
    "the former yugoslav republic of macedonia": "macedonia",
    "united states of america": "united states",
    "united kingdom of great britain and northern ireland": "united kingdom",
    "czechia": "czech republic",
}

# Fixed value: how a source writes "not available".
MISSING_SENTINEL = ".."

BLANKS = " \t\n\r\x0b\x0c"
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))$"


def stripped(col: Column) -> Column:
    return F.trim(col, F.lit(BLANKS))


def area_key(col: Column, aliases: dict[str, str] | None = None) -> Column:
    """Join key of an area name: stripped, lower-cased, formal names made common."""
    known = AREA_ALIASES if aliases is None else aliases
    plain = F.lower(stripped(col))
    if not known:
        return plain
    # One constant that is folded into a literal map when the query is planned.
    pairs = F.lit("\x02".join(f"{formal}\x01{common}" for formal, common in known.items()))
    return F.coalesce(F.str_to_map(pairs, F.lit("\x02"), F.lit("\x01"))[plain], plain)


def with_area_key(df: DataFrame, column: str, aliases: DataFrame, name: str = "area_key") -> DataFrame:
    """As ``area_key``, with the aliases as a table (``formal``, ``common``), which may be long:
    it is sent to every task if it is under the session's threshold, else both sides meet
    by name. An alias given twice counts by its least common name."""
    known = aliases.groupBy(F.lower(stripped(F.col("formal"))).alias("_formal")).agg(F.min("common").alias("_common"))
    keyed = df.withColumn("_plain", F.lower(stripped(F.col(column))))
    found = keyed.join(known, keyed["_plain"] == known["_formal"], "left")
    return found.withColumn(name, F.coalesce("_common", "_plain")).drop("_plain", "_formal", "_common")


def number_or_null(col: Column, sentinel: str | None = MISSING_SENTINEL) -> Column:
    """The number a text column holds; null for the sentinel and for anything unreadable."""
    text = stripped(col.cast("string"))
    if sentinel is not None:
        text = F.nullif(text, F.lit(sentinel))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def whole(number: Column, kind: str) -> Column:
    """A number as an integer type; null if it is no whole number or does not fit.
    Nothing is ever cut off."""
    return F.when(number == F.floor(number), number.try_cast(kind))


def number_in(df: DataFrame, name: str, sentinel: str | None = None) -> Column:
    """Column ``name`` of ``df`` as a number. A column that is numeric already is
    taken as it is, with NaN, which marks a missing value in some inputs, as null."""
    col = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return F.when(~F.isnan(col), col.cast("double"))
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    return number_or_null(col, sentinel)
