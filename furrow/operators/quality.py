"""Row rules and the accept-or-quarantine gate.

A rule is a reason and an expression that is true for an *invalid* row. A rule
that cannot be decided (null) does not reject, except where the rule itself
says that null is invalid.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.functions.text import MISSING_SENTINEL, number_in
from furrow.sources.contracts import check_contract
from furrow.sources.files import write_table


# The bounds and categories rows are held against.
EARLIEST_YEAR = 1600
LATEST_YEAR = 2026
HIGHEST_YIELD_HG_HA = 800_000
HIGHEST_RAINFALL_MM = 15_000
LOWEST_TEMP_C = -90
HIGHEST_TEMP_C = 60
YIELD_UNIT = "hg/ha"
KNOWN_CROPS = (
    "Maize", "Potatoes", "Rice, paddy", "Wheat", "Sorghum",
    "Soybeans", "Cassava", "Yams", "Sweet potatoes", "Plantains and others",
)
PASS_AT, WARN_AT = 95, 80

DUPLICATE = "duplicate_row"
BROKEN_CONTRACT = "schema_validation_failed"


def _parsed_name(name: str, sentinel: str | None) -> str:
    return f"_number_of_{name}_{sentinel or ''}"


class Fields:
    """The columns of a source by their stripped names, so a padded header still matches."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows
        self.names = {c.strip(): c for c in rows.columns}
        self.asked: dict[tuple[str, str | None], None] = {}

    def __call__(self, name: str) -> Column:
        return F.col(f"`{self.names[name]}`")

    def number(self, name: str, sentinel: str | None = None) -> Column:
        """The column as a number, null where it holds none; the one parsed before, if it was."""
        self.asked[name, sentinel] = None
        parsed = _parsed_name(name, sentinel)
        return F.col(f"`{parsed}`") if parsed in self.names else number_in(self.rows, self.names[name], sentinel)

    def is_text(self, name: str) -> bool:
        return not isinstance(self.rows.schema[self.names[name]].dataType, T.NumericType)


@dataclass(frozen=True)
class Rule:
    """``invalid`` makes the test from the :class:`Fields` of a source. A rule
    without ``invalid`` marks every copy of a row but one."""

    reason: str
    invalid: Callable[[Fields], Column] | None = None


def year_outside(name: str) -> Rule:
    """Also what is no whole number, which the curated table could not hold as a year."""
    return Rule(
        "year_out_of_range",
        lambda c: ~(c.number(name).between(EARLIEST_YEAR, LATEST_YEAR) & (c.number(name) == F.floor(c.number(name)))),
    )


RULES: dict[str, tuple[Rule, ...]] = {
    "yield": (
        Rule(DUPLICATE),
        year_outside("Year"),
        Rule("non_positive_yield", lambda c: c.number("Value") <= 0),
        Rule("implausible_yield_over_800000_hg_ha", lambda c: c.number("Value") > HIGHEST_YIELD_HG_HA),
        Rule("unknown_crop_category", lambda c: ~F.coalesce(c("Item").isin(*KNOWN_CROPS), F.lit(False))),
        Rule("unexpected_unit", lambda c: ~c("Unit").eqNullSafe(YIELD_UNIT)),
    ),
    "pesticides": (
        Rule(DUPLICATE),
        year_outside("Year"),
        Rule("negative_pesticide_use", lambda c: c.number("Value") < 0),
    ),
    "rainfall": (
        Rule(DUPLICATE),
        year_outside("Year"),
        Rule(
            "implausible_rainfall",
            lambda c: ~c.number("average_rain_fall_mm_per_year", MISSING_SENTINEL).between(0, HIGHEST_RAINFALL_MM),
        ),
    ),
    "temp": (
        Rule(DUPLICATE),
        year_outside("year"),
        Rule("implausible_temp", lambda c: ~c.number("avg_temp").between(LOWEST_TEMP_C, HIGHEST_TEMP_C)),
    ),
}


#: Beyond the rules above: what the curated types could only hold by cutting it off.
MORE_RULES: dict[str, tuple[Rule, ...]] = {
    "yield": (
        Rule("fractional_yield", lambda c: (F.abs(c.number("Value")) < 1e15) & (c.number("Value") != F.floor(c.number("Value")))),
    ),
}


def reasons(rules: Sequence[Rule], fields: Fields, is_copy: bool) -> Column:
    """All reasons that apply, in rule order, joined by ``;``; empty if none does."""
    marks = [F.when(F.lit(is_copy) if r.invalid is None else r.invalid(fields), F.lit(r.reason)) for r in rules]
    return F.concat_ws(";", *marks)


def repeat_rows(df: DataFrame, times: str, block: int = 100_000) -> DataFrame:
    """Each row ``times`` over. A row with very many copies is cut into blocks
    that are spread over the tasks before they are written out."""
    keys = [f"`{c}`" for c in df.columns if c != times]
    count = F.col(times)
    blocks = df.where(count > 0).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((count - 1) / F.lit(block)))).alias("_block")
    )
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        blocks.repartition(tasks, F.xxhash64(*keys), F.col("_block"))
        .withColumn("_size", F.least(F.lit(block).cast("long"), count - F.col("_block") * block))
        .select(*keys, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_size"))).alias("_again"))
        .drop("_again")
    )


@dataclass(frozen=True)
class Inspection:
    """The outcome of the gate for one source.

    ``rows`` holds each distinct row once with ``_copies``, how often it came,
    and ``_reasons``, what its first copy fails. Copies are folded before
    the shuffle, so a row repeated a billion times costs one row.
    """

    source: str
    columns: tuple[str, ...]
    rules: tuple[Rule, ...]
    rows: DataFrame
    missing: tuple[str, ...] = ()

    def settled(self, path: str) -> Inspection:
        """The same outcome read back from a written table, for jobs that use
        the accepted rows, the quarantine and the report."""
        write_table(self.rows, path)
        return Inspection(self.source, self.columns, self.rules, self.rows.sparkSession.read.parquet(path), self.missing)

    @property
    def _drops_copies(self) -> bool:
        return not self.missing and any(r.invalid is None for r in self.rules)

    def _sound(self) -> Column:
        """No reason applies, said of the columns, so that what is asked of numeric ones
        is asked before the rows are folded."""
        if self.missing:
            return F.lit(False)
        fields = Fields(self.rows)
        held = [~F.coalesce(r.invalid(fields), F.lit(False)) for r in self.rules if r.invalid is not None]
        return reduce(Column.__and__, held, F.lit(True))

    def accepted(self) -> DataFrame:
        """Valid rows with their original columns."""
        valid = self.rows.where(self._sound())
        if self._drops_copies:
            return valid.select(*_quoted(self.columns))
        return repeat_rows(valid.select(*_quoted(self.columns), "_copies"), "_copies")

    def _parts(self) -> DataFrame:
        """Rejected rows as (row, reasons, how many): the first copy, then the others."""
        kept = _quoted(self.columns)
        if not self._drops_copies:
            return self.rows.where(F.col("_reasons") != "").select(
                *kept, F.col("_reasons").alias("reject_reason"), F.col("_copies").alias("_times")
            )
        first = F.struct(F.col("_reasons").alias("why"), F.lit(1).cast("long").alias("times"))
        extra = F.struct(
            reasons(self.rules, Fields(self.rows), is_copy=True).alias("why"), (F.col("_copies") - 1).alias("times")
        )
        parts = F.when(F.col("_copies") > 1, F.array(first, extra)).otherwise(F.array(first))
        return (
            self.rows.where((F.col("_reasons") != "") | (F.col("_copies") > 1))
            .select(*kept, F.explode(parts).alias("_part"))
            .select(*kept, F.col("_part.why").alias("reject_reason"), F.col("_part.times").alias("_times"))
            .where(F.col("reject_reason") != "")
        )

    def rejected(self) -> DataFrame:
        """Quarantined rows, copies and all, with ``reject_reason``."""
        return repeat_rows(self._parts(), "_times")

    def reason_counts(self) -> DataFrame:
        """How many rows each reason rejected; a row with two reasons counts in both."""
        each = self._parts().groupBy("reject_reason").agg(F.sum("_times").alias("_times"))
        single = each.select(F.explode(F.split("reject_reason", ";")).alias("reason"), "_times")
        return single.groupBy("reason").agg(F.sum("_times").alias("n")).select(F.lit(self.source).alias("source"), "reason", "n")

    def report(self) -> DataFrame:
        """One row of counts, score, status and per-column nulls of the raw rows."""
        first_ok = F.col("_reasons") == ""
        accepted = F.when(first_ok, F.lit(1) if self._drops_copies else F.col("_copies")).otherwise(0)
        if self.missing:
            per_reason = [(BROKEN_CONTRACT, F.col("_copies"))]
        else:
            fields = Fields(self.rows)
            per_reason = [
                (r.reason, F.col("_copies") - 1 if r.invalid is None else F.when(r.invalid(fields), F.col("_copies")))
                for r in self.rules
            ]
        nulls = {c: F.sum(F.when(F.col(f"`{c}`").isNull(), F.col("_copies")).otherwise(0)) for c in self.columns}
        tally = self.rows.agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).cast("long").alias("total_records"),
            F.coalesce(F.sum(accepted), F.lit(0)).cast("long").alias("accepted_records"),
            _count_map({reason: F.sum(n) for reason, n in per_reason}).alias("rejection_reason_counts"),
            _count_map(nulls, keep_zero=True).alias("null_counts"),
        )
        return tally.select(
            F.lit(self.source).alias("source_name"),
            F.lit(not self.missing).alias("schema_passed"),
            F.array(*[F.lit(m) for m in self.missing]).cast("array<string>").alias("schema_missing_columns"),
            "total_records",
            "accepted_records",
            (F.col("total_records") - F.col("accepted_records")).alias("rejected_records"),
            quality_score(F.col("accepted_records"), F.col("total_records")).alias("quality_score_pct"),
            "rejection_reason_counts",
            (F.create_map().cast("map<string,bigint>") if self.missing else F.col("null_counts")).alias("null_counts"),
            quality_status(F.col("accepted_records"), F.col("total_records"), not self.missing).alias("validation_status"),
        )


def _quoted(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def _count_map(counts: Mapping[str, Column], keep_zero: bool = False) -> Column:
    pairs = [part for name, n in counts.items() for part in (F.lit(name), F.coalesce(n, F.lit(0)).cast("long"))]
    whole = F.create_map(*pairs)
    return whole if keep_zero else F.map_filter(whole, lambda _, n: n > 0)


def quality_score(accepted: Column, total: Column) -> Column:
    """Accepted share in percent to two places; 0 for an empty source."""
    return F.coalesce(F.bround(F.try_divide(F.lit(100.0) * accepted, total), 2), F.lit(0.0))


def quality_status(accepted: Column, total: Column, contract_met: bool = True) -> Column:
    if not contract_met:
        return F.lit("FAILED")
    score = quality_score(accepted, total)
    return F.when(score >= PASS_AT, "PASSED").when(score >= WARN_AT, "PASSED_WITH_WARNINGS").otherwise("FAILED")


def inspect(df: DataFrame, source: str, rules: Sequence[Rule] | None = None, to_settle: bool = False) -> Inspection:
    """Hold every row of ``df`` against the contract and rules of ``source``. An outcome that
    is ``to_settle`` is written whole, so its texts are parsed once a distinct row, after the
    fold."""
    rules = (*RULES[source], *MORE_RULES.get(source, ())) if rules is None else tuple(rules)
    columns = tuple(df.columns)
    copies = F.count(F.lit(1)).alias("_copies")
    contract = check_contract(columns, source)
    if not contract.passed:
        folded = df.groupBy(*_quoted(columns)).agg(copies)
        return Inspection(source, columns, rules, folded.withColumn("_reasons", F.lit(BROKEN_CONTRACT)), contract.missing)
    # A text is parsed once a row, inside the fold. As an aggregate it also keeps a filter
    # on the reasons above the fold, where it would otherwise be pushed down with every
    # parse written out again. A numeric column is read off the folded row: nothing of it is
    # shuffled twice, and filters on it go below the fold.
    fields = Fields(df)
    reasons(rules, fields, is_copy=False)
    parsed = {_parsed_name(n, sentinel): (fields.names[n], sentinel) for n, sentinel in fields.asked if fields.is_text(n)}
    if to_settle:
        folded = df.groupBy(*_quoted(columns)).agg(copies)
        folded = folded.withColumns({name: number_in(folded, *of) for name, of in parsed.items()})
    else:
        folded = df.groupBy(*_quoted(columns)).agg(copies, *[F.max(number_in(df, *of)).alias(name) for name, of in parsed.items()])
    return Inspection(source, columns, rules, folded.withColumn("_reasons", reasons(rules, Fields(folded), is_copy=False)))


def overall_quality(reports: DataFrame) -> DataFrame:
    """Totals and score across the sources of ``reports``."""
    sums = reports.agg(
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("overall_total_records"),
        F.coalesce(F.sum("accepted_records"), F.lit(0)).alias("overall_accepted_records"),
    )
    return sums.select(
        "overall_total_records",
        "overall_accepted_records",
        (F.col("overall_total_records") - F.col("overall_accepted_records")).alias("overall_rejected_records"),
        quality_score(F.col("overall_accepted_records"), F.col("overall_total_records")).alias("overall_quality_score_pct"),
    )
