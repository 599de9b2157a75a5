"""Row rules and the gate, over one row per line item (R and E operators)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.operators.integrity import duplicate_row_count, null_counts
from furrow.operators.quality import RULES, inspect, overall_quality
from furrow.plans.bound.registry import bound, rounded
from furrow.plans.bound.tables import HEADERS, KNOWN_SQL, LINE_SQL, Tables, plain
from furrow.plans.curate import SOURCES

# What each rule says, in SQL, with the reasons in rule order.
_YEAR = ("year_out_of_range", "yr < 1600 OR yr > 2026")
RULE_SQL = {
    "yield": [
        ("duplicate_row", "copy > 1"), _YEAR,
        ("non_positive_yield", "TRY_CAST(val AS DOUBLE) <= 0"),
        ("implausible_yield_over_800000_hg_ha", "TRY_CAST(val AS DOUBLE) > 800000"),
        ("unknown_crop_category", f"item IS NULL OR item NOT IN {KNOWN_SQL}"),
        ("unexpected_unit", "unit IS DISTINCT FROM 'hg/ha'"),
    ],
    "pesticides": [("duplicate_row", "copy > 1"), _YEAR, ("negative_pesticide_use", "val < 0")],
    "rainfall": [
        ("duplicate_row", "copy > 1"), _YEAR,
        ("implausible_rainfall", "TRY_CAST(txt AS DOUBLE) < 0 OR TRY_CAST(txt AS DOUBLE) > 15000"),
    ],
    "temp": [("duplicate_row", "copy > 1"), _YEAR, ("implausible_temp", "avg_temp < -90 OR avg_temp > 60")],
}
AREA = {"yield": "Area", "pesticides": "Area", "rainfall": " Area", "temp": "country"}
AREA_SQL = {"yield": "area", "pesticides": "area", "rainfall": "area", "temp": "country"}
ALL_COLUMNS = {
    "yield": "domain_code, domain, area_code, area, element_code, element, item_code, item, year_code, yr, unit, val",
    "pesticides": "domain, area, element, item, yr, unit, val",
    "rainfall": "area, yr, txt",
    "temp": "yr, country, avg_temp",
}


# Every column of a source and its SQL name, for whole-row output.
COLUMNS = {source: dict(zip(HEADERS[source], ALL_COLUMNS[source].split(", "))) for source in ALL_COLUMNS}


def tagged_sql(source: str) -> str:
    marks = ", ".join(f"CASE WHEN {test} THEN '{reason}' END" for reason, test in RULE_SQL[source])
    return f"""SELECT *, concat_ws(';', {marks}) AS reject_reason FROM (
        SELECT *, row_number() OVER (PARTITION BY {ALL_COLUMNS[source]}) AS copy FROM ({plain(LINE_SQL[source])}) lines) numbered"""


def _rule(name: str, source: str, reason: str) -> None:
    sql = f"""SELECT {AREA_SQL[source]} AS area, count(*) AS n FROM ({tagged_sql(source)}) tagged
        WHERE list_contains(string_split(reject_reason, ';'), '{reason}') GROUP BY 1"""

    @bound(name, sql)
    def flagged(t: Tables) -> DataFrame:
        bad = t.gate(source).rejected().where(F.array_contains(F.split("reject_reason", ";"), reason))
        return bad.groupBy(F.col(f"`{AREA[source]}`").alias("area")).agg(F.count(F.lit(1)).alias("n"))


_SLUGS = {
    "yield": ["r1_yield_duplicates", "r2_yield_year", "r3_yield_non_positive", "r4_yield_implausible", "r5_yield_unknown_crop", "r6_yield_unit"],
    "pesticides": ["r7_pesticides_duplicates", "r8_pesticides_year", "r9_pesticides_negative"],
    "rainfall": ["r10_rainfall_duplicates", "r11_rainfall_year", "r12_rainfall_implausible"],
    "temp": ["r13_temp_duplicates", "r14_temp_year", "r15_temp_implausible"],
}
for _source, _names in _SLUGS.items():
    for _name, _r in zip(_names, RULES[_source]):
        _rule(_name, _source, _r.reason)


def _named(df: DataFrame, source: str) -> DataFrame:
    extra = [c for c in ("reject_reason",) if c in df.columns]
    return df.select(*[F.col(f"`{c}`").alias(a) for c, a in COLUMNS[source].items()], *extra)


def _row_checks(source: str) -> None:
    picked = ", ".join(COLUMNS[source].values())
    tagged = tagged_sql(source)

    @bound(f"e4_accepted_{source}", f"SELECT {picked} FROM ({tagged}) tagged WHERE reject_reason = ''")
    def accepted(t: Tables) -> DataFrame:
        return _named(t.gate(source).accepted(), source)

    @bound(f"e3_rejected_with_reasons_{source}", f"SELECT {picked}, reject_reason FROM ({tagged}) tagged WHERE reject_reason <> ''")
    def rejected(t: Tables) -> DataFrame:
        return _named(t.gate(source).rejected(), source)


for _source in SOURCES:
    _row_checks(_source)


_ALL_TAGGED = " UNION ALL ".join(f"SELECT '{s}' AS source, reject_reason FROM ({tagged_sql(s)}) {s}_tagged" for s in SOURCES)


def _reports(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [t.gate(s).report() for s in SOURCES])


@bound("e5_reason_counts", f"""
    SELECT source, reason, count(*) AS n FROM (
        SELECT source, unnest(string_split(reject_reason, ';')) AS reason FROM ({_ALL_TAGGED}) x WHERE reject_reason <> '') y
    GROUP BY source, reason""")
def reason_counts(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [t.gate(s).reason_counts() for s in SOURCES])


_SCORES = f"""SELECT source AS source_name, count(*) AS total_records, count(*) FILTER (WHERE reject_reason = '') AS accepted_records,
       count(*) FILTER (WHERE reject_reason <> '') AS rejected_records,
       round(100.0 * count(*) FILTER (WHERE reject_reason = '') / count(*), 2) AS quality_score_pct
    FROM ({_ALL_TAGGED}) x GROUP BY source"""


@bound("e6_quality_score", f"""
    SELECT *, CASE WHEN quality_score_pct >= 95 THEN 'PASSED' WHEN quality_score_pct >= 80 THEN 'PASSED_WITH_WARNINGS' ELSE 'FAILED' END AS validation_status
    FROM ({_SCORES}) s""")
def quality_scores(t: Tables) -> DataFrame:
    return _reports(t).select("source_name", "total_records", "accepted_records", "rejected_records", "quality_score_pct", "validation_status")


@bound("e7_null_profile", " UNION ALL ".join(
    f"SELECT '{s}' AS source_name, '{header.strip()}' AS column_name, count(*) FILTER (WHERE {column} IS NULL) AS n_null FROM ({plain(LINE_SQL[s])}) {s}_lines"
    for s in SOURCES for header, column in COLUMNS[s].items()))
def null_profile(t: Tables) -> DataFrame:
    told = _reports(t).select("source_name", F.explode("null_counts").alias("column_name", "n_null"))
    return told.withColumn("column_name", F.trim("column_name"))


@bound("e8_every_source", f"""
    SELECT source AS source_name, true AS schema_passed, count(*) AS total_records,
           count(*) FILTER (WHERE reject_reason LIKE '%;%') AS rows_with_two_reasons
    FROM ({_ALL_TAGGED}) x GROUP BY source""")
def every_source(t: Tables) -> DataFrame:
    parts = []
    for source in SOURCES:
        checked = t.gate(source)
        report = checked.report().select("source_name", "schema_passed", "total_records")
        several = checked.rejected().agg(F.count_if(F.contains("reject_reason", F.lit(";"))).alias("rows_with_two_reasons"))
        parts.append(report.withColumn("rows_with_two_reasons", several.scalar()))
    return reduce(DataFrame.unionByName, parts)


@bound("e9_overall_score", f"""
    SELECT CAST(sum(total_records) AS BIGINT) AS overall_total_records, CAST(sum(accepted_records) AS BIGINT) AS overall_accepted_records,
           CAST(sum(rejected_records) AS BIGINT) AS overall_rejected_records,
           round(100.0 * sum(accepted_records) / sum(total_records), 2) AS overall_quality_score_pct
    FROM ({_SCORES}) s""")
def overall_score(t: Tables) -> DataFrame:
    return overall_quality(_reports(t))


@bound("e10_duplicate_counts", " UNION ALL ".join(
    f"SELECT '{s}' AS source, CAST((SELECT count(*) FROM ({plain(LINE_SQL[s])}) a) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({plain(LINE_SQL[s])}) b) c) AS BIGINT) AS duplicate_rows"
    for s in SOURCES))
def duplicate_counts(t: Tables) -> DataFrame:
    parts = [duplicate_row_count(t.raw_lines(s)).select(F.lit(s).alias("source"), "duplicate_rows") for s in SOURCES]
    return reduce(DataFrame.unionByName, parts)


@bound("e2_broken_contract", f"""
    SELECT false AS schema_passed, 'Unit' AS missing, count(*) AS total_records, CAST(0 AS BIGINT) AS accepted_records,
           count(*) AS rejected_records, CAST(0 AS DOUBLE) AS quality_score_pct, 'FAILED' AS validation_status
    FROM ({plain(LINE_SQL["yield"])}) lines""")
def broken_contract(t: Tables) -> DataFrame:
    report = inspect(t.raw_lines("yield").drop("Unit"), "yield").report()
    return report.withColumn("missing", F.concat_ws(",", "schema_missing_columns")).select(
        "schema_passed", "missing", "total_records", "accepted_records", "rejected_records", "quality_score_pct", "validation_status"
    )


@bound("e2_broken_contract_quarantine", f"""
    SELECT reject_reason, count(*) AS n FROM (
        SELECT 'schema_validation_failed' AS reject_reason FROM ({plain(LINE_SQL["temp"])}) lines) x GROUP BY 1""")
def broken_contract_rows(t: Tables) -> DataFrame:
    bad = inspect(t.raw_lines("temp").drop("avg_temp"), "temp").rejected()
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@bound("e7_raw_nulls_by_column", "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in COLUMNS["yield"].values()) + f"""
    FROM ({plain(LINE_SQL["yield"])}) lines""")
def raw_nulls(t: Tables) -> DataFrame:
    return null_counts(t.raw_lines("yield")).select(*[F.col(f"`{header}`").alias(c) for header, c in COLUMNS["yield"].items()])


@bound("s9_quarantine_by_source", f"""
    SELECT source, reject_reason, count(*) AS n FROM ({_ALL_TAGGED}) x WHERE reject_reason <> '' GROUP BY 1, 2""")
def quarantine(t: Tables) -> DataFrame:
    parts = [t.gate(s).rejected().select(F.lit(s).alias("source"), "reject_reason") for s in SOURCES]
    return reduce(DataFrame.unionByName, parts).groupBy("source", "reject_reason").agg(F.count(F.lit(1)).alias("n"))
