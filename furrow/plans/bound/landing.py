"""Landing, sinks, the batch and its history over CSV copies of the sources (S and O)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.models import regression
from furrow.plans.batch import last_failure, latest_runs, read_history, record_run, run_batch
from furrow.plans.bound.gate import COLUMNS, RULE_SQL, tagged_sql
from furrow.plans.bound.registry import bound, rounded
from furrow.plans.bound.tables import CURATED_CTES, LINE_SQL, SOURCE_SQL, TRAIN_CTES, Tables, on_curated, plain
from furrow.plans.curate import SOURCES
from furrow.session import scratch_path
from furrow.sources.files import land_all, read_manifest, read_raw, read_torn, scan_typed, strip_headers, write_report, write_table


#: Headed, blanks kept as they are.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _copies(t: Tables, rows) -> dict[str, str]:
    """Each source as a folder of headed CSV files."""
    home, paths = scratch_path(t.spark, "incoming"), {}
    for source in SOURCES:
        paths[source] = f"{home}/{source}"
        rows(source).write.csv(paths[source], **CSV)
    return paths


# ---- landing ------------------------------------------------------------------------------

_COUNTED = " UNION ALL ".join(
    f"SELECT '{s}' AS source_name, {len(COLUMNS[s])}::BIGINT AS n_columns, count(*) AS record_count FROM ({plain(LINE_SQL[s])}) {s}_lines" for s in SOURCES
)


@bound("s4_receipts", _COUNTED)
def s4(t: Tables) -> DataFrame:
    raw = scratch_path(t.spark, "raw")
    land_all(t.spark, _copies(t, t.raw_lines), raw)
    return read_manifest(t.spark, raw).select("source_name", F.size("columns").alias("n_columns"), "record_count")


@bound("s5_landed_rows", "SELECT area, yr, txt, count(*) AS n FROM (" + plain(LINE_SQL["rainfall"]) + ") r GROUP BY 1, 2, 3")
def s5(t: Tables) -> DataFrame:
    raw = scratch_path(t.spark, "raw")
    land_all(t.spark, _copies(t, t.raw_lines), raw)
    named = strip_headers(read_raw(t.spark, raw, "rainfall")).select(
        F.col("Area").alias("area"), F.col("Year").cast("long").alias("yr"), F.col("average_rain_fall_mm_per_year").alias("txt")
    )
    return named.groupBy("area", "yr", "txt").agg(F.count(F.lit(1)).alias("n"))


@bound("s1_typed_scan", f"""
    SELECT count(*) AS n, count(item) AS n_item, CAST(sum(yr) AS BIGINT) AS years, count(TRY_CAST(val AS DOUBLE)) AS n_value, sum(TRY_CAST(val AS DOUBLE)) AS total
    FROM ({plain(LINE_SQL["yield"])}) lines""")
def s1(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "incoming")
    t.raw_lines("yield").write.csv(path, **CSV)
    return scan_typed(t.spark, path, "yield").agg(
        F.count(F.lit(1)).alias("n"), F.count("Item").alias("n_item"), F.sum("Year").alias("years"), F.count("Value").alias("n_value"), F.sum("Value").alias("total")
    )


@bound("s6_bad_sources_are_skipped", f"SELECT source_name, true AS landed, record_count, CAST(0 AS BIGINT) AS torn_count FROM ({_COUNTED}) c UNION ALL SELECT 'absent', false, NULL, NULL")
def s6(t: Tables) -> DataFrame:
    given = _copies(t, t.raw_lines) | {"absent": scratch_path(t.spark, "nothing-here")}
    return land_all(t.spark, given, scratch_path(t.spark, "raw")).select("source_name", "landed", "record_count", "torn_count")


@bound("s7_repeated_load_counts_once", f"SELECT source_name, record_count, CAST(2 AS BIGINT) AS n_loads FROM ({_COUNTED}) c")
def s7(t: Tables) -> DataFrame:
    """Monday's load twice, Tuesday's once: two loads a source."""
    raw, paths = scratch_path(t.spark, "raw"), _copies(t, t.raw_lines)
    for load in ("monday", "monday", "tuesday"):
        land_all(t.spark, paths, raw, load_id=load)
    return read_manifest(t.spark, raw).groupBy("source_name", "record_count").agg(F.count(F.lit(1)).alias("n_loads"))


# Records with line breaks inside quotes, and records cut off or run together.
_KIND = "CASE WHEN l_linenumber = 5 THEN 'short' WHEN l_linenumber = 6 THEN 'long' WHEN l_linenumber = 4 THEN 'break' ELSE 'plain' END"
_TEXTS = f"SELECT l_orderkey, l_linenumber, s_name, CAST(l_quantity AS BIGINT) AS q, {_KIND} AS kind FROM {{lineitem}} l JOIN {{supplier}} s ON l_suppkey = s_suppkey"


@bound("s2_torn_and_multiline", f"""
    SELECT CASE WHEN kind IN ('short', 'long') THEN 'torn_record' ELSE 'landed' END AS went, CASE kind WHEN 'break' THEN true WHEN 'plain' THEN false END AS has_break,
           CASE kind WHEN 'short' THEN s_name WHEN 'long' THEN s_name || ',' || q || ',tail' END AS record,
           CAST(sum(CASE WHEN kind IN ('plain', 'break') THEN q END) AS BIGINT) AS total, count(*) AS n
    FROM ({plain(_TEXTS)}) x GROUP BY 1, 2, 3""")
def s2(t: Tables) -> DataFrame:
    line = F.expr("""CASE kind WHEN 'short' THEN s_name WHEN 'long' THEN concat(s_name, ',', q, ',tail')
        WHEN 'break' THEN concat('"', s_name, '\\nof many"', ',', q) ELSE concat(s_name, ',', q) END""")
    # One folder a part, each written by one task, its header first.
    lines = t.sql(_TEXTS).select(F.pmod(F.col("l_orderkey"), F.lit(8)).alias("part"), F.lit(1).alias("at"), line.alias("value"))
    heads = t.spark.range(8).select(F.col("id").alias("part"), F.lit(0).alias("at"), F.lit("name,quantity").alias("value"))
    path, raw = scratch_path(t.spark, "incoming"), scratch_path(t.spark, "raw")
    lines.unionByName(heads).repartition("part").sortWithinPartitions("part", "at").select("part", "value").write.partitionBy("part").text(path)
    land_all(t.spark, {"names": f"{path}/*"}, raw, multiline=["names"])
    none = F.lit(None).cast("string")
    sound = read_raw(t.spark, raw, "names").select(
        F.lit("landed").alias("went"), F.contains("name", F.lit("\n")).alias("has_break"), none.alias("record"), F.col("quantity").cast("long").alias("q")
    )
    torn = read_torn(t.spark, raw, "names").select(
        F.col("reject_reason").alias("went"), F.lit(None).cast("boolean").alias("has_break"), F.trim("record", F.lit("\n")).alias("record"), F.lit(None).cast("long").alias("q")
    )
    return sound.unionByName(torn).groupBy("went", "has_break", "record").agg(F.sum("q").alias("total"), F.count(F.lit(1)).alias("n"))


# ---- sinks --------------------------------------------------------------------------------

@bound("s8_curated_sink", on_curated("SELECT area, crop, year, yield_hg_ha, pesticides_tonnes, rainfall_mm, round(avg_temp_c, 6) AS avg_temp_c FROM curated"))
def s8(t: Tables) -> DataFrame:
    """Written twice: the second replaces the first."""
    path = scratch_path(t.spark, "curated")
    for _ in range(2):
        write_table(t.settled, path)
    return rounded(t.spark.read.parquet(path).select("area", "crop", "year", "yield_hg_ha", "pesticides_tonnes", "rainfall_mm", "avg_temp_c"), 6, "avg_temp_c")


_SCORES = " UNION ALL ".join(
    f"SELECT '{s}' AS source_name, count(*) AS total_records, count(*) FILTER (WHERE reject_reason = '') AS accepted_records FROM ({tagged_sql(s)}) {s}_tagged" for s in SOURCES
)


@bound("s10_report_sink", _SCORES)
def s10(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "report")
    told = reduce(DataFrame.unionByName, [t.gate(s).report() for s in SOURCES])
    write_report(told, path)
    return t.spark.read.schema(told.schema).json(path).select("source_name", "total_records", "accepted_records")


@bound("m23_model_card", on_curated(f"""
    SELECT 'LinearRegressionModel' AS algorithm, 12 + count(DISTINCT crop) AS n_features, count(*) AS training_rows, min(year) AS first_year, max(year) AS last_year,
           (SELECT count(*) FROM test) AS n_test FROM train""", TRAIN_CTES))
def m23(t: Tables) -> DataFrame:
    """The card as it is written and read back."""
    path = scratch_path(t.spark, "card")
    train, test = t.features
    model = regression.linear(train, t.stats.names)
    card = regression.model_card(model, t.stats, train, model.transform(test))
    write_report(card, path)
    return t.spark.read.schema(card.schema).json(path).select(
        "algorithm", F.size("feature_columns").alias("n_features"), "training_rows", F.col("training_year_range")[0].alias("first_year"),
        F.col("training_year_range")[1].alias("last_year"), F.col("test_metrics_at_training_time.n").alias("n_test"),
    )


# ---- the batch ----------------------------------------------------------------------------

def _cells_tagged(source: str) -> str:
    """The gate over the cells that the curated table is made from."""
    marks = ", ".join(f"CASE WHEN {test} THEN '{reason}' END" for reason, test in RULE_SQL[source])
    keys = ", ".join(COLUMNS[source].values())
    return f"SELECT *, concat_ws(';', {marks}) AS reject_reason FROM (SELECT *, row_number() OVER (PARTITION BY {keys}) AS copy FROM ({plain(SOURCE_SQL[source])}) c) n"


_RECEIVED = " UNION ALL ".join(f"SELECT '{s}' AS source, reject_reason FROM ({_cells_tagged(s)}) {s}_cells" for s in SOURCES)
_RUN_SQL = f"""SELECT status, records_received, records_accepted, records_rejected, overall_quality_score_pct, curated_rows FROM (
    SELECT 'SUCCESS' AS status, count(*) AS records_received, count(*) FILTER (WHERE reject_reason = '') AS records_accepted,
           count(*) FILTER (WHERE reject_reason <> '') AS records_rejected, round(100.0 * count(*) FILTER (WHERE reject_reason = '') / count(*), 2) AS overall_quality_score_pct,
           (SELECT count(*) FROM curated) AS curated_rows FROM ({_RECEIVED}) r) s"""
_TOLD = ("status", "records_received", "records_accepted", "records_rejected", "overall_quality_score_pct", "curated_rows")


@bound("o1_batch_to_history", f"WITH {CURATED_CTES} {_RUN_SQL}")
def o1(t: Tables) -> DataFrame:
    """The whole batch over CSV copies, recorded, and its row of the history."""
    home, history = scratch_path(t.spark, "home"), scratch_path(t.spark, "history")
    record_run(t.spark, history, lambda: run_batch(t.spark, _copies(t, t.raw), home))
    return read_history(t.spark, history).select(*_TOLD)


@bound("o1_batch_curated", on_curated("SELECT area, crop, year, yield_hg_ha, pesticides_tonnes, rainfall_mm, round(avg_temp_c, 6) AS avg_temp_c FROM curated"))
def o1_curated(t: Tables) -> DataFrame:
    home = scratch_path(t.spark, "home")
    run_batch(t.spark, _copies(t, t.raw), home)
    columns = ("area", "crop", "year", "yield_hg_ha", "pesticides_tonnes", "rainfall_mm", "avg_temp_c")
    return rounded(t.spark.read.parquet(f"{home}/processed/curated").select(*columns), 6, "avg_temp_c")


@bound("o3_stage_counts", f"""
    WITH {CURATED_CTES} SELECT 'ingestion' AS stage, count(*) AS n FROM ({_RECEIVED}) r
    UNION ALL SELECT 'data_quality', count(*) FROM ({_RECEIVED}) r WHERE reject_reason = '' UNION ALL SELECT 'transform', count(*) FROM curated
    UNION ALL SELECT 'sql_load', count(*) FROM curated""")
def o3(t: Tables) -> DataFrame:
    """Rows that each stage says it passed on."""
    batch = run_batch(t.spark, _copies(t, t.raw), scratch_path(t.spark, "home"))
    detail = {s.stage: s.detail for s in batch}
    rows = [
        ("ingestion", sum(detail["ingestion"]["records"].values())),
        ("data_quality", sum(d["accepted"] for d in detail["data_quality"].values())),
        ("transform", detail["transform"]["curated_rows"]),
        ("sql_load", detail["sql_load"]["rows"]["yield_observation"]),
    ]
    return t.spark.createDataFrame(rows, "stage string, n long")


@bound("o4_failed_then_repeated_run", f"""
    WITH {CURATED_CTES} SELECT 'monday' AS run_id, false AS has_error, * FROM ({_RUN_SQL}) a
    UNION ALL SELECT 'tuesday', true, 'FAILED', (SELECT count(*) FROM ({_RECEIVED}) r WHERE source <> 'temp'), NULL, NULL, NULL, NULL""")
def o4(t: Tables) -> DataFrame:
    """Monday's run fails and is repeated: one row. Tuesday's stays failed, with what it had counted."""
    history, paths = scratch_path(t.spark, "history"), _copies(t, t.raw)
    short = {s: p for s, p in paths.items() if s != "temp"}
    for run_id, given in (("monday", short), ("monday", paths), ("tuesday", short)):
        home = scratch_path(t.spark, "home")
        try:
            record_run(t.spark, history, lambda given=given, home=home: run_batch(t.spark, given, home, load_id=run_id), run_id)
        except FileNotFoundError:
            continue
    return read_history(t.spark, history).select("run_id", F.col("error_message").isNotNull().alias("has_error"), *_TOLD)


@bound("t6_most_recent", """
    SELECT CAST(o_orderkey AS VARCHAR) AS run_id, 'latest' AS asked FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) LIMIT 10) a
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'failure' FROM (SELECT * FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) LIMIT 1) b""")
def t6(t: Tables) -> DataFrame:
    """Orders stand for runs: their date for the start, status F for a failure."""
    runs = t.table("orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderdate").cast("string").alias("started_at"), F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS").alias("status")
    )
    newest = latest_runs(runs, 10).select("run_id", F.lit("latest").alias("asked"))
    return newest.unionByName(last_failure(runs).select("run_id", F.lit("failure").alias("asked")))
