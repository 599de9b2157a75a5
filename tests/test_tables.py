from datetime import datetime

from furrow.operators.quality import inspect
from furrow.plans.bound.tables import HEADERS, SOURCE_SQL, Tables


def given(spark, folder):
    when = [datetime(1995, 3, 1), datetime(1995, 9, 1), datetime(1996, 1, 1), None]
    lines = [(s, when[i % 4], float(i % 7) if i % 5 else None, i % 3) for i in range(60) for s in (1, 2, 3, None, 9)]
    spark.createDataFrame(lines, "l_suppkey long, l_shipdate timestamp, l_quantity double, l_linenumber int").write.parquet(f"{folder}/lineitem.parquet")
    suppliers = [(1, "one"), (1, "one"), (2, "two"), (3, None), (None, "none")]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string").write.parquet(f"{folder}/supplier.parquet")
    return Tables(spark, str(folder))


def test_sources_by_year_have_the_rows_of_all_lines_and_do_not_read_them(spark, tmp_path):
    t = given(spark, tmp_path)
    for source in ("pesticides", "rainfall"):
        plain = t.sql(SOURCE_SQL[source]).toDF(*HEADERS[source])
        found = t.raw(source)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect())) and plain.count() > 6
        assert not any("lineitem" in f for f in found.inputFiles())


def test_rules_on_numeric_columns_are_asked_below_the_fold(spark):
    rows = spark.createDataFrame([(2000, "Chad", 20.0)] * 3 + [(2000, "Chad", 500.0), (1500, "Chad", 1.0), (2000, "Chad", None), (None, "Chad", 2.0), (2001, None, float("nan"))], "year int, country string, avg_temp double")
    checked = inspect(rows.repartition(2), "temp")
    assert not any(c.startswith("_number_of") for c in checked.rows.columns)
    plan = checked.accepted()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Filter")
    kept = sorted(map(repr, checked.accepted().collect()))
    # Null decides nothing; NaN is a missing value.
    assert kept == sorted(map(repr, rows.where("coalesce(avg_temp < 60 or isnan(avg_temp), true) and coalesce(year > 1600, true)").distinct().collect()))
    told = checked.report().first()
    assert (told["total_records"], told["accepted_records"]) == (8, 4) and told["rejection_reason_counts"] == {"duplicate_row": 2, "year_out_of_range": 1, "implausible_temp": 1}


def test_an_outcome_to_settle_parses_after_the_fold(spark, tmp_path):
    rows = spark.createDataFrame([("2000", "Chad", " 20.5 ")] * 3 + [("x", "Chad", "1e400"), ("1500", "Chad", None), (None, "Mali", "70")], "year string, country string, avg_temp string")
    early, late = inspect(rows, "temp"), inspect(rows, "temp", to_settle=True)
    plans = [one.rows._jdf.queryExecution().executedPlan().toString() for one in (early, late)]
    assert ["partial_max" in plan for plan in plans] == [True, False]
    again = late.settled(str(tmp_path / "checked"))
    for one in (late, again):
        assert sorted(map(repr, one.rows.select(*early.rows.columns).collect())) == sorted(map(repr, early.rows.collect()))
        for part in ("accepted", "rejected", "report", "reason_counts"):
            assert sorted(map(repr, getattr(one, part)().collect())) == sorted(map(repr, getattr(early, part)().collect()))
