"""Files, manifests, the ordered batch, the run history and the star schema."""

import json
import os

import pytest
from pyspark.sql import functions as F

from furrow.plans import queries as q
from furrow.session import settle, settled_for_a_while, use_checkpoint_folder
from furrow.plans.batch import last_failure, latest_runs, read_history, record_run, run_batch
from furrow.plans.curate import curate_unfiltered
from furrow.sources.contracts import CONTRACTS
from furrow.sources.files import TORN, land, land_all, read_manifest, read_raw, read_torn, scan_records, scan_text, scan_typed
from furrow.sources.star import build_star, read_star, star_violations

YIELD = ",".join(CONTRACTS["yield"])
FILES = {
    "yield": f"""{YIELD}
QC,Crops,1,Viet Nam,5419,Yield,56,Maize,2000,2000,hg/ha,1000
QC,Crops,1,Viet Nam,5419,Yield,56,Maize,2001,2001,hg/ha,1100
QC,Crops,1,Viet Nam,5419,Yield,27,"Rice, paddy",2000,2000,hg/ha,3000
QC,Crops,2,Côte d'Ivoire,5419,Yield,56,Maize,2000,2000,hg/ha,900
QC,Crops,2,Côte d'Ivoire,5419,Yield,56,Maize,2001,2001,hg/ha,0
QC,Crops,2,Côte d'Ivoire,5419,Yield,56,Maize,2000,2000,hg/ha,900
""",
    "pesticides": """Domain,Area,Element,Item,Year,Unit,Value
P,Viet Nam,Use,All,2000,tonnes,5.5
P,Viet Nam,Use,All,2001,tonnes,-1
""",
    "rainfall": """ Area,Year,average_rain_fall_mm_per_year
Vietnam,2000,..
Vietnam,2001,1500
""",
    "temp": """year,country,avg_temp
2000,Vietnam,20
2000,Vietnam,24
2000,Vietnam,24
2001,vietnam,
2000,Côte D'Ivoire,26
""",
}


@pytest.fixture
def incoming(tmp_path):
    paths = {}
    for name, text in FILES.items():
        path = tmp_path / "external" / f"{name}.csv"
        path.parent.mkdir(exist_ok=True)
        path.write_text(text, encoding="utf-8")
        paths[name] = str(path)
    return paths


def test_scans(spark, incoming):
    text = scan_text(spark, incoming["rainfall"])
    assert text.columns[0] == " Area" and set(dict(text.dtypes).values()) == {"string"}
    typed = scan_typed(spark, incoming["yield"], "yield")
    assert typed.columns == list(CONTRACTS["yield"]) and dict(typed.dtypes)["Year"] == "int"
    assert typed.where("Area like 'Côte%'").count() == 3


def test_landing_and_manifest(spark, incoming, tmp_path):
    raw = str(tmp_path / "raw")
    receipt = land(spark, "temp", incoming["temp"], raw)
    assert receipt["record_count"] == 5 and receipt["columns"] == ["year", "country", "avg_temp"]
    told = land_all(spark, {"rainfall": incoming["rainfall"], "yield": "/no/such/file.csv"}, raw).collect()
    assert [(r["source_name"], r["landed"], r["record_count"]) for r in told] == [("rainfall", True, 2), ("yield", False, None)]
    assert read_raw(spark, raw, "rainfall").columns == [" Area", "Year", "average_rain_fall_mm_per_year"]
    manifest = spark.read.parquet(f"{raw}/_manifest")
    assert sorted(r["source_name"] for r in manifest.collect()) == ["rainfall", "temp"]


def test_batch_end_to_end(spark, incoming, tmp_path):
    home = str(tmp_path / "home")
    stages = run_batch(spark, incoming, home)
    assert [s.stage for s in stages] == ["ingestion", "data_quality", "transform", "sql_load"]
    assert stages[0].detail["records"] == {"yield": 6, "pesticides": 2, "rainfall": 2, "temp": 5}
    assert stages[1].detail["yield"] == {"accepted": 4, "rejected": 2, "score_pct": 66.67}
    rows = {(r["area"], r["crop"], r["year"]): r for r in spark.read.parquet(f"{home}/processed/curated").collect()}
    assert len(rows) == stages[2].detail["curated_rows"] == 4
    viet = rows[("Viet Nam", "Maize", 2000)]
    assert (viet["pesticides_tonnes"], viet["rainfall_mm"], viet["avg_temp_c"]) == (5.5, None, 22.0)
    assert rows[("Viet Nam", "Maize", 2001)]["pesticides_tonnes"] is None and rows[("Viet Nam", "Maize", 2001)]["rainfall_mm"] == 1500.0
    assert rows[("Côte d'Ivoire", "Maize", 2000)]["avg_temp_c"] == 26.0
    quarantined = spark.read.parquet(f"{home}/quarantine/yield").collect()
    assert sorted(r["reject_reason"] for r in quarantined) == ["duplicate_row", "non_positive_yield"]
    overall = spark.read.json(f"{home}/quarantine/_overall_quality").first()
    assert (overall["overall_total_records"], overall["overall_accepted_records"]) == (15, 11)
    report = spark.read.json(f"{home}/processed/_transform_report").first()
    assert report["join_match_rates"]["total_rows"] == 4 and report["join_match_rates"]["pesticides_matched_pct"] == 50.0
    star = read_star(spark, f"{home}/processed/star")
    assert {r["region_name"]: r["region_id"] for r in star["region"].collect()} == {"Côte d'Ivoire": 1, "Viet Nam": 2}
    assert {r["violations"] for r in star_violations(star).collect()} == {0}
    assert stages[3].detail["rows"] == {"region": 2, "crop": 2, "weather_observation": 3, "agricultural_practice_observation": 3, "yield_observation": 4}
    again = run_batch(spark, incoming, home)  # a second run replaces, it does not add
    assert again[2].detail["curated_rows"] == 4 and spark.read.parquet(f"{home}/raw/_manifest").count() == 8
    assert curate_unfiltered(spark, f"{home}/raw").count() == 6


def test_history_keeps_failures(spark, incoming, tmp_path):
    home, history = str(tmp_path / "home"), str(tmp_path / "history")
    assert latest_runs(read_history(spark, history)).count() == 0
    done = record_run(spark, history, lambda: run_batch(spark, incoming, home))
    assert done["status"] == "SUCCESS" and done["records_received"] == 15 and done["overall_quality_score_pct"] == 73.33
    with pytest.raises(FileNotFoundError, match="temp"):
        record_run(spark, history, lambda: run_batch(spark, incoming | {"temp": "/no/such.csv"}, home))
    runs = read_history(spark, history)
    assert [r["status"] for r in latest_runs(runs).collect()] == ["FAILED", "SUCCESS"]
    failure = last_failure(runs).first()
    assert failure["error_message"].startswith("FileNotFoundError") and "Traceback" in failure["error_message"]
    assert failure["curated_rows"] is None and failure["duration_sec"] > 0
    # What had ended before the failure is kept.
    assert [s["stage"] for s in json.loads(failure["stage_detail_json"])] == ["ingestion"]
    assert failure["records_received"] == 10 and failure["records_accepted"] is None


def test_settled_tables_go_with_the_run(spark, incoming, tmp_path):
    folder = use_checkpoint_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    run_batch(spark, incoming, str(tmp_path / "home"))
    assert set(os.listdir(folder)) == before
    with settled_for_a_while(spark):
        assert settle(spark.range(5)).count() == 5
    assert set(os.listdir(folder)) == before


@pytest.fixture
def star(spark):
    rows = [
        ("India", "Maize", 2000, 10, 1.0, 20.0, 3.0), ("India", "Maize", 2002, 30, None, 21.0, 4.0), ("India", "Maize", 2003, 30, 5.0, 21.0, 4.0),
        ("Mali", "Maize", 2000, 20, 2.0, 30.0, None), ("India", "Wheat", 2000, 99, 1.0, 20.0, 3.0),
    ]
    return build_star(spark.createDataFrame(rows, "area string, crop string, year int, yield_hg_ha long, rainfall_mm double, avg_temp_c double, pesticides_tonnes double"))


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_questions(star):
    assert rows(q.top_observations(star, n=2)) == [("India", 2002, 30), ("India", 2003, 30)]
    assert rows(q.mean_by_crop(star)) == [("Wheat", 99.0, 1), ("Maize", 22.5, 4)]
    assert rows(q.regions_with_history(star, min_years=2)) == [("India", 3)]
    assert rows(q.regions_above_average(star)) == [("India", 23.3)]
    assert rows(q.best_years(star)) == [("India", 2002, 30), ("India", 2003, 30), ("Mali", 2000, 20)]  # ties stay
    assert [r[2:] for r in rows(q.year_over_year(star, "India"))] == [(2000, 10, None, None), (2002, 30, 10, 20), (2003, 30, 30, 0)]
    assert [r[3] for r in rows(q.yield_tiers(star))] == ["low", "medium", "medium", "medium"]
    assert rows(q.yield_in_context(star, "Mali")) == [("Mali", 2000, 20, 2.0, 30.0, None)]


def test_star_reports_broken_constraints(star):
    broken = dict(star)
    facts = star["yield_observation"]
    broken["yield_observation"] = facts.unionByName(facts.withColumn("region_id", F.lit(77)).limit(1)).unionByName(facts)
    told = {r["rule"]: r["violations"] for r in star_violations(broken).collect()}
    assert told["unique yield_observation(region_id, crop_id, year)"] == 5
    assert told["yield_observation.region_id in region.region_id"] == 1


TORN_TEXT = (
    ' Area,Year,average_rain_fall_mm_per_year\n"Viet\nNam",2000,15\nVietnam,2001\nVietnam,2002,1,2\n"He said ""hi""",2003,7\n\nVietnam,2004,9\n'
)


def test_torn_records_are_kept_apart_with_their_text(spark, tmp_path):
    path = tmp_path / "rain.csv"
    path.write_text(TORN_TEXT, encoding="utf-8")
    names = [" Area", "Year", "average_rain_fall_mm_per_year"]
    read = scan_records(spark, str(path), multiline=True)
    assert read.columns == [*names, TORN]
    raw = str(tmp_path / "raw")
    receipt = land(spark, "rainfall", str(path), raw, multiline=True)
    assert (receipt["record_count"], receipt["torn_count"], receipt["columns"]) == (3, 2, names)
    sound = {tuple(r) for r in read_raw(spark, raw, "rainfall").collect()}
    assert sound == {("Viet\nNam", "2000", "15"), ('He said "hi"', "2003", "7"), ("Vietnam", "2004", "9")}
    torn = read_torn(spark, raw, "rainfall").collect()
    assert sorted(r["record"].strip() for r in torn) == ["Vietnam,2001", "Vietnam,2002,1,2"]
    assert {r["reject_reason"] for r in torn} == {"torn_record"}
    # Line by line, the record with the break is cut in two, and only its first half shows that.
    assert land(spark, "rainfall", str(path), raw)["torn_count"] == 3
    assert read_raw(spark, raw, "rainfall").count() == 3


def test_batch_counts_torn_records_as_rejected(spark, incoming, tmp_path):
    with open(incoming["rainfall"], "a", encoding="utf-8") as out:
        out.write("Vietnam\n")
    home = str(tmp_path / "home")
    batch = run_batch(spark, incoming, home, multiline=["yield"], load_id="one")
    assert batch[0].detail["torn"] == {"rainfall": 1}
    assert (batch.totals["records_received"], batch.totals["records_accepted"], batch.totals["records_rejected"]) == (16, 11, 5)
    assert [r["record"] for r in spark.read.parquet(f"{home}/quarantine/_torn/rainfall").collect()] == ["Vietnam"]
    run_batch(spark, incoming, home, load_id="one")
    told = read_manifest(spark, f"{home}/raw").collect()
    assert sorted((r["source_name"], r["record_count"], r["torn_count"]) for r in told) == [("pesticides", 2, 0), ("rainfall", 2, 1), ("temp", 5, 0), ("yield", 6, 0)]


def test_a_repeated_run_is_one_row_of_the_history(spark, tmp_path):
    history = str(tmp_path / "history")

    def fails():
        raise RuntimeError("no disk")

    with pytest.raises(RuntimeError):
        record_run(spark, history, fails, run_id="monday")
    assert [r["status"] for r in read_history(spark, history).collect()] == ["FAILED"]
    record_run(spark, history, lambda: [], run_id="monday")
    record_run(spark, history, lambda: [], run_id="monday")
    record_run(spark, history, lambda: [])
    runs = read_history(spark, history)
    assert runs.count() == 2 and runs.where("run_id = 'monday'").first()["status"] == "SUCCESS"
    assert last_failure(runs).count() == 0
    assert spark.read.parquet(history).count() == 4


def test_loaded_star_prunes_the_crops_folders(spark, curated_toy, tmp_path):
    from furrow.sources.star import write_star

    more = curated_toy.unionByName(curated_toy.withColumn("crop", F.lit("Wheat")))
    write_star(build_star(more), str(tmp_path))
    star = read_star(spark, str(tmp_path))
    assert dict(star["yield_observation"].dtypes)["crop_id"] == dict(star["crop"].dtypes)["crop_id"]
    assert sorted(map(tuple, star["yield_observation"].collect())) == sorted(map(tuple, build_star(more)["yield_observation"].collect()))
    assert sorted(p for p in os.listdir(tmp_path / "yield_observation") if "=" in p) == ["crop_id=1", "crop_id=2"]
    told = q.yield_in_context(star, region=None, crop="Maize", n=None)
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "Exchange hashpartitioning" not in plan
    assert told.count() == 4
