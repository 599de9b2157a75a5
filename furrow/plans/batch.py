"""The ordered batch: land, gate, curate, load; and the record of every run."""

from __future__ import annotations

import json
import time
import traceback
import uuid
from collections.abc import Callable, Collection, Mapping
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.operators.integrity import table_counts
from furrow.operators.quality import inspect, overall_quality
from furrow.plans.curate import SOURCES, curate, transform_report
from furrow.session import settled_for_a_while
from furrow.sources.files import land_all, latest_by_key, read_raw, read_torn, write_report, write_table
from furrow.sources.star import build_star, read_star, write_star

#: Fixed names: the columns of the run history.
RUN = (
    "run_id string, started_at string, ended_at string, duration_sec double, status string, error_message string, "
    "records_received long, records_accepted long, records_rejected long, overall_quality_score_pct double, "
    "curated_rows long, stage_detail_json string"
)


@dataclass
class Stage:
    stage: str
    duration_sec: float
    detail: dict


class Batch(list):
    """The stages that ended, in order, and in ``totals`` the counts known so far under
    the names of the run history. A stage that fails leaves the batch with what the
    ones before it brought, as ``finished`` of the exception."""

    def __init__(self) -> None:
        super().__init__()
        self.totals: dict = {}

    def stage(self, name: str, work: Callable[[], dict]) -> None:
        start = time.perf_counter()
        try:
            detail = work()
        except Exception as problem:
            problem.finished = self
            raise
        self.append(Stage(name, time.perf_counter() - start, detail))


def run_batch(
    spark: SparkSession, incoming: Mapping[str, str], home: str, multiline: Collection[str] = (), load_id: str | None = None
) -> Batch:
    """Run all four stages over the files named in ``incoming``.

    Only rows the gate accepts reach the curated table; torn records go to the quarantine
    with their text and count as received and rejected. A source that could not
    be landed is skipped there and stops the run at the gate. Tables that operators
    settled on the way are removed at the end. A run repeated under its ``load_id`` has
    effect once.
    """
    with settled_for_a_while(spark):
        return _run_batch(spark, incoming, home, multiline, load_id)


def _run_batch(spark: SparkSession, incoming: Mapping[str, str], home: str, multiline: Collection[str], load_id: str | None) -> Batch:
    raw, processed, quarantine = f"{home}/raw", f"{home}/processed", f"{home}/quarantine"
    batch = Batch()

    def ingestion() -> dict:
        landed = [r for r in land_all(spark, incoming, raw, multiline, load_id).collect() if r["landed"]]
        torn = {r["source_name"]: r["torn_count"] for r in landed if r["torn_count"]}
        for source in torn:
            write_table(read_torn(spark, raw, source), f"{quarantine}/_torn/{source}")
        batch.totals["records_received"] = sum(r["record_count"] + r["torn_count"] for r in landed)
        return {"files_ingested": len(landed), "records": {r["source_name"]: r["record_count"] for r in landed}, "torn": torn}

    accepted: dict[str, DataFrame] = {}

    def data_quality() -> dict:
        absent = [s for s in SOURCES if s not in batch[0].detail["records"]]
        if absent:
            raise FileNotFoundError(f"sources that did not land: {', '.join(absent)}")
        reports = []
        for source in SOURCES:
            # The folded rows feed the quarantine, the report and the next
            # stage, so they are written once and read back.
            checked = inspect(read_raw(spark, raw, source), source, to_settle=True).settled(f"{processed}/_checked/{source}")
            write_table(checked.rejected(), f"{quarantine}/{source}")
            reports.append(checked.report())
            accepted[source] = checked.accepted()
        combined = reduce(DataFrame.unionByName, reports)
        write_report(combined, f"{quarantine}/_quality_report")
        written = spark.read.schema(combined.schema).json(f"{quarantine}/_quality_report")
        write_report(overall_quality(written), f"{quarantine}/_overall_quality")
        # The run's totals are those of the report as it was written.
        total = overall_quality(written).first()
        seen, kept = total["overall_total_records"], total["overall_accepted_records"]
        torn = sum(batch[0].detail["torn"].values())
        batch.totals |= {"records_accepted": kept, "records_rejected": seen - kept + torn}
        if seen:
            batch.totals["overall_quality_score_pct"] = total["overall_quality_score_pct"]
        return {
            r["source_name"]: {"accepted": r["accepted_records"], "rejected": r["rejected_records"], "score_pct": r["quality_score_pct"]}
            for r in written.collect()
        }

    def transform() -> dict:
        path = f"{processed}/curated"
        write_table(curate(accepted), path)
        curated = spark.read.parquet(path)
        report = transform_report(accepted, curated)
        write_report(report, f"{processed}/_transform_report")
        batch.totals["curated_rows"] = curated.count()
        return {"curated_rows": batch.totals["curated_rows"], "curated_path": path}

    def load() -> dict:
        write_star(build_star(spark.read.parquet(f"{processed}/curated")), f"{processed}/star")
        counts = table_counts(read_star(spark, f"{processed}/star")).collect()
        return {"star_path": f"{processed}/star", "rows": {r["table_name"]: r["n_rows"] for r in counts}}

    batch.stage("ingestion", ingestion)
    batch.stage("data_quality", data_quality)
    batch.stage("transform", transform)
    batch.stage("sql_load", load)
    log = [(s.stage, s.duration_sec, json.dumps(s.detail)) for s in batch]
    write_report(spark.createDataFrame(log, "stage string, duration_sec double, detail string"), f"{processed}/_run_log")
    return batch


def record_run(spark: SparkSession, history: str, work: Callable[[], list[Stage]], run_id: str | None = None) -> dict:
    """Run ``work`` and append one row to the run history, also if it fails.

    The history is append-only and lives outside the folders a run rebuilds. The row
    of a failure holds the stages that had ended and their counts; the failure is
    raised again. A run that is repeated under its ``run_id``, say after a failure or
    because nobody knows whether it came through, is one row of the history as it is
    read: that of the last attempt.
    """
    started = datetime.now(timezone.utc)
    record = dict.fromkeys(f.split()[0] for f in RUN.split(", "))
    record |= {"run_id": run_id or str(uuid.uuid4()), "started_at": started.isoformat()}
    ended_stages: list[Stage] = []
    try:
        ended_stages = work()
        record["status"] = "SUCCESS"
        return record
    except Exception as problem:
        ended_stages = getattr(problem, "finished", [])
        record |= {"status": "FAILED", "error_message": "".join([f"{type(problem).__name__}: {problem}\n", *traceback.format_exception(problem)])}
        raise
    finally:
        record |= getattr(ended_stages, "totals", {})
        record["stage_detail_json"] = json.dumps([asdict(s) for s in ended_stages])
        ended = datetime.now(timezone.utc)
        record |= {"ended_at": ended.isoformat(), "duration_sec": (ended - started).total_seconds()}
        spark.createDataFrame([tuple(record.values())], RUN).write.mode("append").parquet(history)


def read_history(spark: SparkSession, history: str) -> DataFrame:
    """One row per run, the last attempt's."""
    try:
        return latest_by_key(spark.read.schema(RUN).parquet(history), ["run_id"], "ended_at")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUN)


def latest_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), "run_id").limit(n)


def last_failure(runs: DataFrame) -> DataFrame:
    return latest_runs(runs.where("status = 'FAILED'"), 1)


def roll_up(stage_counts: DataFrame, by: str = "run_id") -> DataFrame:
    """Records received, accepted and rejected per run from per-source counts."""
    sums = stage_counts.groupBy(by).agg(*[F.sum(c).alias(f"records_{c}") for c in ("received", "accepted", "rejected")])
    score = F.bround(F.try_divide(F.lit(100.0) * F.col("records_accepted"), F.col("records_received")), 2)
    return sums.withColumn("overall_quality_score_pct", score)
