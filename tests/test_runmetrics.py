"""The run report over records of the documented JSON shape, against sums by plain Python."""

import json
import os
import random

import pytest

from graphloom.operators.runmetrics import EXECUTOR_SUMS, STAGE_SUMS, run_summary
from graphloom.sources.runlogs import read_records


def put(record, field, value):
    *outer, last = field.split(".")
    for name in outer:
        record = record.setdefault(name, {})
    record[last] = value


@pytest.fixture(scope="module")
def runs(tmp_path_factory):
    """Folder of runs: some fields are absent, ``app-2`` has no executors, ``app-3`` jobs alone."""
    root, rng = tmp_path_factory.mktemp("runs"), random.Random(3)
    data = {}
    for app, kinds in (("app-1", ("jobs", "stages", "executors")), ("app-2", ("jobs", "stages")), ("app-3", ("jobs",))):
        os.makedirs(root / app)
        for kind in kinds:
            records = []
            for i in range(7):
                record = {"jobs": {"jobId": i}, "stages": {"stageId": i, "status": rng.choice(["COMPLETE", "SKIPPED", "FAILED"])},
                          "executors": {"id": str(i)}}[kind]
                if kind != "executors" and rng.random() < 0.8:
                    record["submissionTime"] = "2024-06-29T23:15:31.000GMT"
                    if rng.random() < 0.8:
                        record["completionTime"] = f"2024-06-29T23:15:3{i + 1}.2{i}0GMT"
                for _, field, _ in {"stages": STAGE_SUMS, "executors": EXECUTOR_SUMS}.get(kind, []):
                    if rng.random() < 0.7:
                        put(record, field, rng.randint(0, 10**10 if field not in ("numFailedTasks", "failedTasks") else 9))
                records.append(record)
            data[app, kind] = records
            (root / app / f"{kind}.json").write_text(json.dumps(records))
    return str(root / "app-*"), data


def expected(data):
    want = {}

    def ms(record):
        start, end = record.get("submissionTime"), record.get("completionTime")
        return 0 if not start or not end else round((float(end[17:23]) - float(start[17:23])) * 1000)

    def get(record, field):
        for name in field.split("."):
            record = (record or {}).get(name)
        return record or 0

    for (app, kind), records in data.items():
        if kind == "jobs":
            rows = {"total_jobs": len(records), "total_job_duration": sum(map(ms, records))}
        elif kind == "stages":
            done = sum(r["status"] == "COMPLETE" for r in records)
            rows = {"total_stages": len(records), "executed_stages": done, "skipped_stages": len(records) - done,
                    "total_stage_duration": sum(map(ms, records))}
        else:
            rows = {}
        for name, field, _ in {"stages": STAGE_SUMS, "executors": EXECUTOR_SUMS}.get(kind, []):
            rows[name] = sum(get(r, field) for r in records)
        want.update({(app, kind, name): value for name, value in rows.items()})
    return want


def test_every_metric_of_every_kind(spark, runs):
    folder, data = runs
    frames = {kind: read_records(spark, folder, kind) for kind in ("jobs", "stages", "executors")}
    rows = run_summary(**frames).collect()
    got = {(r.app_id, r.section, r.metric): r.value for r in rows}
    assert len(got) == len(rows) and got == expected(data)
    assert {"speculative_tasks", "jvm_off_heap_peak", "storage_memory_off_heap"} <= {r.metric for r in rows}


def test_one_exchange_for_all_kinds(spark, runs):
    frames = {kind: read_records(spark, runs[0], kind) for kind in ("jobs", "stages", "executors")}
    plan = run_summary(**frames)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Union") == 1 and "Join" not in plan
    executed = run_summary(**frames)._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1


def test_no_records(spark):
    with pytest.raises(ValueError):
        run_summary()
    empty = spark.createDataFrame([], "app_id string, submissionTime string, completionTime string")
    assert run_summary(jobs=empty).collect() == []
