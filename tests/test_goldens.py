"""The published input/output pairs (read as data from the reference folder)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from published import PAGERANK_APP, SSSP_APP, published
from graphloom import pagerank, shortest_paths
from graphloom.operators.runmetrics import run_summary
from graphloom.sources.runlogs import read_records
from graphloom.sources.text import adjacency_to_edges, listed_vertices, read_adjacency, read_edges


def test_sssp_published_five_node_graph(spark):
    edges = read_edges(spark, published("sssp_edges"))
    assert edges.count() == 10
    result = shortest_paths(edges, 0)
    got = {r.id: r.dist for r in result.distances.collect()}
    want = {}
    for line in open(published("sssp_distances")):
        i, d = line.strip().split(",")
        want[int(i)] = float(d)
    assert got == want == {0: 0.0, 1: 2.0, 2: 3.0, 3: 4.0, 4: 3.0}
    assert result.improving_rounds == 3
    # one round to confirm the fixed point
    assert result.trace.count == 4


def _published_link_lists(spark):
    adj = read_adjacency(spark, published("link_lists"))
    return adjacency_to_edges(adj), listed_vertices(adj)


def test_pagerank_twice_damped_matches_published_ranking(spark):
    edges, listed = _published_link_lists(spark)
    result = pagerank(edges, listed=listed, damping_mode="twice", tol=1e-4, max_iter=50)
    assert result.converged and result.rounds == 10
    got = {r.id: r.rank for r in result.ranks.collect()}
    lines = open(published("ranks_twice_damped")).read().split()
    want = {int(a): float(b) for a, b in (ln.split(",") for ln in lines)}
    assert set(got) == set(want) and len(want) == 100
    assert max(abs(got[k] - want[k]) for k in want) < 1e-15
    assert got[95] == pytest.approx(0.026224963475643338, abs=1e-17)
    assert sum(got.values()) == pytest.approx(0.99558, abs=1e-5)
    # published order: rank descending
    order = [int(ln.split(",")[0]) for ln in lines]
    ranked = [r.id for r in result.ranks.orderBy(F.desc("rank"), "id").collect()]
    assert ranked == order


def test_pagerank_standard_five_rounds_matches_practical_output(spark):
    edges, listed = _published_link_lists(spark)
    result = pagerank(edges, listed=listed, vertices="sources", tol=None, max_iter=5)
    got = {r.id: r.rank for r in result.ranks.collect()}
    want = {}
    for line in open(published("ranks_five_rounds")):
        node, value = line.split(":")
        want[int(node.split()[1])] = float(value)
    assert len(want) == 100
    assert all(abs(got[k] - want[k]) <= 5e-7 for k in want)
    assert got[94] == pytest.approx(0.0015, abs=1e-12)


def _summary(spark, which):
    g = published(which)
    jobs = read_records(spark, g, "jobs")
    executors = read_records(spark, g, "executors")
    rows = run_summary(jobs=jobs, executors=executors).collect()
    return {(r.app_id, r.metric): r.value for r in rows}


def test_run_summary_sssp_run(spark):
    s = _summary(spark, "sssp_runs")
    app = SSSP_APP
    assert s[(app, "total_jobs")] == 5
    assert s[(app, "total_job_duration")] == 1408
    assert s[(app, "shuffle_read")] == 66069
    assert s[(app, "shuffle_write")] == 47574
    assert s[(app, "gc_time")] == 35
    assert s[(app, "jvm_heap_peak")] == 95033672


def test_run_summary_pagerank_run(spark):
    s = _summary(spark, "pagerank_runs")
    app = PAGERANK_APP
    assert s[(app, "total_jobs")] == 25
    assert s[(app, "total_job_duration")] == 27027
    assert s[(app, "shuffle_read")] == 1006608
    assert s[(app, "storage_memory_used")] == 56502
    assert s[(app, "gc_time")] == 786


def test_stage_records_from_documented_fields(spark, scratch):
    """stages.json is not shipped: a hand-made file with the REST fields."""
    from graphloom.operators.runmetrics import stage_listing

    run = os.path.join(scratch, "app-1")
    os.makedirs(run)
    stages = [
        {"stageId": 0, "name": "a", "status": "COMPLETE", "numTasks": 2,
         "submissionTime": "2024-06-29T23:15:31.000GMT", "completionTime": "2024-06-29T23:15:31.250GMT",
         "executorRunTime": 100, "inputBytes": 10, "shuffleFetchWaitTime": 3},
        {"stageId": 1, "name": "b", "status": "SKIPPED", "numTasks": 4},
    ]
    with open(os.path.join(run, "stages.json"), "w") as f:
        json.dump(stages, f)
    st = read_records(spark, os.path.join(scratch, "app-*"), "stages")
    s = {(r.metric): r.value for r in run_summary(stages=st).collect()}
    assert s["total_stages"] == 2 and s["executed_stages"] == 1 and s["skipped_stages"] == 1
    assert s["total_stage_duration"] == 250
    assert s["executor_run_time"] == 100 and s["bytes_read"] == 10 and s["fetch_wait_time"] == 3
    listing = {r.stageId: r.duration_ms for r in stage_listing(st).collect()}
    assert listing == {0: 250, 1: None}


def test_report_lines_written_per_run(spark, scratch):
    import glob

    from graphloom.operators.runmetrics import write_report

    g = published("sssp_runs")
    summary = run_summary(jobs=read_records(spark, g, "jobs"), executors=read_records(spark, g, "executors"))
    out = os.path.join(scratch, "report")
    write_report(summary, out)
    lines = []
    for part in sorted(glob.glob(os.path.join(out, f"app_id={SSSP_APP}", "part-*"))):
        lines.extend(open(part).read().splitlines())
    assert "jobs: total_jobs = 5 jobs" in lines
    assert "jobs: total_job_duration = 1,408 ms" in lines
    assert "executors: shuffle_read = 66,069 bytes" in lines
