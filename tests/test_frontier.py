"""Shortest paths read only the frontier's blocks, find negative cycles early, and leave nothing behind."""

import glob
import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from graphloom import pagerank, prepare_graph, shortest_paths
from graphloom.plans.cycles import cycle_vertices, one_cycle
from graphloom.plans.sssp import NegativeCycleError, distance_to
from graphloom.plans.tables import RunTables
from graphloom.session import checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROGRAM = """
import sys
from pyspark.sql import SparkSession
from graphloom import shortest_paths
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1] + "/shared").config("spark.sql.warehouse.dir", sys.argv[1] + "/wh")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + sys.argv[1] + "/events")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").getOrCreate())
rows = [(i, i + 1, 1.0) for i in range(7)] + [(0, 100 + i, 1.0) for i in range(400)] + [(100 + i, 600 + i, 9.0) for i in range(400)]
got = shortest_paths(spark.createDataFrame(rows, "src bigint, dst bigint, weight double"), 0, partitions=16)
assert got.improving_rounds == 7, got.improving_rounds
assert got.distances.where("id = 7 and dist = 7").count() == 1
spark.stop()
"""


def files_of_edges(log):
    """Files read from the edge table, execution by execution."""
    scans, read = {}, {}

    def visit(node, execution):
        if "Scan parquet" in node["nodeName"] and "/cold" in node.get("metadata", {}).get("Location", ""):
            for m in node["metrics"]:
                if m["name"] == "number of files read":
                    scans[m["accumulatorId"]] = execution
        for child in node["children"]:
            visit(child, execution)

    events = [json.loads(line) for line in open(log)]
    for e in events:
        if "sparkPlanInfo" in e and "executionId" in e:
            visit(e["sparkPlanInfo"], e["executionId"])
    for e in events:
        if e["Event"].endswith("SparkListenerDriverAccumUpdates"):
            for key, value in e["accumUpdates"]:
                if key in scans:
                    read[scans[key]] = read.get(scans[key], 0) + value
    return [read[k] for k in sorted(read)]


def test_late_rounds_read_fewer_files(scratch):
    os.mkdir(f"{scratch}/events")
    program = f"{scratch}/run.py"
    open(program, "w").write(PROGRAM)
    subprocess.run([sys.executable, program, scratch], check=True, timeout=300, capture_output=True, env={**os.environ, "PYTHONPATH": ROOT})
    [log] = glob.glob(f"{scratch}/events/*")
    files = files_of_edges(log)
    # rounds 2 and 3 send from 400 leaves; from then on one vertex sends
    assert len(files) == 8 and files[:3] == [16] * 3 and set(files[3:]) == {1}, files


def cyclic(n, length, seed=2):
    """A path of n vertices with a negative ring of ``length`` hanging on vertex 3."""
    rng = random.Random(seed)
    ring = [3] + [n + i for i in range(length - 1)]
    rows = [(i, i + 1, float(rng.randint(0, 5))) for i in range(n - 1)]
    rows += [(a, b, -1.0) for a, b in zip(ring, ring[1:] + ring[:1])]
    return rows, set(zip(ring, ring[1:] + ring[:1]))


@pytest.mark.parametrize("length", [1, 2, 7])
def test_a_negative_cycle_is_found_early(spark, length):
    rows, ring = cyclic(10_000, length)
    with pytest.raises(NegativeCycleError) as found:
        shortest_paths(spark.createDataFrame(rows, "src bigint, dst bigint, weight double"), 0, partitions=2)
    assert int(str(found.value).split("after ")[1].split()[0]) < 100
    cycle = sorted(map(tuple, found.value.cycle.collect()))
    assert [c[0] for c in cycle] == list(range(length)) and {(s, d) for _, s, d, _ in cycle} == ring
    assert all(cycle[i][2] == cycle[(i + 1) % length][1] for i in range(length)) and cycle[0][1] == 3
    assert sum(c[3] for c in cycle) == -length


def test_negative_weights_without_a_cycle(spark):
    rng = random.Random(9)
    pot = [rng.randint(-40, 40) for _ in range(60)]
    rows = [(a, b, float(rng.randint(0, 9) + pot[a] - pot[b])) for a in range(60) for b in rng.sample(range(60), 3)]
    dist = {0: 0.0}
    for _ in range(60):
        for a, b, w in rows:
            if a in dist:
                dist[b] = min(dist.get(b, float("inf")), dist[a] + w)
    for kw in ({}, {"bucket_size": 2}):
        got = shortest_paths(spark.createDataFrame(rows, "src bigint, dst bigint, weight double"), 0, partitions=3, **kw)
        assert {r.id: r.dist for r in got.distances.where("dist < double('inf')").collect()} == dist


def test_cycles_of_pointers(spark):
    # 1 -> 2 -> 3 -> 1, 8 -> 9 -> 8, a tail into the first, a chain that ends
    pairs = [(2, 1), (3, 2), (1, 3), (9, 8), (8, 9), (4, 3), (5, 4), (20, 21), (21, 22)]
    parents = spark.createDataFrame(pairs, "id bigint, parent bigint")
    tables = RunTables(spark, "test")
    assert {r.id for r in cycle_vertices(parents, tables, 9).collect()} == {1, 2, 3, 8, 9}
    assert sorted(map(tuple, one_cycle(parents, RunTables(spark, "test"), 9).collect())) == [(0, 1, 3), (1, 2, 1), (2, 3, 2)]
    assert one_cycle(parents.where("id >= 20"), RunTables(spark, "test"), 9) is None
    assert one_cycle(parents.limit(0), RunTables(spark, "test"), 9) is None


def test_nothing_is_left_but_the_result(spark):
    def folders():
        return {p for p in glob.glob(checkpoint_dir(spark).removeprefix("file:") + "/*") if os.path.basename(p).startswith("graphloom")}

    before, tables = folders(), spark.catalog.listTables()
    edges = spark.createDataFrame([(i, (i * 3 + 1) % 50, 1.0) for i in range(50)], "src bigint, dst bigint, weight double")
    for run in (lambda: shortest_paths(edges, 0).distances, lambda: pagerank(edges.select("src", "dst")).ranks):
        result = run()
        [left] = folders() - before  # the one state that the result reads
        assert len(os.listdir(left)) == 1 and result.count() == 50
        before = folders()
    layout = prepare_graph(edges)
    assert len(folders() - before) == 1
    layout.close()
    assert folders() == before and len(spark.catalog.listTables()) == len(tables) + 2


def test_point_lookup_reads_one_bucket(spark):
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(60)], "src bigint, dst bigint, weight double")
    got = shortest_paths(edges, 0, partitions=8)
    hit = distance_to(got, 17)
    [[kept]] = hit.select(F.input_file_name()).collect()
    kept = kept.removeprefix("file://")
    others = [p for p in glob.glob(os.path.dirname(kept) + "/part-*") if p != kept]
    assert len(others) == 7
    for path in others:  # whoever opened one of them would fail
        os.remove(path)
    assert [tuple(r) for r in distance_to(got, 17).collect()] == [(17, 17.0)]
    with pytest.raises(Exception):
        got.distances.collect()


def test_hot_state_beyond_the_broadcast_bound_is_shuffled(spark, monkeypatch):
    from graphloom.plans import layout

    monkeypatch.setattr(layout, "MAX_BROADCAST_HOT", 0)
    rows = [(0, t, 2.0) for t in range(1, 41)] + [(t, t + 1, 1.0) for t in range(1, 40)] + [(40, 0, 1.0)]
    edges = spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    graph = prepare_graph(edges, partitions=4, bucket_size=10)
    assert not graph.broadcast_hot and {r.dist for r in shortest_paths(graph, 0).distances.collect()} == {0.0, 2.0}
    plain = {r.id: r.rank for r in pagerank(edges, tol=None, max_iter=4).ranks.collect()}
    got = {r.id: r.rank for r in pagerank(graph, tol=None, max_iter=4).ranks.collect()}
    assert all(abs(plain[k] - got[k]) < 1e-12 for k in plain)
