"""The two-dimensional edge layout: same results, two bounded exchanges a round, edges never moved."""

import glob
import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from graphloom import pagerank, prepare_graph, shortest_paths
from graphloom.plans.grid import cell_names, side
from graphloom.plans.loop import loop_partitions
from graphloom.plans.pagerank import initial_state, rank_round

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROGRAM = """
import sys
from pyspark.sql import SparkSession, functions as F
from graphloom import pagerank, prepare_graph
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1] + "/shared").config("spark.sql.warehouse.dir", sys.argv[1] + "/wh")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + sys.argv[1] + "/events")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").getOrCreate())
n = 400
dense = spark.range(n * n).select((F.col("id") % n).alias("src"), F.expr(f"id div {n}").alias("dst")).where("(src * 7 + dst * 3) % 5 < 3")
for name, grid in (("line", False), ("grid", True)):
    layout = prepare_graph(dense, weight=None, partitions=64, grid=grid)
    spark.addTag(name)
    pagerank(layout, tol=None, max_iter=2)
    spark.removeTag(name)
    layout.close()
spark.stop()
"""


def shuffled(log, tag):
    """Rows and bytes that the jobs with a tag wrote to shuffles."""
    stages, rows, size = set(), 0, 0
    for line in open(log):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart" and tag in (e["Properties"].get("spark.job.tags") or ""):
            stages |= set(e["Stage IDs"])
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages:
            written = e["Task Metrics"]["Shuffle Write Metrics"]
            rows, size = rows + written["Shuffle Records Written"], size + written["Shuffle Bytes Written"]
    return rows, size


def test_a_dense_graph_shuffles_less(scratch):
    for folder in ("shared", "events", "wh"):
        os.makedirs(f"{scratch}/{folder}")
    done = subprocess.run([sys.executable, "-c", PROGRAM, scratch], cwd=ROOT, capture_output=True, text=True, timeout=600,
                          env={**os.environ, "PYTHONPATH": ROOT})
    assert done.returncode == 0, done.stderr[-3000:]
    log = glob.glob(f"{scratch}/events/*")[0]
    (line_rows, line_bytes), (grid_rows, grid_bytes) = shuffled(log, "line"), shuffled(log, "grid")
    # two rounds, two exchanges each, at most a row per vertex and block
    assert 0 < grid_rows <= 2 * 2 * 400 * 8
    assert grid_rows < line_rows / 3 and grid_bytes < line_bytes


def test_cells_have_buckets_of_their_own(spark):
    names = {r["number"]: r["cell"] for r in cell_names(spark, 9, 11).collect()}
    assert sorted(names) == list(range(9))
    put = spark.createDataFrame([(c,) for c in names.values()], "cell bigint").select(F.expr("pmod(hash(cell), 11) AS b"))
    assert put.distinct().count() == 9
    assert [side(p) for p in (1, 3, 4, 15, 16)] == [1, 1, 2, 3, 4]


def test_a_round_has_two_exchanges_and_moves_no_edges(spark):
    e = spark.range(600).select((F.col("id") % 20).alias("src"), F.expr("id div 20").alias("dst"))
    layout = prepare_graph(e, weight=None, partitions=9, grid=True)
    assert layout.cold.groupBy("cell").count().count() == 9
    with loop_partitions(spark, 9), layout.planned():
        plan = rank_round(layout, initial_state(layout), 0.85, 0.0, "standard")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Exchange hashpartitioning(src" not in plan
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    layout.close()


@pytest.mark.parametrize("partitions", [1, 6])
def test_ranks_and_distances_equal_the_other_layout(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.randrange(40), rng.randrange(45), float(rng.randrange(1, 9))) for _ in range(300)]
    rows += rows[:20] + [(0, d, 5.0) for d in range(45)] + [(None, 3, 1.0)]
    e = spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    for mode in ("standard", "twice"):
        a = pagerank(e.select("src", "dst"), damping_mode=mode, partitions=partitions, tol=None, max_iter=3)
        b = pagerank(e.select("src", "dst"), damping_mode=mode, partitions=partitions, tol=None, max_iter=3, grid=True)
        assert a.rounds == b.rounds
        want, got = ({r.id: r.rank for r in x.ranks.collect()} for x in (a, b))
        assert want.keys() == got.keys() and all(abs(want[k] - got[k]) < 1e-12 for k in want)
    layout = prepare_graph(e, partitions=partitions, grid=True)
    found = shortest_paths(layout, 0)
    plain = shortest_paths(e, 0)
    assert found.improving_rounds == plain.improving_rounds
    assert sorted(found.distances.collect()) == sorted(plain.distances.collect())
    layout.close()
