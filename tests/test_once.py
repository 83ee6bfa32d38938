"""Edges are computed once: one scan of the given table a query, eager jobs included; the sketch finds the hot keys."""

import glob
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from graphloom.operators import graph as gops
from graphloom.operators import rank as rops
from graphloom.operators.salting import salted_join, write_once

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"
KEYS = {  # the table each reads
    "contributions": "pages", "contributions_split": "events", "rank_l1_diff": "pages", "rank_outer_fill": "pages",
    "dead_end_mass": "pages", "known_targets": "lineitem", "relax_once": "lineitem", "relax_split": "lineitem",
    "sssp_changed": "lineitem", "adjacency_build": "lineitem", "adjacency_explode": "lineitem", "vertex_complete": "pages",
}

PROGRAM = """
import sys
from pyspark.sql import SparkSession
from graphloom.catalog import QUERIES
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1] + "/shared").config("spark.sql.warehouse.dir", sys.argv[1] + "/wh")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + sys.argv[1] + "/events")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").getOrCreate())
for key in sys.argv[3:]:
    spark.sparkContext.addJobTag(key)
    QUERIES[key](spark, sys.argv[2]).collect()
    spark.sparkContext.removeJobTag(key)
spark.stop()
"""


def scans(log, table):
    """Per tag: how often ``table`` was read by jobs, counted by the files that scans told of."""
    from collections import Counter

    metric, tags, read = {}, {}, Counter()
    events = [json.loads(line) for line in open(log)]

    def visit(node, execution):
        if "Scan parquet" in node["nodeName"] and f"/{table}.parquet" in node.get("metadata", {}).get("Location", ""):
            for m in node["metrics"]:
                if m["name"] == "number of files read":
                    metric[m["accumulatorId"]] = execution
        for child in node["children"]:
            visit(child, execution)

    for e in events:
        if "sparkPlanInfo" in e and "executionId" in e:
            tags.setdefault(e["executionId"], e.get("jobTags") or [])
            visit(e["sparkPlanInfo"], e["executionId"])
    for e in events:
        if e["Event"].endswith("SparkListenerDriverAccumUpdates"):
            for key, value in e["accumUpdates"]:
                if key in metric:
                    for tag in tags[metric[key]]:
                        read[tag] += value
    return read


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not available")
def test_each_query_reads_its_table_once(scratch):
    for folder in ("shared", "events", "wh"):
        os.makedirs(f"{scratch}/{folder}")
    done = subprocess.run([sys.executable, "-c", PROGRAM, scratch, SF, *KEYS], cwd=ROOT, capture_output=True, text=True,
                          timeout=600, env={**os.environ, "PYTHONPATH": ROOT})
    assert done.returncode == 0, done.stderr[-3000:]
    log = glob.glob(f"{scratch}/events/*")[0]
    read = {t: scans(log, t) for t in set(KEYS.values())}
    assert {k: read[t][k] for k, t in KEYS.items()} == dict.fromkeys(KEYS, 1)
    assert not os.listdir(f"{scratch}/shared") or not glob.glob(f"{scratch}/shared/graphloom_rows_*")


def hub(spark, n=9000):
    third = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100)
    return spark.range(n).select(third.cast("bigint").alias("src"), (F.col("id") * 13 + 1).alias("dst"))


def test_the_sketch_told_beside_the_write_names_the_hub(spark):
    w = write_once(hub(spark), ["src", "dst"])
    assert w.rows == 9000 and w.frame.count() == 9000
    hot = {r["_hk"]: r["_nb"] for r in w.hot("src", 500).collect()}
    assert hot == {7: 6}
    assert w.hot("dst", 500) is None and w.hot("src", 9000) is None
    # more buckets than the sketch is certain for: the written rows are counted
    exact = {r["_hk"]: r["_nb"] for r in w.hot("src", 2).collect()}
    assert exact == {7: 1500}
    w.close()


def test_text_keys_nulls_and_empty_frames(spark):
    rows = [("a", str(i)) for i in range(60)] + [(None, "x")] * 50 + [("b", "y")]
    w = write_once(spark.createDataFrame(rows, "k string, v string"), ["k"])
    assert {r["_hk"]: r["_nb"] for r in w.hot("k", 10).collect()} == {"a": 6}
    small = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, w int")
    got = salted_join(w, small, "k", "id", "v", bucket=10)
    assert got.columns == ["k", "v", "w"] and got.groupBy("k", "w").count().orderBy("k").collect() == [("a", 1, 60), ("b", 2, 1)]
    left = salted_join(w, small, "k", "id", "v", how="left", bucket=10)
    assert left.count() == 111 and left.where("w is null").count() == 50
    none = write_once(spark.createDataFrame([], "k string, v string"), ["k"])
    assert none.rows == 0 and none.hot("k", 1) is None and salted_join(none, small, "k", "id", "v").count() == 0


def test_a_split_hub_changes_no_result(spark):
    e = hub(spark, 1500).unionByName(hub(spark, 30))  # some edges twice
    ranks = rops.uniform_ranks(gops.vertex_set(e))
    plain = {r.id: round(r.contrib, 12) for r in rops.contributions(e, ranks).collect()}
    split = {r.id: round(r.contrib, 12) for r in rops.contributions(e, ranks, bucket=3).collect()}
    assert plain == split and len(plain) == 1500
    into = e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    known = spark.createDataFrame([(7,)], "id bigint")
    assert gops.known_targets(into, known, bucket=3).count() == gops.known_targets(into, known).count() == 510
    deg = {r.id: r.out_degree for r in gops.out_degree(e).collect()}
    pairs = gops.written_pairs(e)
    assert deg == {r.id: r.out_degree for r in gops.out_degree(pairs.frame, copies="mult").collect()}
