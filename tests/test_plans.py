"""Physical-plan and operator checks: what moves, what is bounded, what is kept."""

import pytest
from pyspark.sql import functions as F

from graphloom import prepare_graph
from graphloom.operators import graph as gops
from graphloom.operators import rank as rops
from graphloom.plans.loop import loop_partitions
from graphloom.plans.pagerank import initial_state, rank_round
from graphloom.plans.sssp import relax_frontier
from graphloom.sources.generator import link_table


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hub_graph(spark):
    # vertex 0 is a hub with 40 distinct targets (plus duplicates); a small ring
    rows = [(0, t) for t in range(1, 41)] + [(0, 1)] * 5 + [(t, t + 1) for t in range(1, 40)] + [(40, 0)]
    return spark.createDataFrame(rows, "src bigint, dst bigint")


def test_prepared_tables_are_bucketed(spark, hub_graph):
    layout = prepare_graph(hub_graph, partitions=4, bucket_size=10, weight=None)
    # no constant weight column is carried for PageRank layouts
    assert layout.edges.columns == ["src", "salt", "dst", "mult"] and not layout.weighted
    # buckets meet without an exchange: vertices with edges, hot edges with themselves
    met = layout.cold.hint("shuffle_hash").join(layout.vertices, layout.cold["src"] == layout.vertices["id"])
    other = layout.hot.select(F.col("src").alias("s"), F.col("salt").alias("t"))
    salted = layout.hot.hint("shuffle_hash").join(other, (F.col("src") == F.col("s")) & (F.col("salt") == F.col("t")))
    for frame in (met, salted):
        plan = executed(frame)
        assert "ShuffledHashJoin" in plan and "Exchange" not in plan
    # duplicates collapsed with their multiplicity
    assert layout.num_edges == 85 and layout.num_distinct_edges == 80
    # the hub is split into ceil(40 / 10) buckets, every other source into one
    nb = {r.id: r.nb for r in layout.vertices.collect()}
    assert nb[0] == 4 and all(v == 1 for k, v in nb.items() if k != 0)
    per_salt = {r.salt: r.c for r in layout.edges.where("src = 0").groupBy("salt").agg(F.count("*").alias("c")).collect()}
    assert sum(per_salt.values()) == 40 and len(per_salt) > 1


def test_a_round_moves_only_its_messages(spark, hub_graph):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    with loop_partitions(spark, 4):
        layout = prepare_graph(hub_graph, partitions=4, bucket_size=10, weight=None)
        plans = [executed(rank_round(layout, initial_state(layout), 0.85, 0.0, "standard"))]
        weighted = prepare_graph(hub_graph, partitions=4, bucket_size=10)
        state = weighted.vertices.select("id", "nb", F.lit(0.0).alias("dist"), F.lit(True).alias("active"))
        plans.append(executed(relax_frontier(weighted, state)))
        parents = state.withColumn("parent", F.lit(None).cast("bigint"))
        plans.append(executed(relax_frontier(weighted, parents, [1, 2])))
    for p in plans:
        # the messages, reduced on the map side first; hot sources are broadcast
        assert p.count("Exchange hashpartitioning") == 1 and p.count("BroadcastExchange") == 1
        assert p.count("ShuffledHashJoin") == 2 and "partial_" in p
    assert "block#" in plans[2].split("PartitionFilters", 1)[1] and "IN (1,2)" in plans[2]


def test_with_position_is_a_total_order(spark):
    rows = [(i, float((i * 37) % 11)) for i in range(200)]
    ranks = spark.createDataFrame(rows, "id bigint, rank double")
    got = [(r.id, r.pos) for r in rops.with_position(ranks, partitions=5).collect()]
    want = sorted(rows, key=lambda x: (-x[1], x[0]))
    assert sorted(got, key=lambda x: x[1]) == [(w[0], i + 1) for i, w in enumerate(want)]


def test_top_k_and_extremes(spark):
    rows = [(i, float((i * 37) % 11)) for i in range(50)]
    ranks = spark.createDataFrame(rows, "id bigint, rank double")
    top = [(r.id, r.pos) for r in rops.top_k(ranks, 3).orderBy("pos").collect()]
    want = sorted(rows, key=lambda x: (-x[1], x[0]))[:3]
    assert top == [(w[0], i + 1) for i, w in enumerate(want)]
    ex = rops.extremes(ranks).first()
    assert (ex.max_id, ex.max_rank) == (want[0][0], 10.0)
    low = sorted(rows, key=lambda x: (x[1], x[0]))[0]
    assert (ex.min_id, ex.min_rank) == low


def test_adjacency_lists_have_a_fixed_length(spark, hub_graph):
    lists = gops.adjacency(hub_graph, max_len=8)
    hub = [r for r in lists.where("id = 0").collect()]
    assert sorted(x for r in hub for x in r.out) == sorted([t for t in range(1, 41)] + [1] * 5)
    assert len({r.chunk for r in hub}) == len(hub) >= 6
    assert all(len(r.out) <= 8 and r.out == sorted(r.out) for r in hub)
    others = lists.where("id <> 0").collect()
    assert all(len(r.out) == 1 and r.chunk == 0 for r in others)


@pytest.mark.parametrize("max_len", [3, 10, 1000])
def test_adjacency_rows_do_not_depend_on_the_session(spark, max_len):
    # a hub with repeats, and one edge repeated 100 times
    rows = [(0, t % 70, 1.0 + t % 2) for t in range(150)] + [(1, 5, 2.0)] * 100 + [(2, None, 1.0), (None, 3, float("nan"))]
    e = spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    key, got = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(key)
    try:
        for parts in (1, 8, 200):
            spark.conf.set(key, parts)
            lists = gops.adjacency(e, max_len).collect()
            assert all(len(r.out) <= max_len for r in lists)
            weighted = gops.adjacency_weighted(e, max_len).collect()
            assert sum(len(r.out_dst) for r in weighted) == len(rows) and all(len(r.out_dst) <= max_len for r in weighted)
            got.append(sorted(map(repr, lists + weighted)))
    finally:
        spark.conf.set(key, before)
    assert got[0] == got[1] == got[2]
    # the repeated edge: full chunks, then the rest
    one = sorted((len(r.out) for r in gops.adjacency(e, max_len).where("id = 1").collect()), reverse=True)
    assert one == [max_len] * (100 // max_len) + ([100 % max_len] if 100 % max_len else [])


def test_generator_draws_distinct_targets_and_keeps_empty_lists(spark):
    from graphloom.sources.generator import link_lists

    for n in (1, 2, 3, 11, 60):
        lists = {r.id: r.out for r in link_lists(spark.range(n), seed=3).collect()}
        assert sorted(lists) == list(range(n))
        assert all(len(set(out)) == len(out) <= 10 and i not in out for i, out in lists.items())


def test_generator_permutes_any_range(spark):
    from graphloom.sources import generator as gen

    # primes leave cells of the grid over, so images walk on
    for n in (2, 3, 5, 7, 16, 97, 211):
        a, b = gen.grid(n)
        assert n <= a * b < n + a
        image = gen.permuted(F.col("id"), F.lit(11).cast("bigint"), n, 5)
        assert sorted(r.v for r in spark.range(n).select(image.alias("v")).collect()) == list(range(n))
    a, b = gen.grid(10**12 + 39)
    assert 0 <= a * b - (10**12 + 39) < 16


def test_generator_draws_every_pair_alike(spark):
    from graphloom.sources import generator as gen

    draws = 20_000
    slots = spark.range(draws).select(F.col("id").alias("key"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(1).cast("bigint"))).alias("v"))
    images = slots.select("key", gen.permuted(F.col("v"), F.col("key"), 5, 42).alias("v"))
    pairs = images.groupBy("key").agg(F.sort_array(F.collect_list("v")).alias("pair"))
    seen = {tuple(r.pair): r["count"] for r in pairs.groupBy("pair").count().collect()}
    assert len(seen) == 10 and all(len(set(p)) == 2 for p in seen)
    assert all(abs(c - draws / 10) < draws / 100 for c in seen.values()), seen


def test_link_table_is_repeatable_and_clean(spark):
    nodes = spark.range(50).select((F.col("id") * 3 + 7).alias("id"))
    a = sorted(tuple(r) for r in link_table(nodes, seed=7).collect())
    b = sorted(tuple(r) for r in link_table(nodes, seed=7).collect())
    c = sorted(tuple(r) for r in link_table(nodes, seed=8).collect())
    assert a == b and a != c
    ids = {i * 3 + 7 for i in range(50)}
    assert all(s in ids and d in ids and s != d for s, d in a)
    deg = {}
    for s, _ in a:
        deg[s] = deg.get(s, 0) + 1
    assert max(deg.values()) <= 10 and len(set(a)) == len(a)


def test_graph_stats_counts_duplicates_and_self_loops(spark):
    e = spark.createDataFrame([(1, 2), (1, 2), (2, 2), (2, 3)], "src bigint, dst bigint")
    s = gops.graph_stats(e).first().asDict()
    assert s == {"num_edges": 4, "num_distinct_edges": 3, "num_self_loops": 1,
                 "num_vertices": 3, "num_sources": 2, "num_sinks": 1}


def test_hot_source_with_a_third_of_all_edges_is_spread(spark):
    # source 0 owns 3,000 of 9,000 edges; every other source has 3
    hub = [(0, 10_000 + t) for t in range(3000)]
    rest = [(s, (s * 7 + k) % 2000 + 1) for s in range(1, 2001) for k in range(3)]
    e = spark.createDataFrame(hub + rest, "src bigint, dst bigint")
    layout = prepare_graph(e, partitions=8, bucket_size=400, weight=None)
    sizes = [r.c for r in layout.edges.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count("*").alias("c")).collect()]
    assert sum(sizes) == layout.num_distinct_edges
    # without salting one partition would hold at least 3,000 hub edges
    assert max(sizes) < 2000
    hub_salts = layout.edges.where("src = 0").select("salt").distinct().count()
    assert hub_salts == 8  # ceil(3000 / 400) buckets, all used


def test_single_step_operators_split_a_hot_source(spark):
    from graphloom.operators import relax as xops
    from graphloom.operators.salting import hot_keys

    hub = [(0, 100 + t % 5000, 1.0 + t % 3) for t in range(30000)]      # hub with duplicates
    rest = [(s, (s * 7) % 90 + 1, 2.0) for s in range(1, 90) for _ in range(3)]
    rows = hub + rest
    e = spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    pairs = e.groupBy("src", "dst").count()
    hot = {r._hk: r._nb for r in hot_keys(pairs, "src", partitions=8, min_bucket=100).collect()}
    assert list(hot) == [0] and hot[0] > 1
    # contributions == brute force
    verts = {a for a, _, _ in rows} | {b for _, b, _ in rows}
    n = len(verts)
    deg = {}
    for a, _, _ in rows:
        deg[a] = deg.get(a, 0) + 1
    want = {}
    for a, b, _ in rows:
        want[b] = want.get(b, 0.0) + (1.0 / n) / deg[a]
    ranks = spark.createDataFrame([(v, 1.0 / n) for v in verts], "id bigint, rank double")
    got = {r.id: r.contrib for r in rops.contributions(e.select("src", "dst"), ranks).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    # relax_once from the hub
    d0 = spark.createDataFrame([(v, 0.0 if v == 0 else float("inf")) for v in verts], "id bigint, dist double")
    best = {}
    for a, b, w in rows:
        if a == 0:
            best[b] = min(best.get(b, float("inf")), w)
    got = {r.id: r.dist for r in xops.relax_once(e, d0).collect()}
    assert all(got[v] == (0.0 if v == 0 else best.get(v, float("inf"))) for v in verts)
    # known_targets keeps duplicates
    known = spark.createDataFrame([(v,) for v in range(100, 103)], "id bigint")
    kept = gops.known_targets(e, known).count()
    assert kept == sum(1 for _, b, _ in rows if 100 <= b < 103)
