"""Hand-written edge cases."""

import os

import pytest
from pyspark.errors import PySparkException

from graphloom import pagerank, shortest_paths
from graphloom.plans.sssp import NegativeCycleError, distance_to
from graphloom.sources.text import (
    adjacency_to_edges,
    listed_vertices,
    malformed_edge_lines,
    parse_adjacency_lines,
    parse_edge_lines,
    read_adjacency,
    read_edges,
)

INF = float("inf")


def edges_of(spark, rows, weighted=True):
    if weighted:
        return spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    return spark.createDataFrame(rows, "src bigint, dst bigint")


def dist_map(result):
    return {r.id: r.dist for r in result.distances.collect()}


def write(path, text, newline="\n"):
    with open(path, "w", newline="") as f:
        f.write(text.replace("\n", newline))
    return path


def test_sink_and_unreachable_vertices(spark):
    # 2 is a sink (no out-edges), 3 -> 4 is unreachable from 0
    e = edges_of(spark, [(0, 1, 1.0), (1, 2, 2.0), (3, 4, 1.0)])
    d = dist_map(shortest_paths(e, 0))
    assert d == {0: 0.0, 1: 1.0, 2: 3.0, 3: INF, 4: INF}


def test_source_without_out_edges(spark):
    e = edges_of(spark, [(0, 1, 1.0), (1, 2, 2.0)])
    d = dist_map(shortest_paths(e, 2))
    assert d == {0: INF, 1: INF, 2: 0.0}


def test_source_not_in_graph(spark):
    e = edges_of(spark, [(0, 1, 1.0)])
    r = shortest_paths(e, 99)
    assert dist_map(r) == {0: INF, 1: INF}
    assert r.improving_rounds == 0
    assert distance_to(r, 99).count() == 0


def test_parallel_edges_keep_lightest_and_self_loop(spark):
    e = edges_of(spark, [(0, 1, 5.0), (0, 1, 2.0), (1, 1, 3.0), (1, 2, 1.0)])
    assert dist_map(shortest_paths(e, 0)) == {0: 0.0, 1: 2.0, 2: 3.0}


def test_zero_and_negative_weights(spark):
    e = edges_of(spark, [(0, 1, 0.0), (1, 2, -2.0), (0, 2, 1.0), (2, 3, 0.0)])
    assert dist_map(shortest_paths(e, 0)) == {0: 0.0, 1: 0.0, 2: -2.0, 3: -2.0}


def test_negative_cycle_is_reported(spark):
    e = edges_of(spark, [(0, 1, 1.0), (1, 2, -1.0), (2, 1, -1.0)])
    with pytest.raises(NegativeCycleError):
        shortest_paths(e, 0)


def test_string_ids(spark):
    e = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.5)], "src string, dst string, weight double")
    assert dist_map(shortest_paths(e, "a")) == {"a": 0.0, "b": 1.0, "c": 2.5}
    r = pagerank(e.select("src", "dst"), tol=None, max_iter=3)
    assert r.ranks.count() == 3


def test_empty_inputs_fail(spark, scratch):
    empty = edges_of(spark, [])
    with pytest.raises(ValueError):
        shortest_paths(empty, 0)
    with pytest.raises(ValueError):
        pagerank(empty.select("src", "dst"))
    path = write(os.path.join(scratch, "empty.txt"), "")
    adj = read_adjacency(spark, path)
    with pytest.raises(ValueError):
        pagerank(adjacency_to_edges(adj), listed=listed_vertices(adj))


def test_edge_list_crlf_spaces_blank_lines(spark, scratch):
    path = write(os.path.join(scratch, "e.txt"), "0, 1, 2\n\n1 ,2,  3.5\n2,0,1", newline="\r\n")
    rows = sorted(tuple(r) for r in read_edges(spark, path).collect())
    assert rows == [(0, 1, 2.0), (1, 2, 3.5), (2, 0, 1.0)]


def test_edge_list_fourth_field_and_bad_field(spark, scratch):
    four = write(os.path.join(scratch, "four.txt"), "0, 1, 2, 9\n")
    # fields after the third are ignored by the file reader and the column parser alike
    assert [tuple(r) for r in read_edges(spark, four).collect()] == [(0, 1, 2.0)]
    lines = spark.createDataFrame([("0, 1, 2, 9",), ("   ",), ("",)], "value string")
    assert [tuple(r) for r in parse_edge_lines(lines).collect()] == [(0, 1, 2.0)]
    bad = spark.createDataFrame([("0, x, 2",)], "value string")
    with pytest.raises(PySparkException):
        parse_edge_lines(bad).collect()
    mixed = write(os.path.join(scratch, "mixed.txt"), "0, 1, 2\n3, 4\n5, , 1\n\n6, 7, x\n8, 9, 1.5, note\n")
    with pytest.raises(PySparkException):
        read_edges(spark, mixed).collect()
    assert sorted(tuple(r) for r in read_edges(spark, mixed, strict=False).collect()) == [(0, 1, 2.0), (8, 9, 1.5)]
    told = malformed_edge_lines(spark.read.text(mixed)).collect()
    assert sorted(r.line for r in told) == ["3, 4", "5, , 1", "6, 7, x"]


def test_adjacency_empty_list_blank_line_repeated_vertex(spark, scratch):
    path = write(os.path.join(scratch, "adj.txt"), "0: [1, 2]\n\n1: []\n0: [2]\n2: [0, 0]\n")
    adj = read_adjacency(spark, path)
    rows = sorted((r.id, tuple(r.out)) for r in adj.collect())
    assert rows == [(0, (1, 2)), (0, (2,)), (1, ()), (2, (0, 0))]
    edges = adjacency_to_edges(adj)
    assert edges.count() == 5
    # a vertex on two lines: its edges are merged (degree 3); duplicates count
    r = pagerank(edges, listed=listed_vertices(adj), tol=None, max_iter=1)
    ranks = {x.id: x.rank for x in r.ranks.collect()}
    n, d = 3, 0.85
    dead = 1 / n  # vertex 1 has no out-edges
    base = (1 - d) / n + d * dead / n
    assert ranks[0] == pytest.approx(base + d * (2 * (1 / n) / 2))
    assert ranks[1] == pytest.approx(base + d * ((1 / n) / 3))
    assert ranks[2] == pytest.approx(base + d * (2 * (1 / n) / 3))


def test_adjacency_malformed_lines_fail(spark):
    for text in ("5 [1, 2]", "5: [1, x]", "x: [1]"):
        lines = spark.createDataFrame([(text,)], "value string")
        with pytest.raises(PySparkException):
            parse_adjacency_lines(lines).collect()


def test_all_vertices_dead_ends(spark):
    listed = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id bigint")
    no_edges = spark.createDataFrame([], "src bigint, dst bigint")
    r = pagerank(no_edges, listed=listed, tol=None, max_iter=3)
    ranks = [x.rank for x in r.ranks.collect()]
    assert len(ranks) == 4 and all(v == pytest.approx(0.25) for v in ranks)


def test_dead_end_mass_is_spread_and_total_kept(spark):
    e = edges_of(spark, [(0, 1), (0, 2), (1, 2), (3, 2)], weighted=False)
    r = pagerank(e, tol=1e-10, max_iter=200)
    assert r.converged
    assert sum(x.rank for x in r.ranks.collect()) == pytest.approx(1.0, abs=1e-9)
    assert r.trace.rounds[-1].metrics["total"] == pytest.approx(1.0, abs=1e-9)


def test_twice_mode_with_dead_ends_is_exact_to_formula_and_may_grow(spark):
    e = edges_of(spark, [(0, 1), (1, 2)], weighted=False)
    r = pagerank(e, damping_mode="twice", tol=None, max_iter=3)
    # vertex 2 is a dead end: mass is added twice per round, the total exceeds 1
    assert sum(x.rank for x in r.ranks.collect()) > 1.0
    assert not r.converged


def test_sources_only_loses_shares_to_unknown_targets(spark):
    e = edges_of(spark, [(0, 1), (0, 9), (1, 0)], weighted=False)
    r = pagerank(e, vertices="sources", tol=None, max_iter=1)
    ranks = {x.id: x.rank for x in r.ranks.collect()}
    assert set(ranks) == {0, 1}
    d, n = 0.85, 2
    assert ranks[1] == pytest.approx((1 - d) / n + d * (0.5 / 2))
    assert ranks[0] == pytest.approx((1 - d) / n + d * 0.5)


def test_negative_cycle_out_of_reach_is_fine(spark):
    e = edges_of(spark, [(0, 1, 1.0), (5, 6, -1.0), (6, 5, -1.0)])
    assert dist_map(shortest_paths(e, 0)) == {0: 0.0, 1: 1.0, 5: INF, 6: INF}


def test_max_rounds_stops_early(spark):
    e = edges_of(spark, [(i, i + 1, 1.0) for i in range(6)])
    r = shortest_paths(e, 0, max_rounds=2)
    assert r.trace.stop_reason == "max_rounds" and r.trace.count == 2
    d = dist_map(r)
    assert d[2] == 2.0 and d[3] == INF


def test_unweighted_edges_count_hops_and_weightless_layout_is_rejected(spark):
    from graphloom.plans.layout import prepare_graph

    e = edges_of(spark, [(0, 1), (1, 2), (0, 2)], weighted=False)
    assert dist_map(shortest_paths(e, 0)) == {0: 0.0, 1: 1.0, 2: 1.0}
    with pytest.raises(ValueError):
        shortest_paths(prepare_graph(e, weight=None), 0)


def test_sources_only_with_a_listed_dead_end(spark, scratch):
    # 0: [1, 9]  1: [2]  2: []   (9 is not listed; 2 is a listed dead end)
    path = write(os.path.join(scratch, "adj_dead.txt"), "0: [1, 9]\n1: [2]\n2: []\n")
    adj = read_adjacency(spark, path)
    r = pagerank(adjacency_to_edges(adj), listed=listed_vertices(adj), vertices="sources",
                 tol=None, max_iter=2)
    got = {x.id: x.rank for x in r.ranks.collect()}
    d, n = 0.85, 3
    ranks = {0: 1 / n, 1: 1 / n, 2: 1 / n}
    for _ in range(2):
        dead = ranks[2]
        new = {v: (1 - d) / n + d * dead / n for v in ranks}
        new[1] += d * ranks[0] / 2          # the share to 9 is lost
        new[2] += d * ranks[1]
        ranks = new
    assert set(got) == {0, 1, 2}
    assert all(got[v] == pytest.approx(ranks[v], abs=1e-15) for v in ranks)
