"""File-writing side of the sinks: ordered part files, round trips."""

import glob
import os

from graphloom import pagerank, shortest_paths
from graphloom.operators.graph import complete_vertices
from graphloom.sources import sinks
from graphloom.sources.text import adjacency_to_edges, read_adjacency


def read_lines(folder):
    out = []
    for part in sorted(glob.glob(os.path.join(folder, "part-*"))):
        out.extend(open(part).read().splitlines())
    return out


def test_distance_and_rank_files(spark, scratch):
    e = spark.createDataFrame(
        [(0, 1, 2.0), (0, 2, 3.0), (1, 2, 10.0), (1, 4, 1.0), (2, 1, 5.0), (2, 3, 2.0), (2, 4, 6.0),
         (3, 0, 7.0), (3, 4, 2.0), (4, 3, 1.0), (7, 8, 1.0)],
        "src bigint, dst bigint, weight double",
    )
    r = shortest_paths(e, 0)
    sinks.write_distances(r.distances, os.path.join(scratch, "dist"))
    assert read_lines(os.path.join(scratch, "dist")) == [
        "0,0.0", "1,2.0", "2,3.0", "3,4.0", "4,3.0", "7,inf", "8,inf"
    ]
    pr = pagerank(e.select("src", "dst"), tol=None, max_iter=3)
    sinks.write_ranks(pr.ranks, os.path.join(scratch, "ranks"))
    lines = read_lines(os.path.join(scratch, "ranks"))
    values = [float(x.split(",")[1]) for x in lines]
    assert len(lines) == 7 and values == sorted(values, reverse=True)
    sinks.write_labelled_ranks(pr.ranks, os.path.join(scratch, "labelled"))
    labelled = read_lines(os.path.join(scratch, "labelled"))
    assert [x.split(":")[0] for x in labelled] == [f"Node {i}" for i in (0, 1, 2, 3, 4, 7, 8)]
    assert all(len(x.split(": ")[1].split(".")[1]) == 6 for x in labelled)


def test_adjacency_file_round_trip(spark, scratch):
    e = spark.createDataFrame([(0, 2), (0, 1), (1, 2), (3, 0), (3, 0)], "src bigint, dst bigint")
    folder = os.path.join(scratch, "adj")
    sinks.write_adjacency(complete_vertices(e), folder)
    assert read_lines(folder) == ["0: [1, 2]", "1: [2]", "2: []", "3: [0, 0]"]
    back = adjacency_to_edges(read_adjacency(spark, folder))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in e.collect())
