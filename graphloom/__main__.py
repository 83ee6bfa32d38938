"""Command line: the published jobs as Spark applications (``python -m graphloom``, or
``spark-submit --py-files graphloom.zip graphloom/__main__.py``).

    sssp INPUT OUTPUT [--source 0] [--target T]        edge list -> "id,dist" lines by id
    pagerank INPUT OUTPUT [--mode standard|twice] [--tol 1e-4] [--max-iter 50]
             [--rounds K] [--vertices all|sources] [--format adjacency|edges] [--labelled]
                                                      -> "id,rank" lines, highest first
                                                         (--labelled: "Node id: rank" by id)
    links OUTPUT [--nodes 100] [--seed 42] [--max-links 10]   -> "id: [a, b]" lines
    report RUNS OUTPUT                                run folders (glob) -> report lines

Outputs are folders of ordered part files. Only scalars are printed.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session() -> SparkSession:
    from graphloom.session import require_checkpoint_dir

    spark = SparkSession.builder.appName("graphloom").getOrCreate()
    require_checkpoint_dir(spark)
    return spark


def run_sssp(spark: SparkSession, args) -> dict:
    from graphloom import shortest_paths
    from graphloom.plans.sssp import distance_to
    from graphloom.sources.sinks import write_distances
    from graphloom.sources.text import read_edges

    result = shortest_paths(read_edges(spark, args.input), args.source)
    write_distances(result.distances, args.output)
    out = {"improving_rounds": result.improving_rounds, "rounds": result.trace.count}
    if args.target is not None:
        hit = distance_to(result, args.target).first()
        out["target"] = args.target
        out["distance"] = None if hit is None else hit["dist"]
    return out


def run_pagerank(spark: SparkSession, args) -> dict:
    from graphloom import pagerank
    from graphloom.operators.rank import extremes
    from graphloom.sources.sinks import write_labelled_ranks, write_ranks
    from graphloom.sources.text import adjacency_to_edges, listed_vertices, read_adjacency, read_edges

    if args.format == "adjacency":
        adj = read_adjacency(spark, args.input)
        edges, listed = adjacency_to_edges(adj), listed_vertices(adj)
    else:
        edges, listed = read_edges(spark, args.input).select("src", "dst"), None
    tol = None if args.rounds is not None else args.tol
    max_iter = args.rounds if args.rounds is not None else args.max_iter
    result = pagerank(edges, damping=args.damping, tol=tol, max_iter=max_iter,
                      damping_mode=args.mode, vertices=args.vertices, listed=listed)
    (write_labelled_ranks if args.labelled else write_ranks)(result.ranks, args.output)
    ex = extremes(result.ranks).first()
    return {
        "rounds": result.rounds, "converged": result.converged,
        "highest": [ex["max_id"], ex["max_rank"]], "lowest": [ex["min_id"], ex["min_rank"]],
    }


def run_links(spark: SparkSession, args) -> dict:
    from graphloom.sources.generator import link_lists
    from graphloom.sources.sinks import write_adjacency
    from graphloom.sources.text import read_adjacency

    nodes = spark.range(args.nodes).select(F.col("id"))
    write_adjacency(link_lists(nodes, seed=args.seed, max_links=args.max_links), args.output)
    # counted in what was written, so that the links are drawn once
    links = read_adjacency(spark, args.output).agg(F.sum(F.size("out"))).first()[0]
    return {"nodes": args.nodes, "links": links or 0}


def run_report(spark: SparkSession, args) -> dict:
    from pyspark.errors import AnalysisException

    from graphloom.operators.runmetrics import run_summary, write_report
    from graphloom.sources.runlogs import read_records

    frames = {}
    for kind in ("jobs", "stages", "executors"):
        try:  # any file system: let Spark resolve the glob; a kind may be missing
            frames[kind] = read_records(spark, args.runs, kind)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    present = set(frames)
    summary = run_summary(**frames)
    write_report(summary, args.output)
    return {"kinds": sorted(present), "apps": summary.select("app_id").distinct().count()}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="graphloom", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("sssp")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--source", type=int, default=0)
    s.add_argument("--target", type=int)
    r = sub.add_parser("pagerank")
    r.add_argument("input")
    r.add_argument("output")
    r.add_argument("--mode", choices=("standard", "twice"), default="standard")
    r.add_argument("--damping", type=float, default=0.85)
    r.add_argument("--tol", type=float, default=1e-4)
    r.add_argument("--max-iter", type=int, default=50)
    r.add_argument("--rounds", type=int, help="fixed number of rounds (no tolerance test)")
    r.add_argument("--vertices", choices=("all", "sources"), default="all")
    r.add_argument("--format", choices=("adjacency", "edges"), default="adjacency")
    r.add_argument("--labelled", action="store_true")
    g = sub.add_parser("links")
    g.add_argument("output")
    g.add_argument("--nodes", type=int, default=100)
    g.add_argument("--seed", type=int, default=42)
    g.add_argument("--max-links", type=int, default=10)
    m = sub.add_parser("report")
    m.add_argument("runs")
    m.add_argument("output")
    return p


COMMANDS = {"sssp": run_sssp, "pagerank": run_pagerank, "links": run_links, "report": run_report}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = spark or _session()
    out = COMMANDS[args.command](spark, args)
    print(out)
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
