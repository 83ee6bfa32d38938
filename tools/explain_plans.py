"""Print the formatted physical plans of the main pieces, for review.

    python tools/explain_plans.py [sf_dir]

Shows a PageRank round and a shortest-path round over a prepared graph (the edge scan
has no exchange above it; two exchanges per round), the graph derivations (pruned
parquet scans), and a salted single-step join.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(sf_dir: str) -> None:
    from pyspark.sql import functions as F

    from graphloom.operators import rank as rops
    from graphloom.operators.graph import vertex_set
    from graphloom.plans.layout import prepare_graph
    from graphloom.plans.pagerank import initial_state, rank_round
    from graphloom.plans.sssp import relax_frontier
    from graphloom.session import build_session
    from graphloom.sources.tables import g_events, g_href, g_orders

    spark = build_session()
    g = g_orders(spark, sf_dir)
    layout = prepare_graph(g)
    sections = {
        "PageRank round": rank_round(layout, initial_state(layout), 0.85, 0.0, "standard"),
        "shortest-path round": relax_frontier(
            layout, layout.vertices.select("id", "nb", F.lit(0.0).alias("dist"), F.lit(True).alias("active"))
        ),
        "g_orders": g,
        "g_events": g_events(spark, sf_dir),
        "g_href": g_href(spark, sf_dir),
    }
    h = g_href(spark, sf_dir)
    sections["contributions (salted join)"] = rops.contributions(h, rops.uniform_ranks(vertex_set(h)))
    for title, frame in sections.items():
        print(f"\n======== {title} ========")
        frame.explain("formatted")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
