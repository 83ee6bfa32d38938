"""graphloom: iterative graph analytics on Spark DataFrames.

Edge lists and adjacency lists become DataFrames; graph preparation,
single-source shortest paths and PageRank run as loops of Catalyst-planned
DataFrame rounds whose lineage is cut every round in the session's checkpoint folder
(reliable checkpoints, or parquet state tables for large graphs).
"""

from graphloom.plans.layout import GraphLayout, prepare_graph
from graphloom.plans.pagerank import PageRankResult, pagerank
from graphloom.plans.sssp import ShortestPathResult, shortest_paths

__all__ = [
    "GraphLayout",
    "PageRankResult",
    "ShortestPathResult",
    "pagerank",
    "prepare_graph",
    "shortest_paths",
]
