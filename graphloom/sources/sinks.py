"""Text sinks: adjacency lines, distance and rank files, labelled rank lines.

Everything is rendered with ``format_string`` / ``array_join`` on the executors and
written by ``DataFrameWriter``: a folder of ordered part files, never a driver-side
loop. ``orderBy`` range-partitions the rows, so part files concatenate in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.rank import rank_order

INF = float("inf")


def render_adjacency(adjacency_rows: DataFrame) -> DataFrame:
    """``id, chunk, line`` with ``line = "id: [a, b, ...]"`` (``"id: []"`` for a sink); a long list has several lines."""
    return adjacency_rows.select(
        "id", "chunk",
        F.format_string("%s: [%s]", F.col("id"), F.array_join(F.col("out").cast("array<string>"), ", "))
        .alias("line"),
    )


def render_ranks(ranks: DataFrame) -> DataFrame:
    """``id, line`` with ``line = "Node <id>: <rank, 6 decimals>"``."""
    return ranks.select("id", F.format_string("Node %s: %.6f", F.col("id"), F.col("rank")).alias("line"))


def render_distance_lines(dist: DataFrame) -> DataFrame:
    """``id, line`` with ``line = "id,dist"``; unreachable written as ``inf``."""
    d = F.when(F.col("dist") == F.lit(INF), F.lit("inf")).otherwise(F.col("dist").cast("string"))
    return dist.select("id", F.concat_ws(",", F.col("id").cast("string"), d).alias("line"))


def render_rank_lines(ranks: DataFrame) -> DataFrame:
    return ranks.select(
        "id", "rank", F.concat_ws(",", F.col("id").cast("string"), F.col("rank").cast("string")).alias("line")
    )


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    lines.select("line").write.mode(mode).text(path)


def write_distances(dist: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``id,dist`` lines ordered by id."""
    write_lines(render_distance_lines(dist).orderBy("id"), path, mode)


def write_ranks(ranks: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``id,rank`` lines, highest rank first (id breaks ties)."""
    write_lines(render_rank_lines(ranks).orderBy(*rank_order()).select("line"), path, mode)


def write_labelled_ranks(ranks: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``Node <id>: <rank>`` lines ordered by id."""
    write_lines(render_ranks(ranks).orderBy("id"), path, mode)


def write_adjacency(adjacency_rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_lines(render_adjacency(adjacency_rows).orderBy("id", "chunk"), path, mode)
