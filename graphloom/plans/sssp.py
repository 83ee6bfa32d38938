"""Single-source shortest paths (Bellman-Ford rounds) as a loop of DataFrame rounds.

Only vertices whose distance dropped in the last round (the frontier) send
``dist + weight`` along their out-edges, and only the blocks of the edge table that hold such vertices are
read: the blocks of the frontier are observed while the round before writes it. The candidates are reduced with
``min`` per id (partial minimum on the map side first) and meet the vertex rows in their buckets. The
distances after each round equal those of relaxing every edge, so the number of
improving rounds is the same as in the published runs. Unreachable vertices keep ``Infinity``.

Zero and negative weights work. Where the least weight is negative, the state carries the parent that gave each
distance. Parents form a forest unless a negative cycle is reachable; after rounds 1, 2, 4, 8, ... they are searched for
a cycle by pointer doubling, and a cycle ends the run with its edges. Without negative weights
there is no parent column and no search.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.plans.cycles import one_cycle
from graphloom.plans.layout import GraphLayout, prepare_graph
from graphloom.plans.loop import LoopTrace, choose_store, iterate, loop_partitions
from graphloom.plans.tables import RunTables, block_of, blocks_of

INF = float("inf")


class NegativeCycleError(ValueError):
    """``cycle``: the edges ``pos, src, dst, weight`` of one negative cycle, from its smallest vertex on."""

    def __init__(self, message: str, cycle: DataFrame | None = None):
        super().__init__(message)
        self.cycle = cycle


@dataclass
class ShortestPathResult:
    distances: DataFrame   # id, dist (Infinity when unreachable)
    layout: GraphLayout
    trace: LoopTrace

    @property
    def improving_rounds(self) -> int:
        return sum(1 for r in self.trace.rounds if int(r.metrics["changed"]) > 0)

    @property
    def round_seconds(self) -> list[float]:
        return [r.seconds for r in self.trace.rounds]


# One round as one statement (analysed once per round).
ROUND_SQL = """
WITH candidates AS (MESSAGES),
best AS (SELECT id, min(value) AS best FROM candidates GROUP BY id)
SELECT /*+ SHUFFLE_HASH(b) */ v.id, v.nb, least(v.dist, b.best) AS dist, coalesce(b.best < v.dist, false) AS active
FROM {state} v LEFT JOIN best b ON v.id = b.id
"""
# the same with the sender of the best candidate
PARENT_SQL = """
WITH candidates AS (MESSAGES),
best AS (SELECT id, min(value) AS best, min_by(via, value) AS via FROM candidates GROUP BY id)
SELECT /*+ SHUFFLE_HASH(b) */ v.id, v.nb, least(v.dist, b.best) AS dist, coalesce(b.best < v.dist, false) AS active,
       CASE WHEN b.best < v.dist THEN b.via ELSE v.parent END AS parent
FROM {state} v LEFT JOIN best b ON v.id = b.id
"""


def relax_frontier(layout: GraphLayout, state: DataFrame, blocks: list[int] | None = None) -> DataFrame:
    """One round from ``state (id, nb, dist, active[, parent])`` (lazy): only the frontier sends. ``blocks`` are
    those of the edge table that hold frontier vertices, where known."""
    parents = "parent" in state.columns
    messages = layout.messages("s.dist + e.weight", "active", ", e.src AS via" if parents else "")
    query = (PARENT_SQL if parents else ROUND_SQL).replace("MESSAGES", messages)
    return state.sparkSession.sql(query, state=state, **layout.frames(blocks))


def frontier_blocks(metrics: dict) -> list[int] | None:
    """The blocks that a round's metrics name; None before the first round."""
    bits = metrics.get("blocks")
    return None if bits is None else [8 * i + j for i, byte in enumerate(bytes(bits)) for j in range(8) if byte >> j & 1]


def negative_cycle(layout: GraphLayout, state: DataFrame, rounds: int) -> DataFrame | None:
    """The edges of a cycle among the parents of ``state`` after ``rounds`` rounds, or None."""
    tables = RunTables(state.sparkSession, "cycle")
    # an edge of a chain was laid in a round of its own
    ring = one_cycle(state.select("id", "parent"), tables, rounds + 1)
    if ring is None:
        tables.close()
        return None
    edges = layout.edges.select("src", "dst", "weight")
    found = ring.join(edges, (edges["dst"] == ring["id"]) & (edges["src"] == ring["parent"])).select("pos", "src", "dst", "weight")
    # a row leads from its parent: the edge into the smallest vertex is the last one
    size = ring.count()
    found = tables.save(found.withColumn("pos", F.pmod(F.col("pos") - 1, F.lit(size))), "cycle")
    tables.close(keep=("cycle",))
    return found


def shortest_paths(
    edges: DataFrame | GraphLayout,
    source,
    max_rounds: int | None = None,
    partitions: int | None = None,
    bucket_size: int | None = None,
    state_store: str = "table",
) -> ShortestPathResult:
    """Distances from ``source`` over ``src, dst, weight`` edges (parallel edges: the lightest)."""
    if isinstance(edges, GraphLayout):
        layout = edges
    else:
        layout = prepare_graph(edges, vertices="all", partitions=partitions,
                               bucket_size=bucket_size, weight="weight")
    if not layout.weighted:
        raise ValueError("shortest paths need edge weights: prepare the graph with a weight column")
    n = layout.num_vertices
    if n == 0:
        raise ValueError("shortest paths need at least one edge; the graph is empty")
    spark = layout.vertices.sparkSession
    is_source = F.col("id") == F.lit(source)
    columns = ["id", "nb", F.when(is_source, F.lit(0.0)).otherwise(F.lit(INF)).alias("dist"), is_source.alias("active")]
    parents = layout.min_weight is not None and layout.min_weight < 0
    if parents:
        columns.append(F.lit(None).cast(layout.vertices.schema["id"].dataType).alias("parent"))
    state = layout.vertices.select(*columns)
    states: dict[int, DataFrame] = {}

    def step(st: DataFrame, k: int, last: dict) -> DataFrame:
        blocks = frontier_blocks(last)
        whole = blocks is None or len(blocks) == blocks_of(layout.partitions)
        return relax_frontier(layout, st, None if whole else blocks)

    def metrics(k: int) -> dict:
        sends = F.when(F.col("active") & (F.col("nb") == 1), block_of("id", layout.partitions).cast("bigint"))
        return {"changed": F.count_if(F.col("active")), "blocks": F.bitmap_construct_agg(sends)}

    def keep(k: int, st: DataFrame) -> None:
        states.clear()
        states[k] = st

    def stop(k: int, m: dict) -> str | None:
        if int(m["changed"]) == 0:
            return "converged"
        if parents and k & (k - 1) == 0:
            cycle = negative_cycle(layout, states[k], k)
            if cycle is not None:
                raise NegativeCycleError(f"a negative cycle is reachable: found after {k} rounds", cycle)
        if max_rounds is not None and k >= max_rounds:
            return "max_rounds"
        return None

    store = choose_store(spark, keep_all=False, store=state_store, buckets=layout.partitions)
    with loop_partitions(spark, layout.partitions), layout.planned():
        final, trace = iterate(state, step, metrics, stop, name="sssp", store=store, keep=keep)
    if not isinstance(edges, GraphLayout):
        layout.close()  # a graph that the caller prepared stays theirs
    return ShortestPathResult(final.select("id", "dist"), layout, trace)


def distance_to(result: ShortestPathResult, target) -> DataFrame:
    """Point lookup of one vertex, in the one bucket that can hold it; an empty frame when ``target`` is not a vertex."""
    return result.distances.where(F.col("id") == F.lit(target))
