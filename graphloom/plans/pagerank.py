"""PageRank as a loop of DataFrame rounds.

Per round: the vertex state ``(id, deg, nb, rank)`` meets the edges in their common buckets; each
edge emits ``rank / deg * mult`` to its target; the messages are summed per id (map-side partial sums first,
so a target with a huge in-degree costs one row per task before the shuffle) and meet the state in its
buckets: only the messages move. Dead-end mass, the L1 change
and the rank total come back as observed metrics of the same action.

Formulas (``n`` vertices, ``d`` damping, ``S`` the summed in-shares, ``D`` the rank
held by vertices without out-edges in the previous round):

* ``standard``: ``r = (1-d)/n + d*S + d*D/n``;
* ``twice`` (reproduces the published ranking, which applies the damping step twice):
  ``inner = d*S + (1-d)/n + d*D/n`` for a vertex with in-edges, else 0;
  ``r = d*inner + (1-d)/n + d*D/n``.

Stop test, in this order: ``diff < tol`` (strict), then ``round >= max_iter``. The
difference of round 1 is taken against an all-zero vector, as in the published runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.plans.layout import GraphLayout, prepare_graph
from graphloom.plans.loop import LoopTrace, choose_store, iterate, loop_partitions
from graphloom.plans.restart import RestartableRun

DAMPING_MODES = ("standard", "twice")


@dataclass
class PageRankResult:
    ranks: DataFrame          # id, rank
    layout: GraphLayout
    trace: LoopTrace
    converged: bool
    history: DataFrame | None  # round, id, rank

    @property
    def rounds(self) -> int:
        return self.trace.count

    @property
    def diffs(self) -> list[float]:
        return [float(r.metrics["diff"]) for r in self.trace.rounds]

    @property
    def round_seconds(self) -> list[float]:
        return [r.seconds for r in self.trace.rounds]


def initial_state(layout: GraphLayout) -> DataFrame:
    n = layout.num_vertices
    return layout.vertices.select(
        "id", "deg", "nb", F.lit(1.0 / n).alias("rank")
    )


# One round as one statement: analysed once per round (a chain of DataFrame calls is
# analysed call by call, which costs more than the round itself on small graphs).
ROUND_SQL = """
WITH messages AS (MESSAGES),
summed AS (SELECT id, sum(value) AS s, count(value) AS nin FROM messages GROUP BY id)
SELECT /*+ SHUFFLE_HASH(m) */ v.id, v.deg, v.nb, RANK_EXPR AS rank, v.rank AS prev
FROM {state} v LEFT JOIN summed m ON v.id = m.id  -- shares sent to targets outside the vertex set are lost
"""

RANK_EXPR = {
    "standard": ":base + :d * coalesce(s, 0D)",
    "twice": ":d * (CASE WHEN nin > 0 THEN :d * coalesce(s, 0D) + :base ELSE 0D END) + :base",
}


def rank_round(layout: GraphLayout, state: DataFrame, damping: float,
               dead_mass: float, mode: str) -> DataFrame:
    """One PageRank round from ``state`` (lazy). The result carries ``prev``.

    State and edges join in their buckets; the summed messages are the one exchange.
    """
    n = layout.num_vertices
    d = float(damping)
    base = (1.0 - d) / n + d * dead_mass / n
    messages = layout.messages("s.rank / s.deg * e.mult", "deg > 0")
    query = ROUND_SQL.replace("RANK_EXPR", RANK_EXPR[mode]).replace("MESSAGES", messages)
    return state.sparkSession.sql(query, args={"base": base, "d": d}, state=state, **layout.frames())


def pagerank(
    edges: DataFrame | GraphLayout,
    damping: float = 0.85,
    tol: float | None = 1e-4,
    max_iter: int = 50,
    damping_mode: str = "standard",
    vertices: str = "all",
    listed: DataFrame | None = None,
    history: bool = False,
    partitions: int | None = None,
    bucket_size: int | None = None,
    state_store: str = "table",
    grid: bool = False,
    run_dir: str | None = None,
) -> PageRankResult:
    """PageRank of a directed multigraph given as ``src, dst`` rows (duplicates count).

    ``tol=None`` runs exactly ``max_iter`` rounds. ``vertices="sources"`` ranks only
    listed / source vertices (the fixed-round variant of the reference).
    ``run_dir``: a shared folder of this run alone, by which a new driver goes on from the last complete round
    (``plans/restart.py``). ``grid`` lays the edges out in two dimensions, for dense graphs (``plans/grid.py``).
    ``state_store``: ``table`` or ``checkpoint`` (see ``plans.loop.choose_store``).
    """
    if damping_mode not in DAMPING_MODES:
        raise ValueError(f"damping_mode must be one of {DAMPING_MODES}")
    if max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    run = None
    if run_dir is not None:
        if isinstance(edges, GraphLayout) or grid or history or state_store != "table":
            raise ValueError("run_dir goes with edges as rows, one-dimensional layout, state tables and no history")
        settings = {"damping": float(damping), "damping_mode": damping_mode, "vertices": vertices}
        run = RestartableRun(edges.sparkSession, run_dir, settings)
    if isinstance(edges, GraphLayout):
        layout = edges
    elif run is not None:
        layout = run.layout(lambda tables: prepare_graph(edges, vertices=vertices, listed=listed, partitions=partitions,
                                                         bucket_size=bucket_size, weight=None, tables=tables))
    else:
        layout = prepare_graph(edges, vertices=vertices, listed=listed,
                               partitions=partitions, bucket_size=bucket_size,
                               weight=None, grid=grid)
    n = layout.num_vertices
    if n == 0:
        raise ValueError("PageRank needs at least one vertex; the graph is empty")

    kept: list[tuple[int, DataFrame]] = []

    def step(state: DataFrame, k: int, last: dict) -> DataFrame:
        return rank_round(layout, state, damping, float(last["dead_mass"]), damping_mode)

    def metrics(k: int) -> dict:
        prev = F.col("prev") if k > 1 else F.lit(0.0)
        return {
            "diff": F.sum(F.abs(F.col("rank") - prev)),
            "dead_mass": F.coalesce(F.sum(F.when(F.col("deg") == 0, F.col("rank"))), F.lit(0.0)),
            "total": F.sum("rank"),
        }

    def stop(k: int, m: dict) -> str | None:
        if tol is not None and float(m["diff"]) < tol:
            return "converged"
        if k >= max_iter:
            return "max_iter"
        return None

    def keep(k: int, state: DataFrame) -> None:
        if history:
            kept.append((k, state))

    spark = layout.vertices.sparkSession
    store = run.store(layout) if run else choose_store(spark, history, state_store, layout.partitions)
    state = (run.state(layout) if run else None) or initial_state(layout)
    if run and run.rounds:  # a run that was cut after its last round has no round left
        reason = stop(len(run.rounds), run.rounds[-1].metrics)
    with loop_partitions(spark, layout.partitions), layout.planned():
        if run and run.rounds and reason:
            final, trace = state, LoopTrace(run.rounds, reason)
        else:
            final, trace = iterate(
                state, step, metrics, stop, name="pagerank", keep=keep, initial_metrics={"dead_mass": layout.num_sinks / n},
                store=store, earlier=run.rounds if run else None, done=run.note if run else None,
            )
    if run:
        run.finish()
    if not isinstance(edges, GraphLayout):
        layout.close()  # a graph that the caller prepared stays theirs
    hist = None
    if history:
        parts = [s.select(F.lit(k).cast("bigint").alias("round"), "id", "rank") for k, s in kept]
        hist = parts[0]
        for p in parts[1:]:
            hist = hist.unionByName(p)
    return PageRankResult(
        ranks=final.select("id", "rank"),
        layout=layout,
        trace=trace,
        converged=trace.stop_reason == "converged",
        history=hist,
    )
