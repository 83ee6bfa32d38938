"""Connected components of an edge table, by label lowering and pointer jumping.

Each round lowers every vertex's label to the least label among its neighbours, lowers
the label of its former root as well, and then replaces each label by its label's label.
The number of rounds grows with the logarithm of the longest path. Labels and edges live
in written tables; a scalar per round (how many labels changed) reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from graphloom.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, root)`` for every vertex of ``edges (a, b)``: the least id it can reach.

    ``edges`` is undirected, may repeat and may hold loops; ids are of any one orderable
    type and not null. An empty edge table gives an empty result. Both joins of a round
    are between two shuffled tables, so Spark splits a vertex with very many edges.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = scratch.table(both.distinct())
    state = scratch.table(links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                          .select("id", F.least("id", "m").alias("root")))
    while True:
        seen = links.join(state, links["b"] == state["id"]).select(F.col("a").alias("id"), "root")
        near = scratch.table(seen.groupBy("id").agg(F.min("root").alias("low")))
        lowered = near.join(state, "id").select("id", "root", F.least("root", "low").alias("low"))
        offers = (lowered.select("id", F.col("low").alias("root"))
                  .unionByName(lowered.where("low < root").select(F.col("root").alias("id"), F.col("low").alias("root"))))
        hooked = scratch.table(offers.groupBy("id").agg(F.min("root").alias("root")))
        up = hooked.select(F.col("id").alias("root"), F.col("root").alias("up"))
        jumped = hooked.join(up, "root").select("id", F.col("up").alias("root"))
        old = state.select("id", F.col("root").alias("old"))
        watch = Observation()
        changed = F.count_if(F.col("root") != F.col("old")).alias("changed")
        fresh = scratch.table(jumped.join(old, "id").observe(watch, changed).select("id", "root"))
        scratch.drop(near, hooked, state)
        state = fresh
        if not watch.get["changed"]:
            scratch.drop(links)
            return state
