"""Cycles of parent pointers, found by pointer doubling.

``parents (id, parent)`` has at most one row per id. Following the pointers, a chain either ends at an id without a row or
goes round a cycle for ever. Doubling every pointer ``j`` times follows ``2^j`` of them at once: chains that end drop out,
and what the doubled pointers still name lies on cycles. No round looks at a vertex more than once, and
nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from graphloom.plans.tables import RunTables


def cycle_vertices(parents: DataFrame, tables: RunTables, longest: int) -> DataFrame | None:
    """``id`` of all ids on cycles, or None where there is no cycle.

    ``longest`` bounds the pointers of a chain that ends; a chain that goes on longer has met a cycle.
    """
    jumps = tables.save(parents.where("parent IS NOT NULL").select("id", F.col("parent").alias("to")), "jumps-0")
    k = 0
    while True:
        step = jumps.alias("a").join(jumps.alias("b"), F.col("a.to") == F.col("b.id")).select(F.col("a.id").alias("id"), F.col("b.to").alias("to"))
        watch = Observation()
        k += 1
        fresh = tables.save(step.observe(watch, F.count(F.lit(1)).alias("n")), f"jumps-{k}")
        tables.drop(f"jumps-{k - 1}")
        jumps = fresh
        if not watch.get["n"]:
            tables.drop(f"jumps-{k}")
            return None
        if 1 << k > longest:
            # every pointer left goes round a cycle, and has gone into it
            return jumps.select(F.col("to").alias("id")).distinct()


def one_cycle(parents: DataFrame, tables: RunTables, longest: int) -> DataFrame | None:
    """``pos, id, parent``: the cycle that holds the smallest id on any cycle, from that id (``pos`` 0) along the
    pointers' other end: the row at ``pos`` is named by the parent of the row at ``pos + 1``. None where there is no cycle."""
    on_cycles = cycle_vertices(parents, tables, longest)
    if on_cycles is None:
        return None
    ring = tables.save(parents.join(on_cycles, "id", "left_semi").select("id", "parent"), "ring")
    first = ring.agg(F.min("id")).first()[0]
    # the distance to ``first`` along the pointers: the list ends there, every other chain that has a distance leads to it
    state = ring.select("id", F.when(F.col("id") != F.lit(first), F.col("parent")).alias("to"), F.lit(0).cast("bigint").alias("pos"))
    state = tables.save(state.withColumn("pos", F.when(F.col("to").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint")), "rank-0")
    k, last = 0, -1
    while True:
        ahead = state.select(F.col("id").alias("to"), F.col("to").alias("beyond"), F.col("pos").alias("further"))
        step = state.join(ahead, "to", "left").select(
            "id", F.when(F.col("to").isNotNull(), F.col("beyond")).alias("to"), (F.col("pos") + F.coalesce("further", F.lit(0))).alias("pos"))
        watch = Observation()
        k += 1
        fresh = tables.save(step.observe(watch, F.count_if(F.col("to").isNull()).alias("n")), f"rank-{k}")
        tables.drop(f"rank-{k - 1}")
        state = fresh
        if watch.get["n"] == last:  # who has not arrived goes round another cycle
            return ring.join(state.where("to IS NULL"), "id").select("pos", "id", "parent")
        last = watch.get["n"]
