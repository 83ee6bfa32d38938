"""Edges in a grid of source blocks x target blocks, for dense graphs.

Bucketed by source, each of ``P`` edge partitions may send a message to every vertex: up to ``|V| * P`` rows a
round. Here the ``P = q * q`` cells hold the edges of one block of sources (a ``q``-th of all vertices by hash) to
one block of targets. A round has two exchanges:

* senders go to the cells that hold edges of theirs: at most ``q`` cells a vertex, ``|V| * q`` rows. Which
  these are is a table written once (``routes``), bucketed like the state, so it meets the state in place;
* the messages of a cell are summed by target inside its task (partial aggregation) and go to their
  vertices: at most ``|V| / q`` targets a cell, ``|V| * q`` rows.

It pays where the edges outnumber ``|V| * q`` many times; on sparse graphs the first exchange is an extra. A source adds at
most ``|V| / q`` edges to a cell however hot it is, which is less than an average cell of a dense graph, so there are no
salt buckets. A message meets its sender by ``(cell, src)`` in tables bucketed by ``cell`` alone; Spark accepts that
partitioning while ``requireAllClusterKeysForCoPartition`` is off (``GridLayout.planned``).
"""

from __future__ import annotations

import math
from contextlib import AbstractContextManager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.plans.layout import GraphLayout
from graphloom.plans.loop import loop_partitions, scoped_setting
from graphloom.plans.tables import RunTables

# Spark's setting by which a join on (cell, src) may use tables bucketed by cell
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass
class GridLayout(GraphLayout):
    """A prepared graph whose edges lie in cells.

    cold: ``cell, src, dst, mult[, weight]``, bucketed by ``cell``, one cell a bucket.
    routes: ``id, cell``, the cells in which a vertex has edges as their source; bucketed by ``id``.
    """

    routes: DataFrame | None = None

    @property
    def edges(self) -> DataFrame:
        return self.cold.withColumn("salt", F.lit(0)).select(
            "src", "salt", "dst", "mult", *(["weight"] if self.weighted else []))

    def messages(self, value: str, active: str, columns: str = "") -> str:
        return (f"SELECT /*+ SHUFFLE_HASH(s) */ e.dst AS id, {value} AS value{columns} FROM {{cold}} e "
                f"JOIN (SELECT /*+ SHUFFLE_HASH(v) */ r.cell, v.* FROM {{routes}} r "
                f"JOIN (SELECT * FROM {{state}} WHERE {active}) v ON r.id = v.id) s ON e.cell = s.cell AND e.src = s.id")

    def frames(self, blocks: list[int] | None = None) -> dict[str, DataFrame]:
        """A frontier is spread over all cells: none is left out."""
        return {"cold": self.cold, "routes": self.routes}

    def planned(self) -> AbstractContextManager:
        return scoped_setting(self.vertices.sparkSession, ALL_KEYS, "false")


def side(partitions: int) -> int:
    """Blocks a side: the largest grid of at most ``partitions`` cells."""
    return max(1, math.isqrt(partitions))


def vertex_block(key: str, q: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(q)).cast("int")


def cell_names(spark: SparkSession, cells: int, buckets: int) -> DataFrame:
    """``number, cell``: for each cell number a value that Spark's bucketing puts in a bucket of its own."""
    tried = 16 * buckets
    while True:
        own = spark.range(tried).groupBy(F.expr(f"pmod(hash(id), {buckets})").alias("number")).agg(F.min("id").alias("cell"))
        names = own.where(F.col("number") < cells).collect()  # one small row a cell, bounded by the partition count
        if len(names) == cells:
            return spark.createDataFrame([(r["number"], r["cell"]) for r in names], "number int, cell bigint")
        tried *= 2


def write_cells(pairs: DataFrame, tables: RunTables, partitions: int) -> tuple[DataFrame, DataFrame]:
    """The edge table in cells and the routes to them, from distinct ``src, dst, mult[, weight]``."""
    q = side(partitions)
    names = cell_names(pairs.sparkSession, q * q, partitions)
    number = vertex_block("src", q) * F.lit(q) + vertex_block("dst", q)
    placed = pairs.withColumn("number", number).join(F.broadcast(names), "number").drop("number")
    order = ["cell", *pairs.columns]
    with loop_partitions(pairs.sparkSession, partitions):
        cells = tables.save(placed.select(order).repartition(partitions, "cell"), "cells", partitions, ("cell",))
        routes = cells.groupBy(F.col("src").alias("id"), "cell").agg(F.lit(1).alias("one")).select("id", "cell")
        routes = tables.save(routes.repartition(partitions, "id"), "routes", partitions, ("id",))
    return cells, routes
