"""Graph preparation shared by the iterative plans.

The edge table is prepared once and then never moves again:

* duplicate edges collapse to one row ``(src, dst, mult, weight)`` -- ``mult`` keeps
  the multiplicity that PageRank needs, ``weight`` the smallest weight that shortest
  paths need. The collapse is a partial (map-side) aggregation, so a hot edge
  repeated a billion times costs one row per map task before the shuffle;
* vertices and edges are bucketed, sorted Parquet tables of ``P`` buckets, by ``id`` and by
  ``src``: a round joins them bucket by bucket, without moving either. The edge table is also cut into blocks
  (folders of consecutive buckets), so that a round reads only the blocks that hold vertices with something to send;
* a source with more than ``bucket_size`` distinct targets is hot. Its edges are a table of their own, dealt to
  ``nb`` salt buckets of at most ``bucket_size`` targets each (``salt = pmod(xxhash64(dst), nb)``), so no
  task holds more than about ``bucket_size`` edges of one source. There are at most ``distinct edges /
  bucket_size`` hot sources; their state rows are broadcast to the hot edges up to ``MAX_BROADCAST_HOT``
  rows, beyond it they are shuffled per salt bucket.

With ``grid=True`` the edges lie in a two-dimensional grid instead (``plans/grid.py``), for dense graphs.

The bucket count ``P`` is chosen from the data: ``ceil((distinct edges + about the vertices) /
rows_per_partition)``, whatever the session's setting.
"""

from __future__ import annotations

import math
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from graphloom.plans.loop import loop_partitions
from graphloom.plans.tables import RunTables, block_of
from graphloom.session import require_checkpoint_dir

VERTEX_MODES = ("all", "sources")

# default salt bucket: a source of more distinct targets is split
BUCKET_SIZE = 1_000_000
# largest hot-source list that is broadcast (rows of src, nb); beyond it, a shuffle join
MAX_BROADCAST_HOT = 1_000_000
# rows (distinct edges + vertices) per partition when the count is chosen from the data
ROWS_PER_PARTITION = 1_000_000


@dataclass
class GraphLayout:
    """A prepared graph.

    vertices: ``id, deg, ndst, nb`` -- out-degree counting duplicates, distinct
      out-neighbours, salt buckets; bucketed by ``id``.
    cold: ``src, dst, mult[, weight], block`` of the sources with one salt bucket; bucketed by ``src``, a folder a block.
    hot: ``src, salt, dst, mult[, weight]`` of the other sources, bucketed by ``(src, salt)``, or None.
      No weight column when prepared with ``weight=None``.
    """

    vertices: DataFrame
    cold: DataFrame
    hot: DataFrame | None
    tables: RunTables
    num_vertices: int
    num_edges: int
    num_distinct_edges: int
    num_sinks: int
    bucket_size: int
    partitions: int
    mode: str
    weighted: bool = True
    min_weight: float | None = None

    @property
    def edges(self) -> DataFrame:
        """All edges: ``src, salt, dst, mult[, weight]``."""
        columns = ["src", "salt", "dst", "mult", *(["weight"] if self.weighted else [])]
        cold = self.cold.withColumn("salt", F.lit(0)).select(columns)
        return cold if self.hot is None else cold.unionByName(self.hot.select(columns))

    @property
    def broadcast_hot(self) -> bool:
        """Whether the state rows of the hot sources are few enough to broadcast."""
        return self.num_distinct_edges // self.bucket_size <= MAX_BROADCAST_HOT

    def messages(self, value: str, active: str, columns: str = "") -> str:
        """SQL of the messages ``id, value[, columns]`` that the rows of ``{state}`` with ``active`` send along ``{cold}``
        and ``{hot}``; ``value`` and ``columns`` name the edge ``e`` and the sender ``s``."""
        sent = f"e.dst AS id, {value} AS value{columns}"
        sql = (f"SELECT /*+ SHUFFLE_HASH(s) */ {sent} FROM {{cold}} e "
               f"JOIN (SELECT * FROM {{state}} WHERE nb = 1 AND {active}) s ON e.src = s.id")
        if self.hot is None:
            return sql
        if self.broadcast_hot:
            return sql + (f" UNION ALL SELECT /*+ BROADCAST(s) */ {sent} FROM {{hot}} e "
                          f"JOIN (SELECT * FROM {{state}} WHERE nb > 1 AND {active}) s ON e.src = s.id")
        return sql + (f" UNION ALL SELECT /*+ SHUFFLE_HASH(s) */ {sent} FROM {{hot}} e "
                      f"JOIN (SELECT *, explode(sequence(0, nb - 1)) AS salt FROM {{state}} WHERE nb > 1 AND {active}) s "
                      f"ON e.src = s.id AND e.salt = s.salt")

    def frames(self, blocks: list[int] | None = None) -> dict[str, DataFrame]:
        """The edge tables as arguments of a statement; of the cold one only ``blocks``, where given."""
        cold = self.cold if blocks is None else self.cold.where(F.col("block").isin(blocks))
        return {"cold": cold} if self.hot is None else {"cold": cold, "hot": self.hot}

    def planned(self) -> AbstractContextManager:
        """The setting under which the rounds are planned, beside their partition count."""
        return nullcontext()

    def close(self) -> None:
        """Delete the prepared tables; results that were computed from them stay."""
        self.tables.close()


def normalize_edges(edges: DataFrame, weight: str | None = "weight") -> DataFrame:
    """``src, dst[, weight]`` with null ends dropped.

    ``weight=None``: no weight column at all (PageRank does not read one, and at 10^12
    edges a constant column costs terabytes per pass). A named weight column that the
    frame lacks counts as 1 per edge (hop counts).
    """
    ends = F.col("src").isNotNull() & F.col("dst").isNotNull()
    if weight is None:
        return edges.select("src", "dst").where(ends)
    w: Column = F.col(weight).cast("double") if weight in edges.columns else F.lit(1.0)
    return edges.select(F.col("src"), F.col("dst"), w.alias("weight")).where(ends)


def prepare_graph(
    edges: DataFrame,
    vertices: str = "all",
    listed: DataFrame | None = None,
    partitions: int | None = None,
    bucket_size: int | None = None,
    weight: str | None = "weight",
    rows_per_partition: int = ROWS_PER_PARTITION,
    grid: bool = False,
    tables: RunTables | None = None,
) -> GraphLayout:
    """Prepare ``edges`` (columns ``src``, ``dst`` and optionally ``weight``).

    vertices: ``"all"`` -- sources and targets (and ``listed`` ids); ``"sources"`` --
      only listed ids, or edge sources when ``listed`` is None. Edges to targets outside
      the vertex set still count in the out-degree; their share is lost.
    listed: optional frame with column ``id`` of vertices that have a line of their own
      in an adjacency list, possibly with no out-edges (``id: []``).
    partitions: buckets of the tables and partitions of the loop; by default ``ceil((distinct edges +
      about the vertices) / rows_per_partition)``: a task holds about that many rows at every size.
    tables: where the prepared tables go, by default to a folder of their own.
    grid: lay the edges out by blocks of sources and of targets (``plans.grid.GridLayout``).
    """
    if vertices not in VERTEX_MODES:
        raise ValueError(f"vertices must be one of {VERTEX_MODES}, got {vertices!r}")
    spark = edges.sparkSession
    require_checkpoint_dir(spark)

    e = normalize_edges(edges, weight)
    tables = tables or RunTables(spark, "graph")
    # read twice below (vertex statistics, bucketed edges); deleted when the edges are written
    weighted = "weight" in e.columns
    pair_aggs = [F.count(F.lit(1)).alias("mult")] + ([F.min("weight").alias("weight")] if weighted else [])
    sizes = Observation("graph_pairs")
    watched = [F.count(F.lit(1)).alias("md"), F.approx_count_distinct("src").alias("sources"), F.approx_count_distinct("dst").alias("targets")]
    if weighted:
        watched.append(F.min("weight").alias("least"))
    pairs = tables.save(e.groupBy("src", "dst").agg(*pair_aggs).observe(sizes, *watched), "pairs")
    md = int(sizes.get["md"])
    about = max(int(sizes.get["sources"]), int(sizes.get["targets"])) + (0 if listed is None else listed.count())
    parts = partitions or max(1, math.ceil((md + about) / rows_per_partition))
    # in a grid the blocks of targets part a source's edges
    bucket_size = 2 ** 62 if grid else bucket_size or BUCKET_SIZE
    edge_cols = ["dst", "mult"] + (["weight"] if weighted else [])

    # one aggregation gives degree, distinct out-neighbours and vertex membership
    out_rows = pairs.select(
        F.col("src").alias("id"),
        F.col("mult").alias("deg"),
        F.lit(1).alias("ndst"),
        F.lit(True).alias("member"),
    )
    rows = [out_rows]
    if vertices == "all":
        rows.append(
            pairs.select(
                F.col("dst").alias("id"), F.lit(0).cast("bigint").alias("deg"),
                F.lit(0).alias("ndst"), F.lit(True).alias("member"),
            )
        )
    if listed is not None:
        rows.append(
            listed.where(F.col("id").isNotNull()).select(
                F.col("id"), F.lit(0).cast("bigint").alias("deg"),
                F.lit(0).alias("ndst"), F.lit(True).alias("member"),
            )
        )
        if vertices == "sources":
            # only listed ids are vertices: edge sources become members through the list
            rows[0] = rows[0].withColumn("member", F.lit(False))
    union = rows[0]
    for r in rows[1:]:
        union = union.unionByName(r)
    vstats = (
        union.groupBy("id")
        .agg(
            F.sum("deg").cast("bigint").alias("deg"),
            F.sum("ndst").cast("bigint").alias("ndst"),
            F.bool_or("member").alias("member"),
        )
        .where(F.col("member"))
        .drop("member")
    )
    totals = Observation("graph_totals")
    nb = F.greatest(F.lit(1), F.ceil(F.col("ndst") / F.lit(bucket_size))).cast("int")
    vstats = vstats.withColumn("nb", nb).observe(
        totals,
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("deg"), F.lit(0)).alias("m"),
        F.coalesce(F.sum("ndst"), F.lit(0)).alias("kept"),
        F.count_if(F.col("deg") == 0).alias("sinks"),
    )
    with loop_partitions(spark, parts):  # the aggregation deals the rows to their buckets
        vtab = tables.save(vstats, "vertices", parts, ("id",))
    t = totals.get
    n, m, md, sinks = int(t["n"]), int(t["m"]), int(t["kept"]), int(t["sinks"])

    if grid:
        from graphloom.plans.grid import GridLayout, write_cells

        cells, routes = write_cells(pairs, tables, parts)
        tables.drop("pairs")
        return GridLayout(vertices=vtab, cold=cells, hot=None, tables=tables, num_vertices=n, num_edges=m,
                          num_distinct_edges=md, num_sinks=sinks, bucket_size=bucket_size, partitions=parts, mode=vertices,
                          weighted=weighted, min_weight=sizes.get["least"] if weighted else None, routes=routes)
    # at most md / bucket_size sources can exceed bucket_size distinct targets
    max_hot = md // bucket_size
    hot = None
    few = pairs
    if max_hot:
        split = vtab.where(F.col("nb") > 1).select(F.col("id").alias("src"), "nb")
        split = F.broadcast(split) if max_hot <= MAX_BROADCAST_HOT else split
        few = pairs.join(split, "src", "left_anti")
        dealt = pairs.join(split, "src").select("src", F.pmod(F.xxhash64("dst"), F.col("nb")).cast("int").alias("salt"), *edge_cols)
        hot = tables.save(dealt.repartition(parts, "src", "salt"), "hot", parts, ("src", "salt"))
    cold = few.repartition(parts, "src").select("src", *edge_cols, block_of("src", parts).alias("block"))
    cold = tables.save(cold, "cold", parts, ("src",), block="block")
    tables.drop("pairs")
    return GraphLayout(
        vertices=vtab,
        cold=cold,
        hot=hot,
        tables=tables,
        num_vertices=n,
        num_edges=m,
        num_distinct_edges=md,
        num_sinks=sinks,
        bucket_size=bucket_size,
        partitions=parts,
        mode=vertices,
        weighted=weighted,
        min_weight=sizes.get["least"] if weighted else None,
    )
