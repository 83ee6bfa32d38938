"""Single PageRank steps and rank reports on plain frames.

``contributions`` is one round's message step (share ``rank / out_degree`` along each
edge, summed per target); ``dead_end_mass``, ``outer_fill`` and ``l1_diff`` are the
scalar and join pieces of a round. Reports: ordering with a global position computed
without a one-partition window, top-k, extremes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators.graph import out_degree, written_pairs
from graphloom.operators.salting import Written, salted_join


def uniform_ranks(vertices: DataFrame) -> DataFrame:
    """``id, rank = 1/n``; n is read as one scalar."""
    n = vertices.count()
    if n == 0:
        raise ValueError("no vertices to rank")
    return vertices.select("id", F.lit(1.0 / n).alias("rank"))


def contributions(edges: DataFrame | Written, ranks: DataFrame, degrees: DataFrame | None = None,
                  bucket: int | None = None) -> DataFrame:
    """``id, contrib``: summed ``rank / out_degree`` over the in-edges of each target.

    Duplicate edges send one share each; only targets with in-edges appear. Edges are
    pre-aggregated per pair (``graph.written_pairs``, which may be given in their place) and the join on the
    source splits hot sources.
    """
    pairs = edges if isinstance(edges, Written) else written_pairs(edges.select("src", "dst"))
    deg = degrees if degrees is not None else out_degree(pairs.frame, include_sinks=False, copies="mult")
    shares = ranks.join(deg, "id").where(F.col("out_degree") > 0).select(
        "id", (F.col("rank") / F.col("out_degree")).alias("share")
    )
    sent = salted_join(pairs, shares, "src", "id", spread="dst", bucket=bucket)
    return sent.groupBy(F.col("dst").alias("id")).agg(
        F.sum(F.col("share") * F.col("mult")).alias("contrib")
    )


def dead_end_mass(ranks: DataFrame, degrees: DataFrame) -> DataFrame:
    """One row: ``num_dead_ends, mass`` -- rank held by vertices without out-edges."""
    joined = ranks.join(degrees, "id", "left")
    dead = F.coalesce(F.col("out_degree"), F.lit(0)) == 0
    return joined.agg(
        F.count_if(dead).alias("num_dead_ends"),
        F.coalesce(F.sum(F.when(dead, F.col("rank"))), F.lit(0.0)).alias("mass"),
    )


def outer_fill(vertices: DataFrame, values: DataFrame, column: str = "contrib") -> DataFrame:
    """Every vertex with its value, 0 where it has none (left outer join + coalesce)."""
    return vertices.select("id").join(values, "id", "left").select(
        "id", F.coalesce(F.col(column), F.lit(0.0)).alias(column)
    )


def damp(values: DataFrame, n: int, damping: float = 0.85, dead_mass: float = 0.0,
         column: str = "contrib") -> DataFrame:
    """Standard damping ``(1-d)/n + d*S + d*D/n`` as ``id, rank``."""
    base = (1.0 - damping) / n + damping * dead_mass / n
    return values.select("id", (F.lit(base) + F.lit(damping) * F.col(column)).alias("rank"))


def l1_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: ``l1`` = sum of |a.rank - b.rank| over common ids, ``num_compared``."""
    pairs = a.select("id", F.col("rank").alias("ra")).join(
        b.select("id", F.col("rank").alias("rb")), "id"
    )
    return pairs.agg(
        F.coalesce(F.sum(F.abs(F.col("ra") - F.col("rb"))), F.lit(0.0)).alias("l1"),
        F.count(F.lit(1)).alias("num_compared"),
    )


def rank_order():
    return [F.col("rank").desc(), F.col("id").asc()]


def ordered(ranks: DataFrame) -> DataFrame:
    """Rank descending, id ascending on ties (a total, repeatable order)."""
    return ranks.orderBy(*rank_order())


def with_position(ranks: DataFrame, partitions: int | None = None, order=None) -> DataFrame:
    """``pos`` (1 = first in ``order``, default highest rank) for every row, without a
    one-partition window.

    Range-partition by the order, sort inside partitions, count rows per partition
    (one small row per partition reaches the driver), then add each partition's
    offset to the row's index inside its partition. The sorted frame is written to
    the checkpoint folder first so both passes see the same partitions.
    """
    order = order or rank_order()
    # without an explicit count adaptive execution may merge adjacent ranges of a small
    # input; merged ranges stay in order, so positions are unaffected
    ranged = (ranks.repartitionByRange(partitions, *order) if partitions
              else ranks.repartitionByRange(*order))
    sorted_frame = (
        ranged
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"),
                F.monotonically_increasing_id().alias("_mid"))
        .checkpoint(eager=True)
    )
    counts = sorted_frame.groupBy("_part").agg(F.count(F.lit(1)).alias("c")).collect()
    offsets, total = [], 0
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((row["_part"], total))
        total += row["c"]
    # one row per partition: a size bound that does not grow with the data
    offset_frame = ranks.sparkSession.createDataFrame(offsets, "_part int, _offset bigint")
    # monotonically_increasing_id = partition index << 33 | row index in the partition
    local = F.col("_mid") - F.shiftleft(F.col("_part").cast("bigint"), 33)
    return sorted_frame.join(F.broadcast(offset_frame), "_part").select(
        *[c for c in ranks.columns],
        (F.col("_offset") + local + 1).cast("bigint").alias("pos"),
    )


def top_k(ranks: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest ranks with their position (``TakeOrderedAndProject``)."""
    best = ranks.orderBy(*rank_order()).limit(k)
    # k rows at most: numbering them in one partition is bounded by k
    return best.withColumn("pos", F.row_number().over(Window.orderBy(*rank_order())).cast("bigint"))


def extremes(ranks: DataFrame) -> DataFrame:
    """One row: highest and lowest rank with their ids (smallest id on ties)."""
    return ranks.agg(
        F.min_by("id", F.struct(-F.col("rank"), F.col("id"))).alias("max_id"),
        F.max("rank").alias("max_rank"),
        F.min_by("id", F.struct(F.col("rank"), F.col("id"))).alias("min_id"),
        F.min("rank").alias("min_rank"),
    )
