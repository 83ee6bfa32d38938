"""Single relaxation step of shortest paths and its change test.

``relax_once`` sends ``dist + weight`` along every edge of a vertex with a finite
distance and keeps the minimum per vertex: the candidates are unioned with the
vertex rows and reduced by one ``groupBy(id).min`` (map-side partial minimum first;
the tagged-message join of the reference without Python objects).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.graph import written_pairs
from graphloom.operators.salting import Written, salted_join

INF = float("inf")


def initial_distances(vertices: DataFrame, source) -> DataFrame:
    """``id, dist``: 0 at ``source``, Infinity elsewhere."""
    return vertices.select(
        "id", F.when(F.col("id") == F.lit(source), F.lit(0.0)).otherwise(F.lit(INF)).alias("dist")
    )


def relax_once(edges: DataFrame | Written, dist: DataFrame, bucket: int | None = None) -> DataFrame:
    """One Bellman-Ford step over all edges: ``id, dist, improved``.

    Parallel edges collapse to the lightest first (``graph.written_pairs``, which may be given in their place);
    the join on the source splits hot sources.
    """
    pairs = edges if isinstance(edges, Written) else written_pairs(edges.select("src", "dst", "weight"))
    senders = dist.where(F.col("dist") < F.lit(INF)).select(
        "id", F.col("dist").alias("from_dist")
    )
    candidates = salted_join(pairs, senders, "src", "id", spread="dst", bucket=bucket).select(
        F.col("dst").alias("id"),
        F.lit(None).cast("double").alias("old"),
        (F.col("from_dist") + F.col("weight")).alias("cand"),
    )
    own = dist.select("id", F.col("dist").alias("old"), F.lit(None).cast("double").alias("cand"))
    best = (
        own.unionByName(candidates)
        .groupBy("id")
        .agg(F.min("old").alias("old"), F.min("cand").alias("best"))
        .where(F.col("old").isNotNull())
    )
    return best.select(
        "id",
        F.least("old", "best").alias("dist"),
        F.coalesce(F.col("best") < F.col("old"), F.lit(False)).alias("improved"),
    )


def changed_summary(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row comparing two distance vectors on their common ids (exact ``==``).

    ``num_compared, num_changed, unchanged`` (the global AND of the reference).
    """
    pairs = old.select("id", F.col("dist").alias("a")).join(
        new.select("id", F.col("dist").alias("b")), "id"
    )
    same = F.col("a") == F.col("b")
    return pairs.agg(
        F.count(F.lit(1)).alias("num_compared"),
        F.count_if(~same).alias("num_changed"),
        F.coalesce(F.bool_and(same), F.lit(True)).alias("unchanged"),
    )


def finite_or_null(dist: DataFrame, column: str = "dist") -> DataFrame:
    """Unreachable (Infinity) as NULL."""
    return dist.withColumn(
        column, F.when(F.col(column) == F.lit(INF), F.lit(None).cast("double")).otherwise(F.col(column))
    )
