"""Repeatable synthetic link tables.

Every node of a node table draws ``k`` in ``[1, min(max_links, n - 1)]`` distinct targets
without replacement: a permutation of the ``n`` node numbers that is keyed by the node and the
seed, whose images of ``0 .. k - 1`` are the draw, so every set of ``k`` nodes can occur and
none is drawn twice. A self-link is dropped, so a node may end with ``k - 1`` links, or with
none (``link_lists`` keeps it with an empty list). Unlike the unseeded original, the draws come
from integer arithmetic on ``(node index, slot, seed)``, so a run is repeatable
and any SQL engine can recompute it. Nodes are numbered densely in id order by a
distributed position (no one-partition window); the index-to-id lookup is an
equi-join on the index, which is uniformly spread.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.graph import adjacency, empty_lists
from graphloom.operators.rank import with_position

# fixed values: Park-Miller modulus and multiplier, and the mixing weights of the seed
MODULUS = 2147483647
MULTIPLIER = 48271
NODE_WEIGHT = 1000003
SLOT_WEIGHT = 10007
SEED_WEIGHT = 7919
ROUND_WEIGHT = 424243
COUNT_SALT = 12345
# rounds of the permutation, and side lengths tried for its grid
ROUNDS = 8
SIDES = 100_000


def _step(x: Column) -> Column:
    return F.pmod(x * F.lit(MULTIPLIER), F.lit(MODULUS))


def _seeded(idx: Column, slot: Column, key: int) -> Column:
    return F.pmod(idx * F.lit(NODE_WEIGHT) + slot * F.lit(SLOT_WEIGHT) + F.lit(key), F.lit(MODULUS))


def draw(idx: Column, slot: Column, seed: int, salt: int = 1) -> Column:
    """A pseudo-random integer in ``[0, MODULUS)`` from node index, slot and seed."""
    return _step(_step(_seeded(idx, slot, seed * SEED_WEIGHT + salt)))


def grid(n: int) -> tuple[int, int]:
    """Sides ``a, b`` of the grid that numbers ``0 .. n - 1`` lie in, row by row.

    ``a`` is the number of at most ``sqrt(n)`` (of half of that at least) that leaves the fewest
    cells over; often none, and never more than ``a - 1``.
    """
    root = max(2, math.isqrt(max(n - 1, 0)) + 1)
    low = max(2, (root + 1) // 2, root - SIDES)
    a = min(range(low, root + 1), key=lambda side: (-n % side, -side))
    return a, -(-n // a)


def permuted(value: Column, key: Column, n: int, seed: int) -> Column:
    """The image of ``value`` (a bigint in ``[0, n)``) in a permutation of ``[0, n)`` that
    ``key`` and ``seed`` choose.

    A Feistel network on the cells of ``grid(n)``: in turn the row is shifted by a mix of the
    column and the column by a mix of the row, each undone by its inverse shift. An image that
    is one of the grid's cells over is sent through again, until it is none (cycle walking); a
    walk meets no cell twice, so one pass more than there are cells over ends every walk.
    """
    a, b = grid(n)

    def square(x: Column) -> Column:
        return x * x % F.lit(MODULUS)

    def half_round(cell: Column, i: Column) -> Column:
        row, col, odd = cell["row"], cell["col"], i % 2 == 1
        x = _seeded(key, F.when(odd, col).otherwise(row), seed * SEED_WEIGHT) + i * F.lit(ROUND_WEIGHT)
        shift = square(F.pmod(_step(square(F.pmod(x, F.lit(MODULUS)))) + F.lit(COUNT_SALT), F.lit(MODULUS)))
        return F.struct(F.when(odd, (row + shift) % F.lit(a)).otherwise(row).alias("row"),
                        F.when(odd, col).otherwise((col + shift) % F.lit(b)).alias("col"))

    def image(v: Column) -> Column:
        cell = F.struct(((v - v % F.lit(b)) / F.lit(b)).cast("bigint").alias("row"), (v % F.lit(b)).alias("col"))
        return F.aggregate(_counted(ROUNDS), cell, half_round, lambda c: c["row"] * F.lit(b) + c["col"])

    def walk(v: Column, i: Column) -> Column:
        return F.when((i > 1) & (v < n), v).otherwise(image(v))

    return F.aggregate(_counted(a * b - n + 1), value, walk)


def _counted(most: int) -> Column:
    return F.sequence(F.lit(1).cast("bigint"), F.lit(most).cast("bigint"))


def index_nodes(nodes: DataFrame) -> DataFrame:
    """``idx`` (0-based, dense, in id order) and ``id``."""
    positioned = with_position(nodes.select("id").distinct(), order=[F.col("id").asc()])
    return positioned.select((F.col("pos") - 1).alias("idx"), "id")


def link_table(nodes: DataFrame, seed: int = 42, max_links: int = 10) -> DataFrame:
    """``src, dst`` links among the ids of ``nodes`` (column ``id``)."""
    indexed = index_nodes(nodes)
    n = indexed.count()
    if n < 2:
        return indexed.select(F.col("id").alias("src"), F.col("id").alias("dst")).limit(0)
    kmax = min(max_links, n - 1)
    k = F.lit(1) + F.pmod(draw(F.col("idx"), F.lit(0), seed, COUNT_SALT), F.lit(kmax))
    slots = indexed.withColumn("k", k.cast("bigint")).select(
        F.col("idx").alias("src_idx"), F.col("id").alias("src"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1)).alias("slot"),
    )
    picks = slots.select("src", permuted(F.col("slot"), F.col("src_idx"), n, seed).alias("idx"))
    links = picks.join(indexed, "idx").select("src", F.col("id").alias("dst"))
    return links.where(F.col("src") != F.col("dst"))


def link_lists(nodes: DataFrame, seed: int = 42, max_links: int = 10) -> DataFrame:
    """``id, chunk, out``: the links of every node of ``nodes``, ``[]`` for a node without any."""
    lists = adjacency(link_table(nodes, seed, max_links))
    ids = nodes.select("id").distinct()
    return lists.unionByName(empty_lists(ids.join(lists, "id", "left_anti"), lists.schema["out"].dataType))
