"""Exact top-k by inner product with vector-approximation files.

A vector's whole-number components are cut into cells of equal width per dimension; the file of cell
numbers (one byte a component) is scanned first. Since a component lies within half a cell of its
cell's middle, a query's score with any vector lies within a fixed distance of its score with
the vector's cells. The k-th best lower bound of all blocks drops most candidates. Exact vectors
are then read in order of their upper bounds: first a few per query, which gives the k-th exact
score so far, then only those whose upper bound reaches it. What is unread then cannot enter the result.

Vectors that agree in all components have equal scores, so only the k + 1 smallest ids of such a
class can matter (one of them may be the query's own row).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import Scratch

SCALE = 1024
K = 10
# cells a dimension; vectors in one block of the file; queries compared at once
CELLS, BLOCK_ROWS, BLOCK_QUERIES = 256, 16384, 256
# exact vectors read first, per query, beyond k
FIRST_READ = 32


def _whole(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``id, dim, vec`` (little-endian longs of floor(scale * x)) of the vectors that take part."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for i, v in zip(part["id"], part["v"]):
                if v is None or pd.isna(i) or not len(v):
                    continue
                x = np.array([np.nan if e is None else e for e in v], np.float64)
                if np.isfinite(x).all():
                    x = np.floor(scale * x)
                    if (np.abs(x) >= 2.0 ** 53).any():
                        raise OverflowError(f"vector {i}: components must stay below 2**53 in units of 1/{scale}")
                    out.append((i, len(x), x.astype("<i8").tobytes()))
            if out:
                yield pd.DataFrame(out, columns=["id", "dim", "vec"])

    return rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v")).mapInPandas(
        run, "id bigint, dim int, vec binary")


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(v, "<i8") for v in vectors])


def _ranges(whole: DataFrame) -> DataFrame:
    """``dim, lo, hi``: least and greatest component over all vectors of one length, in doubles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, tuple] = {}
        for part in batches:
            for dim, some in part.groupby("dim"):
                x = _matrix(some["vec"])
                lo, hi = seen.get(dim, (np.inf, -np.inf))
                seen[dim] = (min(lo, x.min()), max(hi, x.max()))
        if seen:
            yield pd.DataFrame([(d, float(lo), float(hi)) for d, (lo, hi) in seen.items()], columns=["dim", "lo", "hi"])

    found = whole.mapInPandas(run, "dim int, lo double, hi double")
    return found.groupBy("dim").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _approximated(classes: DataFrame, blocks: int) -> DataFrame:
    """The approximation file: one row per block with its classes' numbers and cells."""

    def run(keys: tuple, group: pd.DataFrame) -> pd.DataFrame:
        dim, block = keys
        lo, width = group["lo"].iloc[0], max((group["hi"].iloc[0] - group["lo"].iloc[0]) / CELLS, 1.0)
        cells = np.minimum((_matrix(group["vec"]) - lo) // width, CELLS - 1).astype(np.uint8)
        return pd.DataFrame([(dim, block, group["class"].to_numpy("<i8").tobytes(), cells.tobytes(), lo, width)],
                            columns=["dim", "block", "classes", "cells", "lo", "width"])

    dealt = classes.withColumn("block", F.pmod(F.xxhash64("class"), F.lit(blocks)))
    return dealt.groupBy("dim", "block").applyInPandas(
        run, "dim int, block bigint, classes binary, cells binary, lo double, width double")


def _query_blocks(queries: DataFrame, blocks: int) -> DataFrame:
    def run(keys: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(keys[0], group["id"].to_numpy("<i8").tobytes(), group["class"].to_numpy("<i8").tobytes(),
                              b"".join(group["vec"]))], columns=["dim", "ids", "own", "vecs"])

    dealt = queries.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    return dealt.groupBy("dim", "part").applyInPandas(run, "dim int, ids binary, own binary, vecs binary")


def _scan(pairs: DataFrame, k: int) -> DataFrame:
    """Per query and block: the classes whose upper bound reaches the block's k-th lower bound."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for r in part.itertuples(index=False):
                ids, own = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.own, "<i8")
                q = np.frombuffer(r.vecs, "<i8").reshape(len(ids), -1).astype(np.float64)
                classes = np.frombuffer(r.classes, "<i8")
                cells = np.frombuffer(r.cells, np.uint8).reshape(len(classes), -1)
                middle = r.lo + (cells + 0.5) * r.width
                size = np.abs(q).sum(axis=1)
                # half a cell a component, and room for the rounding of the sums
                slack = (size * r.width / 2 + size * (abs(r.lo) + CELLS * r.width) * 1e-12)[:, None]
                score = q @ middle.T
                others = np.where(own[:, None] == classes[None, :], -np.inf, score)
                kth = np.partition(others, -k, axis=1)[:, [-k]] if len(classes) > k else np.full((len(ids), 1), -np.inf)
                # the query's own class holds other rows too, perhaps, so it always goes on
                keep = (score >= kth - 2 * slack) | (own[:, None] == classes[None, :])
                at, c = np.nonzero(keep)
                yield pd.DataFrame({"query": ids[at], "class": classes[c], "mid": score[at, c], "slack": slack[at, 0],
                                    "own": own[at] == classes[c]})

    return pairs.mapInPandas(run, "query bigint, class bigint, mid double, slack double, own boolean")


def _exact(pairs: DataFrame) -> DataFrame:
    """``pairs`` (query, class, mid, slack, qvec, vec) with the whole-number ``score``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            scores = []
            for q, v in zip(part["qvec"], part["vec"]):
                a, b = np.frombuffer(q, "<i8"), np.frombuffer(v, "<i8")
                if float(np.abs(a).max()) * float(np.abs(b).max()) * len(a) < 2.0 ** 62:
                    scores.append(int(a @ b))
                else:  # exact in Python's integers; a result beyond a long fails
                    scores.append(sum(int(x) * int(y) for x, y in zip(a.tolist(), b.tolist())))
            yield pd.DataFrame({"query": part["query"], "class": part["class"], "score": np.array(scores, np.int64)})

    return pairs.mapInPandas(run, "query bigint, class bigint, score bigint")


def top_vectors(rows: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K,
                scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, <key>, score)``: the ``k`` best of ``rows`` for each of ``queries``.

    Score is the inner product of the components floor(scale * x), taken as doubles; ties go to the
    smaller ``key``. A row never answers a query with the same ``key``. Vectors that are null or empty, have null or
    non-finite components, or a null key take no part; only vectors of equal length are compared. Rows that
    repeat a key with the same vector count once. Fewer than ``k`` candidates give fewer rows; no
    queries or an empty table give none. Components must stay below 2**53 units of 1/scale, scores within a long.
    """
    scratch = Scratch(rows.sparkSession, "vafile")
    whole = scratch.table(_whole(rows, key, vector, scale))
    asked = scratch.table(_whole(queries, key, vector, scale).dropDuplicates(["id", "vec"]))
    named = whole.dropDuplicates(["id", "vec"]).withColumn("class", F.xxhash64("vec"))
    # equal vectors share a class; of each class the k + 1 smallest ids
    first = Window.partitionBy("class", "vec").orderBy("id")
    members = scratch.table(named.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
                            .select("class", "dim", "id", "nth", "vec"))
    heads = members.where("nth = 1").join(_ranges(whole), "dim").select("class", "dim", "vec", "lo", "hi")
    classes = scratch.table(heads)
    total, wanted = classes.count(), asked.count()
    blocks, parts = max(1, -(-total // BLOCK_ROWS)), max(1, -(-wanted // BLOCK_QUERIES))
    file = scratch.table(_approximated(classes, blocks))
    asking = asked.withColumn("class", F.xxhash64("vec"))
    query_blocks = scratch.table(_query_blocks(asking, parts))
    # every block of the file meets every block of queries of its dimension: a stated query set, in blocks
    units = file.select("dim", "block").join(query_blocks, "dim").repartition(max(1, blocks * parts), "block", "ids")
    pairs = units.join(file, ["dim", "block"])
    near = scratch.table(_scan(pairs, k))
    # lower bound of the k-th best over all blocks
    best = Window.partitionBy("query").orderBy(F.col("low").desc())
    floor = (near.where(~F.col("own")).select("query", (F.col("mid") - F.col("slack")).alias("low"))
             .withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k)
             .groupBy("query").agg(F.min("low").alias("floor"), F.count(F.lit(1)).alias("n")))
    floor = floor.select("query", F.when(F.col("n") >= k, F.col("floor")).alias("floor"))
    high = F.col("mid") + F.col("slack")
    open_pairs = near.join(floor, "query", "left").where(
        F.col("own") | F.col("floor").isNull() | (high >= F.col("floor"))).select("query", "class", high.alias("high"), "own")
    # own class first: its members other than the query score like the query itself
    order = Window.partitionBy("query").orderBy(F.col("own").desc(), F.col("high").desc(), "class")
    ranked = scratch.table(open_pairs.withColumn("nth", F.row_number().over(order)))
    read = scratch.table(_read(ranked.where(F.col("nth") <= k + FIRST_READ), asking, classes))
    kth = Window.partitionBy("query").orderBy(F.col("score").desc(), "class")
    known = (read.join(ranked.where(~F.col("own")).select("query", "class"), ["query", "class"], "left_semi")
             .withColumn("nth", F.row_number().over(kth)).where(F.col("nth") == k)
             .select("query", F.col("score").alias("sure")))
    later = (ranked.where(F.col("nth") > k + FIRST_READ).join(known, "query", "left")
             .where(F.col("sure").isNull() | (F.col("high") >= F.col("sure"))).select("query", "class"))
    scores = read.unionByName(_read(later, asking, classes))
    # classes to rows: at most k + 1 ids of a class; the best k of a query
    answers = (scores.join(members.select("class", "id"), "class").where(F.col("id") != F.col("query"))
               .dropDuplicates(["query", "id"]))
    rank = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    return (answers.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select(F.col("query").alias("query_id"), "rank", F.col("id").alias(key), "score"))


def _read(pairs: DataFrame, asking: DataFrame, classes: DataFrame) -> DataFrame:
    """The exact vectors of the pairs and their scores."""
    queries = asking.select(F.col("id").alias("query"), F.col("vec").alias("qvec"))
    joined = pairs.select("query", "class").join(classes.select("class", "vec"), "class").join(queries, "query")
    return _exact(joined.select("query", "class", "qvec", "vec"))
