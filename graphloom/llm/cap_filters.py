"""Embedding near-duplicates by spherical-cap filters.

Filter directions are the words of a random product code: the (rotated) space is cut into
blocks, each block has a few random directions, and a filter picks one direction of every
block. A vector meets a filter when their inner product reaches a threshold. List decoding
finds exactly these filters by extending partial words block by block, dropping those that
cannot reach it any more; it never scans all words. Vectors of one label that share a
filter are compared in double precision. A bucket larger than ``BUCKET_ROWS`` is cut into blocks
and its block pairs are spread over tasks, whole. Equal vectors are one class and are compared
once. A pair that shares several filters counts in the least one only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField,
                               StructType)

from graphloom.llm.common import Scratch, fresh_name
from graphloom.llm.components import connected_components

MIN_COSINE = 0.98
# filters a vector meets on average, vectors that a filter holds on average within all labels, blocks of the product code
FILTERS, FILTER_ROWS, BLOCKS = 14, 64, 4
# the share of pairs at exactly MIN_COSINE that are to meet in a filter, drawn pairs it is measured on, and the least numbers of
# filters a vector may be given for it, tried in turn
RECALL, DRAWN = 0.97, 2000
LEAST_FILTERS = [5, 6, 7, 8, 10, 12, 14, 17, 20, 24, 28, 34, 40, 48, 56, 68, 80, 96]
# rows of a bucket compared in one block; rows of the buckets that go to a task together
BUCKET_ROWS, GROUP_ROWS = 2048, 16384
SEED = 20


class ProductCode:
    """The filters for vectors of one dimension when ``rows`` vectors are searched."""

    def __init__(self, dim: int, rows: int):
        rng = np.random.default_rng([SEED, dim])
        self.blocks = max(1, min(BLOCKS, dim // 4))
        share = min(0.25, FILTER_ROWS / max(rows, 1))  # of all directions, the part a filter's cap covers
        self.size = max(2, math.ceil((FILTERS / share) ** (1 / self.blocks)))
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cuts = [dim * i // self.blocks for i in range(self.blocks + 1)]
        self.words = []
        for lo, hi in zip(self.cuts, self.cuts[1:]):
            w = rng.standard_normal((self.size, hi - lo))
            self.words.append(w / np.linalg.norm(w, axis=1, keepdims=True) / math.sqrt(self.blocks))
        # the cap's threshold: an inner product with a random unit vector is close to normal
        self.threshold = NormalDist().inv_cdf(1 - share) / math.sqrt(dim)
        self.least = self._least(rng)

    def _least(self, rng: np.random.Generator) -> int:
        """The least number of filters a vector is given: the smallest with which drawn pairs of cosine ``MIN_COSINE`` meet in a
        filter often enough. Caps shrink as rows grow, so it depends on the rows and the dimension."""
        dim = len(self.rotation)
        every = self.size ** self.blocks
        if dim < 2:
            return min(LEAST_FILTERS[0], every)
        x, y = rng.standard_normal((2, DRAWN, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y -= (x * y).sum(axis=1, keepdims=True) * x
        y = MIN_COSINE * x + math.sqrt(1 - MIN_COSINE ** 2) * y / np.linalg.norm(y, axis=1, keepdims=True)
        met = np.zeros(DRAWN, bool)
        for least in LEAST_FILTERS:
            self.least = min(least, every)
            left = np.flatnonzero(~met)  # more filters part no pair that met
            both = self.filters(np.concatenate([x[left], y[left]]))
            met[left] = [len(np.intersect1d(a, b, assume_unique=True)) > 0 for a, b in zip(both, both[len(left):])]
            if met.mean() >= RECALL or self.least == every:
                break
        return self.least

    def decode(self, unit: np.ndarray, threshold: float, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, filter, score) of all filters that rows ``pick`` of ``unit`` meet."""
        turned = unit[pick] @ self.rotation
        scores = [turned[:, lo:hi] @ w.T for (lo, hi), w in zip(zip(self.cuts, self.cuts[1:]), self.words)]
        order = [np.argsort(-s, axis=1, kind="stable") for s in scores]
        ranked = [np.take_along_axis(s, o, axis=1) for s, o in zip(scores, order)]
        rest = np.zeros(len(pick))  # the best that later blocks can add
        after = []
        for r in reversed(ranked):
            after.append(rest)
            rest = rest + r[:, 0]
        after.reverse()
        row, code, total = np.arange(len(pick)), np.zeros(len(pick), np.int64), np.zeros(len(pick))
        for o, r, best in zip(order, ranked, after):
            need = threshold - total - best[row]
            many = (r[row] >= need[:, None]).sum(axis=1)  # sorted: those that may still reach it come first
            at = np.repeat(np.arange(len(row)), many)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            row, code, total = row[at], code[at] * self.size + o[row[at], nth], total[at] + r[row[at], nth]
        return pick[row], code, total

    def filters(self, unit: np.ndarray) -> list[np.ndarray]:
        """The sorted filters of each row: all above the threshold, and where these are fewer
        than ``least``, the best ones below it."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(unit)
        left, threshold = np.arange(len(unit)), self.threshold
        least = self.least
        while len(left):
            row, code, total = self.decode(unit, threshold, left)
            order = np.lexsort((-total, row))
            row, code, total = row[order], code[order], total[order]
            ends = np.searchsorted(row, left, side="right")
            starts = np.searchsorted(row, left, side="left")
            short = []
            for r, s, e in zip(left, starts, ends):
                if e - s < least:
                    short.append(r)
                elif threshold == self.threshold:
                    out[r] = np.sort(code[s:e])
                else:
                    out[r] = np.sort(code[s:s + least])
            left = np.array(short, np.int64)
            threshold -= 0.5 / math.sqrt(unit.shape[1])
        return out


@lru_cache(maxsize=4)
def _code(dim: int, rows: int) -> ProductCode:
    return ProductCode(dim, rows)


def _units(vectors: pd.Series, kind: str) -> np.ndarray:
    raw = np.stack([np.frombuffer(v, kind) for v in vectors]).astype(np.float64)
    raw /= np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def _prepared(rows: DataFrame, vector: str, label: str, kind: str) -> DataFrame:
    """``rows`` without the vector, with ``_dim``, ``_vec`` (bytes) and ``_class`` (digest of the
    vector); these are null where the vector or label takes no part."""
    import hashlib

    rest = [f for f in rows.schema.fields if f.name != vector]
    schema = StructType([*rest, StructField("_dim", IntegerType()), StructField("_vec", BinaryType()),
                         StructField("_class", StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out, dims, vecs, classes = part.drop(columns=[vector]), [], [], []
            for v, lab in zip(part[vector], part[label]):
                x = None if v is None else np.array([np.nan if e is None else e for e in v], dtype=kind)
                if x is None or pd.isna(lab) or not len(x) or not np.isfinite(x).all() or not x.any():
                    dims.append(None), vecs.append(None), classes.append(None)
                    continue
                raw = (x + x.dtype.type(0)).tobytes()  # -0.0 becomes 0.0
                dims.append(len(x)), vecs.append(raw)
                classes.append(hashlib.md5(f"{lab}|{len(x)}|".encode() + raw).hexdigest())
            out["_dim"], out["_vec"], out["_class"] = pd.array(dims, "Int32"), vecs, classes
            yield out

    return rows.select(*[f.name for f in rest], vector).mapInPandas(run, schema)


def _postings(classes: DataFrame, kind: str, total: int) -> DataFrame:
    """One row per class and filter: ``label, dim, filter, key, mult, vec, filters``."""
    schema = ("label string, dim int, filter bigint, key string, mult bigint, vec binary, filters binary")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for dim, some in part.groupby("dim"):
                for at in range(0, len(some), 1024):
                    block = some.iloc[at:at + 1024]
                    found = _code(int(dim), total).filters(_units(block["vec"], kind))
                    many = [len(f) for f in found]
                    out = block.loc[block.index.repeat(many), ["label", "dim", "key", "mult", "vec"]]
                    out["filter"] = np.concatenate(found)
                    packed = [f.astype("<i8").tobytes() for f in found]
                    out["filters"] = np.repeat(np.array(packed, dtype=object), many)
                    yield out[["label", "dim", "filter", "key", "mult", "vec", "filters"]]

    return classes.mapInPandas(run, schema)


def _compare(kind: str, min_cosine: float):
    """Links within the block pairs of a group of buckets: per class its links and the first class that links reach there."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["label", "dim", "filter", "lo", "hi", "key"], kind="stable").reset_index(drop=True)
        out = []
        for _, some in group.groupby("dim", sort=False):
            some = some.reset_index(drop=True)
            unit = _units(some["vec"], kind)
            edge = (some[["label", "filter", "lo", "hi"]] != some[["label", "filter", "lo", "hi"]].shift()).any(axis=1)
            starts = np.nonzero(edge.to_numpy())[0]
            columns = [some[c].to_numpy() for c in ("filter", "block", "mult", "key", "filters")]
            for s, e in zip(starts, np.append(starts[1:], len(some))):
                if e - s > 1:
                    found = _bucket(unit[s:e], *[c[s:e] for c in columns], min_cosine)
                    if found:
                        out.append(found)
        keys, links, roots = (np.concatenate(x) for x in zip(*out)) if out else ([], [], [])
        return pd.DataFrame({"key": pd.Series(keys, dtype=object), "links": np.array(links, np.int64),
                             "root": pd.Series(roots, dtype=object)})

    return run


def _bucket(unit: np.ndarray, filters: np.ndarray, block: np.ndarray, mult: np.ndarray, key: np.ndarray, packed: np.ndarray,
            min_cosine: float) -> tuple | None:
    n, here = len(unit), filters[0]
    two = (block != block[0]).any()  # pairs inside one of two blocks are compared elsewhere
    links, comp, seen = np.zeros(n, np.int64), np.arange(n), None
    for at in range(0, n, 512):
        rows = np.arange(at, min(at + 512, n))
        near = unit[rows] @ unit.T >= min_cosine
        near[np.arange(len(rows)), rows] = False
        if two:
            near &= block[rows][:, None] != block[None, :]
        hit = near.any(axis=1)
        if not hit.any():
            continue
        if seen is None:
            seen = _lower_filters(packed, here)
        comp = _joined(comp, rows[hit], near[hit].argmax(axis=1))  # most of a dense bucket; then what is left
        one, other = np.nonzero(near & (comp[rows][:, None] != comp[None, :]))
        comp = _joined(comp, rows[one], other)
        near[hit] &= seen[rows[hit]] @ seen.T < 0.5  # counted at the least filter that both meet
        links[rows] = near @ mult
    keep = (links > 0) | (comp != np.arange(n))
    return (key[keep], links[keep], key[comp[keep]]) if keep.any() else None


def _joined(comp: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """``comp``, the least row of each row's component, after the links ``one`` - ``other``."""
    while True:
        a, b = comp[one], comp[other]
        apart = a != b
        if not apart.any():
            return comp
        one, other, a, b = one[apart], other[apart], a[apart], b[apart]
        up = np.arange(len(comp))
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while (up[up] != up).any():
            up = up[up]
        comp = up[comp]


def _lower_filters(packed: np.ndarray, here: int) -> np.ndarray:
    """0/1 table: row i meets the j-th of the filters below ``here`` that any row meets."""
    lists = [f[f < here] for f in (np.frombuffer(p, "<i8") for p in packed)]
    _, column = np.unique(np.concatenate(lists), return_inverse=True)
    table = np.zeros((len(lists), max(column.max(initial=0) + 1, 1)), np.float32)
    table[np.repeat(np.arange(len(lists)), [len(x) for x in lists]), column] = 1
    return table


def _dealt(posts: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``posts``, each row once for each block pair it meets, with the group ``g`` of that pair; and the written table of
    the buckets over the bound."""
    bucket = ["label", "dim", "filter"]
    # buckets over the bound, if any, with the blocks each is cut into
    large = scratch.table(posts.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET_ROWS)
                          .select(*bucket, "n", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("cuts")))
    cut = posts.join(large.drop("n"), bucket, "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("key"), F.col("cuts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    paired = cut.withColumn("other", other).select(
        *bucket, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "key", "mult", "vec", "filters")
    # whole block pairs, dealt to groups of about GROUP_ROWS rows: as many groups as the rows of all pairs need
    more = large.agg(F.sum(F.col("n") * (F.col("cuts") - 1))).first()[0] or 0
    groups = max(1, (posts.count() + more) // GROUP_ROWS)
    return paired.withColumn("g", F.pmod(F.xxhash64(*bucket, "lo", "hi"), F.lit(groups))), large


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 min_cosine: float = MIN_COSINE) -> DataFrame:
    """The columns of ``rows`` but ``vector``, with ``n_links``, ``component_id`` and ``kept``.

    Two vectors link when their labels are equal and not null, they have the same length, and
    their cosine in double precision is ``min_cosine`` or more. ``n_links`` counts the other rows
    linked directly, equal vectors included; ``component_id`` is the smallest ``key`` that links reach;
    ``kept`` says that the row's key is that one. A vector that is null, empty, zero, or has null or
    non-finite components, and one without label, links with nothing: 0 links, its own
    component, kept. Rows that repeat link with each other. A null key is never the smallest unless all
    are null. An empty table gives no rows. Result columns whose name the input has get underscores.
    The search can miss a link whose vectors share no filter (recall is measured in the tests); it never
    gives one below the threshold.
    """
    scratch = Scratch(rows.sparkSession, "caps")
    element = rows.schema[vector].dataType.elementType
    if not isinstance(element, (FloatType, DoubleType)):
        rows, element = rows.withColumn(vector, F.col(vector).cast("array<double>")), DoubleType()
    kind = "<f4" if isinstance(element, FloatType) else "<f8"
    rest = [c for c in rows.columns if c != vector]
    slim = rows.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)], F.col(vector).alias("v"))
    names = {c: f"c{i}" for i, c in enumerate(rest)}
    base = scratch.table(_prepared(slim, "v", names[label], kind))
    part = base.where(F.col("_class").isNotNull())
    classes = scratch.table(part.groupBy(F.col("_class").alias("key")).agg(
        F.min(F.col(names[label]).cast("string")).alias("label"), F.min("_dim").alias("dim"),
        F.count(F.lit(1)).alias("mult"), F.min(names[key]).alias("first_key"), F.min("_vec").alias("vec")))
    total = classes.count()
    posts = scratch.table(_postings(classes.select("label", "dim", "key", "mult", "vec"), kind, total))
    dealt, large = _dealt(posts, scratch)
    schema = StructType([StructField("key", StringType()), StructField("links", LongType()), StructField("root", StringType())])
    met = scratch.table(dealt.groupBy("g").applyInPandas(_compare(kind, min_cosine), schema))
    roots = connected_components(met.select(F.col("key").alias("a"), F.col("root").alias("b")).where("a <> b"), scratch)
    links = met.groupBy("key").agg(F.sum("links").alias("links"))
    joined = (classes.select("key", "mult", "first_key").join(links, "key", "left")
              .join(roots, F.col("key") == F.col("id"), "left")
              .select("key", "first_key", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("links"),
                      F.coalesce("root", "key").alias("root")))
    joined = scratch.table(joined)
    least = joined.groupBy("root").agg(F.min("first_key").alias("least"))
    facts = scratch.table(joined.join(least, "root").select(F.col("key").alias("_key"), "links", "least"))
    scratch.drop(classes, posts, large, met, roots, joined)
    n_links, comp, kept = (fresh_name(rest, n) for n in ("n_links", "component_id", "kept"))
    out = base.join(facts, base["_class"] == facts["_key"], "left")
    own = F.when(F.col("_class").isNull(), F.col(names[key])).otherwise(F.col("least"))
    return out.select(*[F.col(names[c]).alias(c) for c in rest], F.coalesce("links", F.lit(0)).cast("bigint").alias(n_links),
                      own.alias(comp), F.col(names[key]).eqNullSafe(own).alias(kept))
