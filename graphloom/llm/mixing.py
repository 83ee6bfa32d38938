"""Mixing sources to target weights by hash-threshold histograms.

Each source gets a share of a budget, at most ``max_repeats`` times its own size. A document
has a fixed hash. A source whose target is r times its size takes every document floor(r)
times, and once more those whose hash lies below the source's threshold. The threshold
comes from histograms: sizes are summed by source and leading hash digits, the bucket in
which the running sum meets the budget is found, and only that bucket is summed again by the
next digits. No documents are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import Scratch, fresh_name, numbered, word_count

# weights by position of the source, repeating; share of all sizes to take; most repeats
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
# hash digits: 60 bits, read 12 bits a level; below the last level hashes are equal
HASH_BITS, LEVEL_BITS = 60, 12


def document_hash(key: Column, text: Column) -> Column:
    """60 bits of the MD5 of the key and the text's MD5, as a long (null counts as empty)."""
    whole = F.concat_ws("\n", F.coalesce(key.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("bigint")


def targets(sources: DataFrame, scratch: Scratch, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sources (source, source_size)`` with ``target``.

    Sources weigh ``weights`` in turn, in code point order with null last. A target stops at
    ``max_repeats`` times the source's size; what is cut off is dealt again by weight
    to the others, until none is above. Each round is one sum over the source table.
    """
    ranked = numbered(scratch, sources, F.col("source").asc_nulls_last(), name="pos")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = scratch.table(ranked.select(
        "source", "source_size", F.element_at(cycle, (F.col("pos") % len(weights) + 1).cast("int")).alias("weight"),
        (F.lit(float(max_repeats)) * F.col("source_size")).alias("cap")))
    budget = share * float(rows.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        got = rows.agg(F.count_if(full).alias("n"), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)).alias("cap"),
                       F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if got["weight"] is None or got["n"] == capped:
            break
        level, capped = (budget - got["cap"]) / got["weight"], got["n"]
    return rows.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def thresholds(sizes: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """``(source, cut)``: the documents with hash below ``cut`` have sizes that sum closest to
    ``budget`` (``wanted (source, budget)``); of two equally close the smaller."""
    found = wanted.select("source", "budget", F.lit(0).cast("bigint").alias("prefix"), F.lit(0.0).alias("below"))
    shift = HASH_BITS
    while shift > 0:
        shift -= LEVEL_BITS
        digits = F.shiftright("hash", shift)
        inside = sizes.join(found, sizes["source"].eqNullSafe(found["source"])
                            & (F.shiftright(sizes["hash"], shift + LEVEL_BITS) == found["prefix"]))
        sums = (inside.groupBy(found["source"], "budget", "below", digits.alias("bucket"))
                .agg(F.sum("size").cast("double").alias("part")))
        run = Window.partitionBy("source", "budget").orderBy("bucket")  # at most 2 ** LEVEL_BITS rows
        running = sums.withColumn("upto", F.col("below") + F.sum("part").over(run))
        # the boundary bucket: the first whose running sum reaches the budget, else the last
        reached = F.when(F.col("upto") >= F.col("budget"), F.col("bucket"))
        edge = running.groupBy("source", "budget").agg(
            F.coalesce(F.min(reached), F.max("bucket")).alias("prefix"),
            F.min_by(F.struct("part", "upto"), F.struct(F.col("upto") < F.col("budget"),
                     F.when(F.col("upto") < F.col("budget"), -F.col("bucket")).otherwise(F.col("bucket")))).alias("at"))
        found = scratch.table(edge.select("source", "budget", "prefix", (F.col("at.upto") - F.col("at.part")).alias("below"),
                                          F.col("at.upto").alias("upto")))
    take_edge = F.abs(F.col("upto") - F.col("budget")) < F.abs(F.col("budget") - F.col("below"))
    return found.select("source", (F.col("prefix") + take_edge.cast("bigint")).alias("cut"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``size``, ``source_size``, ``target`` and ``repeats``.

    ``size`` counts words; a null or empty text has 0. A null source is a source, the last in
    order. Rows that agree in key and text share a hash and are taken alike, so a boundary among
    equal rows falls beside all of them. Documents without words are taken like the others,
    with their hash. An empty table gives no rows. Result columns whose name the input has
    get underscores. The result depends on the rows alone, not on their order.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rest = [c for c in docs.columns if c != text]
    size, total, target, repeats, hashed = (fresh_name(rest, n) for n in (
        "size", "source_size", "target", "repeats", "_hash"))
    rows = scratch.table(docs.select(*rest, word_count(F.col(text)).alias(size),
                                     document_hash(F.col(key), F.col(text)).alias(hashed)))
    sizes = rows.select(F.col(source).alias("source"), F.col(size).alias("size"), F.col(hashed).alias("hash"))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = scratch.table(targets(sources, scratch, weights, share, max_repeats))
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = scratch.table(aims.withColumn("whole", ratio.cast("bigint"))
                         .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")))
    cuts = thresholds(sizes, aims.where("source_size > 0"), scratch)
    plan = scratch.table(aims.join(cuts.withColumnRenamed("source", "s"), aims["source"].eqNullSafe(F.col("s")), "left")
                         .select(F.col("source").alias("_s"), F.col("source_size").alias("_n"), F.col("target").alias("_t"),
                                 F.col("whole").alias("_w"), F.coalesce("cut", F.lit(0)).alias("_cut")))
    # one row a source: the source table's own size decides whether Spark broadcasts it
    out = rows.join(plan, rows[source].eqNullSafe(plan["_s"]))
    extra = (F.col(hashed) < F.col("_cut")).cast("bigint")
    return out.select(*[rows[c] for c in rest], rows[size], F.col("_n").alias(total), F.col("_t").alias(target),
                      (F.col("_w") + extra).alias(repeats))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """``docs``, each row as often as the mix takes it (rows taken 0 times are gone)."""
    hashed, times = fresh_name(docs.columns, "_hash"), fresh_name(docs.columns, "_times")
    slim = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(source).alias("source"),
                       document_hash(F.col(key), F.col(text)).alias("h"))
    taken = mix(slim, "k", "t", "source", **settings)
    # equal (source, key, text) rows share their repeats: one row of each is enough for the join
    taken = taken.groupBy("source", "h").agg(F.max("repeats").alias(times)).where(F.col(times) > 0)
    rows = docs.withColumn(hashed, document_hash(F.col(key), F.col(text)))
    out = rows.join(taken, (rows[hashed] == taken["h"]) & rows[source].eqNullSafe(taken["source"]))
    out = out.select(*[rows[c] for c in docs.columns], times)
    return (out.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns))
