"""Graph preparation operators on plain edge frames (``src, dst[, weight]``).

Each is one or two aggregations; ids may be BIGINT or STRING. Aggregations run
partial (map-side) first, so a vertex holding a third of all edges costs one row per
task before the shuffle. Adjacency lists are the one place where rows of a group are
gathered into one value: lists are cut into chunks of a fixed length, so a hot source
becomes several rows (several ``id: [...]`` lines) instead of one unbounded array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators.salting import Written, salted_join, write_once

# default length of an adjacency chunk (list entries)
MAX_LIST = 100_000
# copies of one edge that one array expands to
COPIES = 65_536


def vertex_set(edges: DataFrame) -> DataFrame:
    """Sources and targets, each once (``id``)."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def written_pairs(edges: DataFrame) -> Written:
    """The distinct edges ``src, dst, mult[, weight]`` (number of copies, least weight), written once, with the
    frequent sources and targets."""
    least = [F.min("weight").alias("weight")] if "weight" in edges.columns else []
    return write_once(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("mult"), *least), ["src", "dst"])


def out_degree(edges: DataFrame, include_sinks: bool = True, copies: str | None = None) -> DataFrame:
    """``id, out_degree``; duplicate edges count, as often as the column ``copies`` says where one is named;
    sinks get 0 when ``include_sinks``."""
    zero = F.lit(0).cast("bigint")
    ends = [F.struct(F.col("src").alias("id"), (F.col(copies) if copies else F.lit(1)).cast("bigint").alias("one"))]
    if include_sinks:
        ends.append(F.struct(F.col("dst").alias("id"), zero.alias("one")))
    rows = edges.select(F.inline(F.array(*ends)))
    return rows.groupBy("id").agg(F.sum("one").cast("bigint").alias("out_degree"))


def sink_vertices(edges: DataFrame) -> DataFrame:
    """Targets that are no source (anti join on the key), ``id``."""
    targets = edges.select(F.col("dst").alias("id")).distinct()
    sources = edges.select(F.col("src").alias("id")).distinct()
    return targets.join(sources, "id", "left_anti")


def known_targets(edges: DataFrame, vertices: DataFrame | None = None, bucket: int | None = None) -> DataFrame:
    """Edges whose target is in ``vertices`` (by default: is a source of an edge; semi join), duplicates kept.

    Identical edges are counted first and expanded again afterwards, so the semi join on
    the target sees distinct rows and can split a hot target.
    """
    counted = write_once(edges.groupBy(*edges.columns).agg(F.count(F.lit(1)).alias("_n")), ["dst"])
    known = source_vertices(counted.frame) if vertices is None else vertices.select("id").distinct()
    kept = salted_join(counted, known, "dst", "id", spread="src", how="left_semi", bucket=bucket)
    # the copies of an edge come in blocks, so that no array grows with their number
    last = F.floor((F.col("_n") - 1) / F.lit(COPIES)).cast("bigint")
    blocks = kept.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    copies = F.least(F.lit(COPIES).cast("bigint"), F.col("_n") - F.col("_b") * F.lit(COPIES)).cast("int")
    return blocks.select(*edges.columns, F.explode(F.array_repeat(F.lit(True), copies)).alias("_i")).drop("_i")


def source_vertices(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("id")).distinct()


def graph_stats(edges: DataFrame) -> DataFrame:
    """One row: edges, distinct edges, self-loops, vertices, sources, sinks.

    One chain of aggregations: per edge pair, per vertex, then global.
    """
    pairs = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("mult"))
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    loops = F.when(F.col("src") == F.col("dst"), F.col("mult")).otherwise(zero)
    out = F.struct(F.col("src").alias("id"), F.col("mult").alias("deg"), one.alias("npairs"), loops.alias("nself"))
    into = F.struct(F.col("dst").alias("id"), zero.alias("deg"), zero.alias("npairs"), zero.alias("nself"))
    per_vertex = (
        pairs.select(F.inline(F.array(out, into)))
        .groupBy("id")
        .agg(F.sum("deg").alias("deg"), F.sum("npairs").alias("npairs"), F.sum("nself").alias("nself"))
    )
    return per_vertex.agg(
        F.coalesce(F.sum("deg"), zero).cast("bigint").alias("num_edges"),
        F.coalesce(F.sum("npairs"), zero).cast("bigint").alias("num_distinct_edges"),
        F.coalesce(F.sum("nself"), zero).cast("bigint").alias("num_self_loops"),
        F.count(F.lit(1)).alias("num_vertices"),
        F.count_if(F.col("deg") > 0).alias("num_sources"),
        F.count_if(F.col("deg") == 0).alias("num_sinks"),
    )


def list_bucket(spread: Column, buckets: Column) -> Column:
    """Bucket of a list entry: the first 32 bits of the MD5 of its text, modulo ``buckets``."""
    return F.pmod(F.conv(F.substring(F.md5(spread.cast("string")), 1, 8), 16, 10).cast("bigint"), buckets)


def chunked_lists(edges: DataFrame, value: str = "dst", max_len: int = MAX_LIST,
                  id_col: str = "id", out_col: str = "out", spread: Column | None = None) -> DataFrame:
    """Gather ``value`` per ``src`` into sorted arrays: ``id, chunk, out``, at most ``max_len`` entries a row.

    A source with ``d`` distinct values deals them to ``ceil(d / max_len)`` buckets by a hash of ``spread``
    (the value by default); the sorted entries of a bucket, repeats included, are cut every ``max_len``
    entries. The ``i``-th cut of bucket ``b`` has the chunk number ``i * buckets + b``. The rows depend on
    the edges and ``max_len`` alone. A window holds the distinct values of one bucket, about ``max_len``,
    however hot the source and however often an edge repeats.
    """
    counted = write_once(edges.groupBy("src", value).agg(F.count(F.lit(1)).alias("mult"))).frame
    return cut_lists(counted, value, max_len, id_col, out_col, spread)


def cut_lists(counted: DataFrame, value: str, max_len: int, id_col: str = "id", out_col: str = "out",
              spread: Column | None = None) -> DataFrame:
    """The lists of ``chunked_lists`` from distinct ``src, <value>`` with their number of copies ``mult``, read twice."""
    size = F.lit(max_len).cast("bigint")
    # only sources of several buckets are listed, at most one per ``max_len`` distinct edges
    hot = (
        counted.groupBy("src").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > size)
        .select("src", F.ceil(F.col("d") / size).cast("bigint").alias("buckets"))
    )
    one = F.lit(1).cast("bigint")
    dealt = counted.join(hot, "src", "left")
    dealt = dealt.withColumn("buckets", F.coalesce("buckets", one))
    dealt = dealt.withColumn("bucket", F.when(F.col("buckets") == 1, F.lit(0).cast("bigint"))
                             .otherwise(list_bucket(F.col(value) if spread is None else spread, F.col("buckets"))))
    before = Window.partitionBy("src", "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("stop", F.sum("mult").over(before)).withColumn("start", F.col("stop") - F.col("mult"))
    first = F.floor(F.col("start") / size).cast("bigint")
    last = F.floor((F.col("stop") - 1) / size).cast("bigint")
    cut = placed.withColumn("cut", F.explode(F.sequence(first, last)))
    here = F.least(F.col("stop"), (F.col("cut") + 1) * size) - F.greatest(F.col("start"), F.col("cut") * size)
    entry = F.struct(F.col(value).alias("v"), here.cast("int").alias("c"))
    grouped = cut.groupBy("src", "bucket", "cut").agg(
        F.first("buckets").alias("buckets"), F.array_sort(F.collect_list(entry)).alias("entries")
    )
    return grouped.select(
        F.col("src").alias(id_col),
        (F.col("cut") * F.col("buckets") + F.col("bucket")).alias("chunk"),
        F.flatten(F.transform("entries", lambda x: F.array_repeat(x["v"], x["c"]))).alias(out_col),
    )


def adjacency(edges: DataFrame, max_len: int = MAX_LIST) -> DataFrame:
    """``id, chunk, out``: sorted target lists of every source, ``max_len`` entries a row at most."""
    return chunked_lists(edges, "dst", max_len)


def adjacency_weighted(edges: DataFrame, max_len: int = MAX_LIST) -> DataFrame:
    """``id, chunk, out_dst, out_weight``: lists of ``(dst, weight)`` sorted by target then weight."""
    pairs = edges.select("src", F.struct("dst", "weight").alias("edge"))
    # the weight spreads an edge of very many weights; six decimals, nothing where they do not fit
    weight = F.coalesce(F.col("edge.weight").try_cast("decimal(38,6)").cast("string"), F.lit(""))
    spread = F.concat(F.col("edge.dst").cast("string"), F.lit(","), weight)
    lists = chunked_lists(pairs, "edge", max_len, out_col="adj", spread=spread)
    return lists.select(
        "id", "chunk",
        F.transform("adj", lambda e: e["dst"]).alias("out_dst"),
        F.transform("adj", lambda e: e["weight"]).alias("out_weight"),
    )


def complete_vertices(edges: DataFrame, max_len: int = MAX_LIST) -> DataFrame:
    """Adjacency of every vertex: sources with their lists, sinks as ``(id, 0, [])``."""
    counted = write_once(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("mult"))).frame
    lists = cut_lists(counted, "dst", max_len)
    return lists.unionByName(empty_lists(sink_vertices(counted), lists.schema["out"].dataType))


def empty_lists(vertices: DataFrame, kind) -> DataFrame:
    """``id, chunk, out`` with an empty list of type ``kind`` for each vertex."""
    return vertices.select("id", F.lit(0).cast("bigint").alias("chunk"), F.array().cast(kind).alias("out"))


def explode_adjacency(adjacency_rows: DataFrame, keep_sinks: bool = False) -> DataFrame:
    """One row per list entry (``src, dst``); with ``keep_sinks`` an empty list gives ``dst`` NULL."""
    gen = F.explode_outer("out") if keep_sinks else F.explode("out")
    return adjacency_rows.select(F.col("id").alias("src"), gen.alias("dst"))
