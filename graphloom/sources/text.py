"""Text sources: weighted edge lists and adjacency lists.

Edge list: ``src, dst, weight`` per line, spaces around fields allowed, CRLF
accepted. Adjacency list: ``id: [a, b, ...]`` per line; ``id: []`` is a vertex
without out-edges. A malformed line fails the job, whatever the session's ANSI setting. Both readers return DataFrames and never pass rows through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def read_edges(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Scan an edge-list file or folder by the rule of ``parse_edge_lines``; with ``strict=False`` malformed lines are
    left out (``malformed_edge_lines`` tells them)."""
    return parse_edge_lines(spark.read.text(path), strict=strict)


def _edge_fields(value: Column) -> dict[str, Column]:
    """The typed fields of an edge line, NULL where malformed; fields after the third are not looked at."""
    parts = F.split(value, ",")
    kinds = {"src": "bigint", "dst": "bigint", "weight": "double"}
    return {name: F.trim(F.get(parts, F.lit(i))).try_cast(kind) for i, (name, kind) in enumerate(kinds.items())}


def parse_edge_lines(lines: DataFrame, column: str = "value", strict: bool = True) -> DataFrame:
    """Parse ``src, dst, weight`` text in ``column``; fields after the third are ignored.

    Blank and null lines are skipped; a line with a missing, an empty or a non-numeric field fails the job, or is left out with
    ``strict=False``.
    """
    value = F.col(column)
    blank = F.length(F.trim(value)) == 0
    fields = _edge_fields(value)
    if not strict:
        rows = lines.where(~blank).select(*[c.alias(name) for name, c in fields.items()])
        return rows.where(" AND ".join(f"{name} IS NOT NULL" for name in fields))
    # the test on blank lines is part of each field: the optimizer may evaluate fields before the filter
    fail = F.raise_error(F.concat(F.lit("malformed edge line: "), value))
    return lines.where(~blank).select(*[
        F.when(~blank & c.isNull(), fail.cast(kind)).otherwise(c).alias(name)
        for (name, c), kind in zip(fields.items(), ("bigint", "bigint", "double"))])


def malformed_edge_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines (``line``) that ``parse_edge_lines`` fails on."""
    value = F.col(column)
    bad = [c.isNull() for c in _edge_fields(value).values()]
    return lines.where((F.length(F.trim(value)) > 0) & (bad[0] | bad[1] | bad[2])).select(value.alias("line"))


# the whole line: an id, a colon, a bracketed list of ids that may be empty
ADJACENCY_LINE = r"^\s*[+-]?\d+\s*:\s*\[\s*([+-]?\d+\s*(,\s*[+-]?\d+\s*)*)?\]\s*$"


def parse_adjacency_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse ``id: [a, b, ...]`` text into ``id BIGINT, out ARRAY<BIGINT>``.

    Blank lines are skipped; a line of any other form, a list entry that is no number
    included, fails.
    """
    value = F.col(column)
    # every failing expression is guarded by the blank test itself: the optimizer may
    # evaluate pushed-down or inferred predicates before the filter on blank lines
    blank = F.length(F.trim(value)) == 0
    head = F.trim(F.split_part(value, F.lit(":"), F.lit(1)))
    body = F.trim(F.substring_index(value, ":", -1))
    parsed = F.from_json(body, "array<bigint>")
    out = (
        F.when(blank, F.lit(None))
        .when(F.instr(value, ":") == 0,
              F.raise_error(F.concat(F.lit("adjacency line without ':': "), value)))
        .when(~value.rlike(ADJACENCY_LINE) | parsed.isNull(),
              F.raise_error(F.concat(F.lit("malformed adjacency list: "), value)))
        .otherwise(parsed)
    )
    return lines.where(~blank).select(
        F.when(blank, F.lit(None)).otherwise(head).cast("bigint").alias("id"),
        out.cast("array<bigint>").alias("out"),
    )


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    return parse_adjacency_lines(spark.read.text(path))


def adjacency_to_edges(adjacency: DataFrame) -> DataFrame:
    """One row per list entry, duplicates kept (``src, dst``)."""
    return adjacency.select(F.col("id").alias("src"), F.explode("out").alias("dst"))


def listed_vertices(adjacency: DataFrame) -> DataFrame:
    """Vertices that have a line of their own (with or without out-edges)."""
    return adjacency.select("id").distinct()
