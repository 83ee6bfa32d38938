"""One registered query per operator, over whole tables, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import (cap_filters, divergence, licenses, line_dedup, line_hash, mixing, packing, quality, runs,
                           simhash, tool_calls, vafile, warc)
from graphloom.llm.common import Scratch


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_cap_filters(spark: SparkSession, sf: str) -> DataFrame:
    return cap_filters.near_vectors(table(spark, sf, "embeddings").select("vec_id", "embedding", "label"))


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    told = line_dedup.line_decisions(table(spark, sf, "documents").select("doc_id", "text"))
    return told.select(F.col("doc").alias("doc_id"), F.col("line").alias("line_no"), F.col("class_doc").alias("class_doc_id"),
                       F.col("class_line").alias("class_line_no"), "kept")


def op3_vafile(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return vafile.top_vectors(rows, rows.where("vec_id % 100 = 0"))


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.score(docs, quality.train(docs, table(spark, sf, "labels")))


def op5_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf, "documents").select("doc_id", "text"))


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", "source", "size", "source_size", "target",
                        (F.col("size") * F.col("repeats")).alias("taken"))


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf, "documents").select("doc_id", "text"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_tool_calls(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    return tool_calls.link_calls(tool_calls.conversation_calls(turns), tool_calls.conversation_results(turns),
                                 tool_calls.conversation_schemas(spark))


def op9_line_hash(spark: SparkSession, sf: str) -> DataFrame:
    return line_hash.repeated_spans(table(spark, sf, "documents").select("doc_id", "text")).drop("text_hash")


def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    pieces = packing.cut_pieces(docs, tokenizer_path())
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    scratch = Scratch(spark, "op10")
    return packing.number_sequences(scratch.table(digests), scratch)


def op11_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.divergence(table(spark, sf, "documents").select("text", "lang", "source"))


def op12_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = Scratch(spark, "op12").root + "/archives"
    warc.write_archives(warc.page_records(table(spark, sf, "pages")), folder)
    read = warc.resolved(warc.read_archives(spark, folder))
    return read.select(F.col("record_id").try_cast("bigint").alias("page_id"), "payload_bytes", "payload_digest",
                       F.col("kind").alias("record_type"), F.col("refers_to").try_cast("bigint").alias("refers_to"))


def op13_order(doc_id: object, n: int) -> np.ndarray | None:
    """The numbers of the words that are read: one document in ten repeats itself from a place on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10:
        return None
    a = (h // 10) % n
    p = 1 + (n - a) // (3 + (h // 10) % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op13_runs(spark: SparkSession, sf: str) -> DataFrame:
    told = runs.document_runs(table(spark, sf, "documents").select("doc_id", "text"), order=op13_order)
    # runs come by start, then period: of equal exponents the first stays
    best = F.reduce(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)),
                    lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    found = told.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cap_filters": op1_cap_filters,
    "op2_line_dedup": op2_line_dedup,
    "op3_vafile": op3_vafile,
    "op4_quality": op4_quality,
    "op5_licenses": op5_licenses,
    "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash,
    "op8_tool_calls": op8_tool_calls,
    "op9_line_hash": op9_line_hash,
    "op10_packing": op10_packing,
    "op11_divergence": op11_divergence,
    "op12_warc": op12_warc,
    "op13_runs": op13_runs,
}

# brute force: every query row against every row
TOP_SQL = f"""
WITH v AS (
  SELECT DISTINCT CAST(vec_id AS BIGINT) AS id, [floor({vafile.SCALE} * CAST(x AS DOUBLE)) for x in embedding] AS w
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
scored AS (
  SELECT q.id AS query_id, r.id AS vec_id, max(CAST(list_inner_product(q.w, r.w) AS BIGINT)) AS score
  FROM v q JOIN v r ON len(q.w) = len(r.w) AND q.id <> r.id
  WHERE q.id % 100 = 0 GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS nth FROM scored)
SELECT query_id, CAST(nth AS INTEGER) AS rank, vec_id, score FROM ranked WHERE nth <= {vafile.K}
"""

# targets in closed form (sources in order of cap by weight are full up to the first that is not), thresholds by sorting
MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos FROM d GROUP BY source),
w AS (SELECT *, CAST(list_extract({list(mixing.WEIGHTS)}, CAST(pos % {len(mixing.WEIGHTS)} AS INTEGER) + 1) AS DOUBLE) AS weight,
  CAST({mixing.MAX_REPEATS} * source_size AS DOUBLE) AS cap, CAST({mixing.SHARE} AS DOUBLE) * sum(source_size) OVER () AS budget FROM s),
f AS (SELECT *, sum(cap) OVER upto - cap AS full_cap, sum(weight) OVER () - sum(weight) OVER upto + weight AS rest
  FROM w WINDOW upto AS (ORDER BY cap / weight, pos ROWS UNBOUNDED PRECEDING)),
lv AS (SELECT min_by((budget - full_cap) / rest, struct_pack(a := cap / weight, b := pos))
  FILTER (WHERE cap > (budget - full_cap) / rest * weight) AS level FROM f),
t AS (SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target FROM w, lv),
a AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
o AS (SELECT d.*, source_size, target, whole, target - whole * source_size AS budget,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS DOUBLE) AS upto,
    CAST(sum(size) OVER (PARTITION BY d.source, h) AS DOUBLE) AS here
  FROM d JOIN a ON d.source IS NOT DISTINCT FROM a.source),
e AS (SELECT *, min(h) FILTER (WHERE upto >= budget) OVER (PARTITION BY source) AS edge FROM o)
SELECT doc_id, source, size, source_size, target, size * (whole + CASE
    WHEN source_size > 0 AND (h < edge OR h = edge AND abs(upto - budget) < abs(budget - (upto - here))) THEN 1 ELSE 0 END) AS taken
FROM e
"""

ORACLE_SQL: dict[str, str] = {
    "op3_vafile": TOP_SQL,
    "op6_mixing": MIX_SQL,
    "op5_licenses": licenses.scan_sql(),
    "op8_tool_calls": tool_calls.CONVERSATION_SQL,
    "op11_divergence": divergence.DOCUMENTS_SQL,
    "op12_warc": warc.PAGES_SQL,
}
