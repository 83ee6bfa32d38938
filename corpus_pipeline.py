"""Corpus pipeline: documents to packed training sequences in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over what its predecessor kept. All but
the last return the columns of ``documents``; ``run`` writes each stage's result in the
session's checkpoint folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graphloom.llm import line_dedup, mixing, packing, quality, simhash
from graphloom.llm.common import Scratch
from graphloom.llm.queries import table, tokenizer_path
from graphloom.session import ship_package

# bytes of rows that Spark hands to a Python worker at a time (its own bound is 64 MB): they lie in the executor's memory
# outside its heap, in the worker as Arrow and again as pandas, in every task at once
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def _for_workers(spark: SparkSession) -> None:
    """Ships the package and bounds the batches of the session's Python workers; a lower bound that is set stays. The
    bound outlives the call, as a stage's frame runs after it."""
    ship_package(spark)
    now = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ARROW_BYTES)))
    if now > BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones, predicts as good."""
    _for_workers(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are near copies of earlier ones; ``n_chars`` counted anew."""
    _for_workers(spark)
    return line_dedup.without_repeats(docs, length="n_chars")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each SimHash group."""
    _for_workers(spark)
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target mix of the sources takes them."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, each a power-of-two piece of one document."""
    _for_workers(spark)
    return packing.pack(docs.select("doc_id", "source", "text"), tokenizer_path())


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("simhash", simhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# the first stage is a trained model and the last a tokenizer: SQL cannot express them
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the packed sequences."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        kept = scratch.table(stage(spark, docs, sf_dir))
        scratch.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
