"""Shared tables of the operators: written in the session's checkpoint folder, read back.

A step whose result is read more than once, or that ends a long lineage, is written as
Parquet below ``spark.checkpoint.dir``. Any executor can read it again after another was
lost, the files hold only the named columns, and the size that Spark sees is the real one.
"""

from __future__ import annotations

import atexit
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from graphloom.session import require_checkpoint_dir

# fixed values: ASCII white space separates words (tab, line feed, vertical tab, form
# feed, carriage return, blank); every other character belongs to a word
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Spark's setting that deletes an execution's shuffle files when it ends
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """The written tables of one call. ``drop`` deletes one that no later step reads; what
    the returned frame still reads is deleted when the driver's Python ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{require_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        self.n = 0
        atexit.register(_delete, spark, self.root)

    def table(self, frame: DataFrame) -> DataFrame:
        """``frame``, written once and read back."""
        path = f"{self.root}/{self.n}"
        self.n += 1
        # the written table replaces the shuffle files of the steps that led to it
        before = self.spark.conf.get(FREE_SHUFFLES, "false")
        self.spark.conf.set(FREE_SHUFFLES, "true")
        try:
            frame.write.parquet(path)
        finally:
            self.spark.conf.set(FREE_SHUFFLES, before)
        out = self.spark.read.schema(frame.schema).parquet(path)
        self.paths[id(out)] = path
        self.keep = getattr(self, "keep", [])
        self.keep.append(out)  # an id stays one frame's as long as the frame lives
        return out

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            path = self.paths.pop(id(frame), None)
            if path:
                _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone at exit; its folder is the cluster's to clear
        pass


def small_frame(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """The driver's few ``rows`` as a frame. They go as Arrow into the plan itself: a list given to ``createDataFrame``
    is read by Python workers of another kind, that each executor then holds beside those of the operators."""
    fields = to_arrow_schema(schema)
    columns = zip(*rows) if rows else ([] for _ in fields)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields), schema)


def numbered(scratch: Scratch, frame: DataFrame, *order: Column, name: str = "pos") -> DataFrame:
    """``frame`` with ``name`` = 0, 1, 2, ... in ``order``, without a one-partition window.

    Range partitions are sorted and written; each file partition's row count (one small
    row a partition) gives its offset. Rows equal in ``order`` are numbered in any order.
    """
    spark = frame.sparkSession
    sorted_rows = scratch.table(
        frame.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    counts = sorted_rows.groupBy("_part").agg(F.count(F.lit(1)).alias("c")).collect()
    offsets, total = [], 0
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((row["_part"], total))
        total += row["c"]
    # one row per partition: the bound does not grow with the rows
    offset_frame = small_frame(spark, offsets, StructType().add("_part", "integer").add("_offset", "long"))
    local = F.col("_mid") - F.shiftleft(F.col("_part").cast("bigint"), 33)
    return sorted_rows.join(F.broadcast(offset_frame), "_part").select(
        *frame.columns, (F.col("_offset") + local).cast("bigint").alias(name)
    )


def fresh_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores before it until no column of ``taken`` has that name
    (column names compare without case, as Spark's do)."""
    lower = {c.lower() for c in taken}
    while wanted.lower() in lower:
        wanted = "_" + wanted
    return wanted


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def release_memory() -> None:
    """Hand freed memory of a Python worker back to the system: workers live on between tasks, beside the
    other workers of their executor."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
