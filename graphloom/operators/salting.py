"""Joins that split hot keys, over rows that are written once.

A join of a large frame with a per-key frame (one row per key) puts every row of a hot
key in one task. Adaptive execution can split such a partition only when both inputs are
fresh shuffle reads, which is not the case when the per-key side comes straight out of
an aggregation on the same key. So the split is explicit:

* ``write_once`` writes the large side to a table in the checkpoint folder; in the same pass a
  frequent-items sketch of each key column and the row count are observed. Whatever the large side is made
  from is computed once, and later steps read the table;
* a key with more than ``bucket`` rows is hot and gets ``ceil(count / bucket)`` buckets,
  ``bucket = max(MIN_BUCKET, total / partitions)`` -- so about ``partitions`` keys are
  hot at most, the size bound under which the hot list is broadcast;
* large-side rows take bucket ``pmod(xxhash64(spread), nb)``, the per-key row is
  replicated once per bucket, and the join is on ``(key, bucket)``.

The sketch misses no key that holds ``SKETCH_SHARE`` of the rows or more and counts none too low, so it is
certain up to ``1 / SKETCH_SHARE`` partitions; where there are more, keys are counted in the written table.

The large side should be pre-aggregated (duplicates as a count) so that the spread
column is distinct within a key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from graphloom.plans.tables import RunTables
from graphloom.session import shuffle_partitions

MIN_BUCKET = 4096
# largest hot-key list that is broadcast
MAX_BROADCAST_HOT = 1_000_000
# keys a sketch holds, and the share of all rows from which a key is certainly among them
SKETCH_ITEMS = 4096
SKETCH_SHARE = 1 / 2048
# keys that a sketch tells, more than can hold that share each
SKETCH_TOLD = 2 * 2048


@dataclass
class Written:
    """Rows in a table of their own, with what was observed while they were written.

    heavy: per key column the most frequent keys with their row counts, exact or a little too high.
    """

    frame: DataFrame
    rows: int
    heavy: dict[str, list[tuple[object, int]]]
    tables: RunTables

    def bucket(self, partitions: int | None = None, min_bucket: int = MIN_BUCKET) -> int:
        """Rows of a key that stay together."""
        return max(min_bucket, math.ceil(self.rows / (partitions or shuffle_partitions(self.frame.sparkSession))))

    def hot(self, key: str, bucket: int) -> DataFrame | None:
        """``_hk, _nb`` for the keys with more rows than a bucket, or None."""
        if self.rows <= bucket:
            return None
        spark = self.frame.sparkSession
        if key in self.heavy and bucket >= self.rows * SKETCH_SHARE:
            found = [(k, math.ceil(c / bucket)) for k, c in self.heavy[key] if c > bucket]
            if not found:
                return None
            kind = self.frame.schema[key].dataType
            return spark.createDataFrame(found, StructType([StructField("_hk", kind), StructField("_nb", IntegerType())]))
        counts = self.frame.groupBy(F.col(key).alias("_hk")).agg(F.count(F.lit(1)).alias("_c"))
        return counts.where((F.col("_c") > bucket) & F.col("_hk").isNotNull()).select(
            "_hk", F.ceil(F.col("_c") / F.lit(bucket)).cast("int").alias("_nb"))

    def close(self) -> None:
        self.tables.close()


def write_once(frame: DataFrame, keys: Sequence[str] = ()) -> Written:
    """``frame``, written by one job that also sketches the frequent values of ``keys``.

    The table is deleted by ``close``, or when the driver's Python ends.
    """
    seen = Observation()
    sketches = [F.expr(f"approx_top_k(`{k}`, {SKETCH_TOLD}, {SKETCH_ITEMS})").alias(k) for k in keys]
    tables = RunTables(frame.sparkSession, "rows")
    # a name that no key column can have beside the keys' own
    saved = tables.save(frame.observe(seen, F.count(F.lit(1)).alias("count(1)"), *sketches), "rows")
    told = seen.get
    heavy = {k: [(item["item"], int(item["count"])) for item in told[k] or [] if item["item"] is not None] for k in keys}
    return Written(saved, int(told["count(1)"]), heavy, tables)


def hot_keys(big: DataFrame | Written, key: str, partitions: int | None = None,
             min_bucket: int = MIN_BUCKET) -> DataFrame | None:
    """``_hk, _nb`` for keys of ``big`` with more than the bucket size rows, or None."""
    written = big if isinstance(big, Written) else write_once(big, [key])
    return written.hot(key, written.bucket(partitions, min_bucket))


def salted_join(big: DataFrame | Written, small: DataFrame, big_key: str, small_key: str,
                spread: str, how: str = "inner", partitions: int | None = None,
                bucket: int | None = None) -> DataFrame:
    """``big`` joined with ``small`` (unique ``small_key``) on ``big_key == small_key``.

    A ``big`` that is not written yet is. ``bucket``: rows of a key that stay together, by default as
    ``partitions`` asks. Output columns: those of ``big`` then those of ``small`` except ``small_key``
    (``how`` in inner / left_semi / left; for left_semi only ``big``'s columns).
    """
    written = big if isinstance(big, Written) else write_once(big, [big_key])
    big = written.frame
    bucket = bucket or written.bucket(partitions)
    hot = written.hot(big_key, bucket)
    if hot is None:
        joined = big.join(small.withColumnRenamed(small_key, "_sk"), F.col(big_key) == F.col("_sk"), how)
        return joined.drop("_sk")
    # each hot key has more rows than a bucket: that bounds their number
    hot = F.broadcast(hot) if written.rows // bucket <= MAX_BROADCAST_HOT else hot
    big_s = big.join(hot, F.col(big_key) == F.col("_hk"), "left").select(
        *big.columns,
        F.when(F.col("_nb").isNull(), F.lit(0))
        .otherwise(F.pmod(F.xxhash64(spread), F.col("_nb")).cast("int")).alias("_salt"),
    )
    small_s = small.join(hot, F.col(small_key) == F.col("_hk"), "left").select(
        *[F.col(c) for c in small.columns if c != small_key],
        F.col(small_key).alias("_sk"),
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_nb"), F.lit(1)) - 1)).alias("_ssalt"),
    )
    cond = (F.col(big_key) == F.col("_sk")) & (F.col("_salt") == F.col("_ssalt"))
    return big_s.join(small_s, cond, how).drop("_salt", "_sk", "_ssalt")
