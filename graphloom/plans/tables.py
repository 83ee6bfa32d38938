"""Bucketed Parquet tables of one run, below the session's checkpoint folder.

A bucketed table keeps its hash partitioning on disk: two tables with the same number of buckets, bucketed by
the columns that join them, meet without a shuffle, under adaptive execution too, and any
executor can read them again after another was lost. Spark knows the buckets of a table through its catalog, so each
table has a catalog entry (with a name of its own) while it is in use.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.session import require_checkpoint_dir

# folders that a table is cut into beside its buckets, at most
MAX_BLOCKS = 1024
# Spark's setting that deletes an execution's shuffle files when it ends
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def blocks_of(buckets: int) -> int:
    return min(buckets, MAX_BLOCKS)


def block_of(key: str, buckets: int) -> Column:
    """The block of a row bucketed by ``key``: consecutive buckets share one."""
    return F.expr(f"cast(pmod(hash({key}), {buckets}) * {blocks_of(buckets)}L div {buckets} as int)")


class RunTables:
    """The tables of one run. ``close`` deletes them; what is still open goes when the driver's Python ends, unless
    ``lasting``."""

    def __init__(self, spark: SparkSession, kind: str, root: str | None = None, lasting: bool = False):
        self.spark = spark
        self.name = f"graphloom_{kind}_{uuid.uuid4().hex}"
        self.root = root or f"{require_checkpoint_dir(spark).rstrip('/')}/{self.name}"
        self.open: set[str] = set()
        self.bucketed: set[str] = set()
        if not lasting:
            atexit.register(self.close)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, frame: DataFrame, name: str, buckets: int = 0, keys: tuple[str, ...] = (),
             block: str | None = None) -> DataFrame:
        """``frame``, written once and read back; with ``keys`` in ``buckets`` buckets, each a file sorted by
        ``keys``; with ``block`` in a folder per value of that column. The written table replaces the shuffle
        files of the steps that led to it."""
        before = self.spark.conf.get(FREE_SHUFFLES, "false")
        self.spark.conf.set(FREE_SHUFFLES, "true")
        try:
            return self._save(frame, name, buckets, keys, block)
        finally:
            self.spark.conf.set(FREE_SHUFFLES, before)

    def _save(self, frame: DataFrame, name: str, buckets: int, keys: tuple[str, ...], block: str | None) -> DataFrame:
        if not keys:
            frame.write.mode("overwrite").parquet(self.path(name))
            self.open.add(name)
            return self.spark.read.schema(frame.schema).parquet(self.path(name))
        table = f"{self.name}_{name}".replace("-", "_")
        if name in self.bucketed:  # its place, columns and buckets stay: only the rows change
            frame.write.insertInto(table, overwrite=True)
        else:
            writer = (frame.write.format("parquet").mode("overwrite").option("path", self.path(name))
                      .bucketBy(buckets, *keys).sortBy(*keys))
            (writer.partitionBy(block) if block else writer).saveAsTable(table)
            self.bucketed.add(name)
        self.open.add(name)
        return self.spark.table(table)

    def attach(self, name: str, buckets: int, keys: tuple[str, ...], block: str | None = None) -> DataFrame:
        """A table that another driver saved under this folder with the same ``buckets``, ``keys`` and ``block``."""
        table = f"{self.name}_{name}".replace("-", "_")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(self.path(name)).schema)
        by = ", ".join(keys)
        self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {f'PARTITIONED BY ({block})' if block else ''} "
                       f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{self.path(name)}'")
        if block:
            self.spark.sql(f"MSCK REPAIR TABLE {table}")
        self.bucketed.add(name)
        self.open.add(name)
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.bucketed:
                self.bucketed.discard(name)
                self._quietly(lambda: self.spark.sql(f"DROP TABLE IF EXISTS {f'{self.name}_{name}'.replace('-', '_')}"))
            if name in self.open:
                self.open.discard(name)
                self._delete(self.path(name))
        if not self.open:
            self._delete(self.root)

    def close(self, keep: tuple[str, ...] = ()) -> None:
        """Delete all tables but those in ``keep``."""
        self.drop(*[n for n in sorted(self.open) if n not in keep])

    def _delete(self, path: str) -> None:
        def gone() -> None:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

        self._quietly(gone)

    @staticmethod
    def _quietly(action) -> None:
        try:
            action()
        except Exception:  # the session may be gone at exit; its folder is the cluster's to clear
            pass
