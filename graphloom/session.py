"""Session helpers: building a local session and locating the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "graphloom") -> SparkSession:
    """A session for tests and benchmarks. On a cluster, use the cluster's own session."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # checkpoint files of finished rounds are removed once their frames are gone
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext on this client (Spark Connect)
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the session names, or None."""
    return _context_dir(spark) or spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder; ``fallback`` only where none is set and driver and
    executors are one process (tests, local runs). Elsewhere a missing folder is an error."""
    current = checkpoint_dir(spark)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = fallback
    if not _context_dir(spark):
        try:
            spark.sparkContext.setCheckpointDir(current)
        except Exception:  # Spark Connect: the server reads spark.checkpoint.dir itself
            pass
    return current


def require_checkpoint_dir(spark: SparkSession) -> str:
    """Iterative plans need a reliable checkpoint folder; fail early when there is none."""
    current = checkpoint_dir(spark)
    if not current:
        raise RuntimeError(
            "no checkpoint folder: set spark.checkpoint.dir to a shared folder "
            "(or call SparkContext.setCheckpointDir) before running iterative graph plans"
        )
    if not _context_dir(spark):
        try:
            spark.sparkContext.setCheckpointDir(current)
        except Exception:  # Spark Connect: the server reads spark.checkpoint.dir itself
            pass
    return current


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor.

    A zip of the package's modules goes through Spark's own file distribution, once per
    application. Not needed where the package is installed on the cluster.
    """
    context = spark.sparkContext
    if getattr(context, "_graphloom_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="graphloom-zip-"), "graphloom.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    context._graphloom_shipped = True
