"""Run-metric records (Spark REST API JSON arrays) as DataFrames.

Each run is a folder holding ``jobs.json``, ``executors.json``, ``details.json``,
``storage_rdd.json`` and, when present, ``stages.json``. The readers take a glob of
such folders and read all runs at once with a written schema (absent fields become
NULL); the run id is the folder name, taken from the file path metadata.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

JOBS_SCHEMA = (
    "jobId INT, name STRING, submissionTime STRING, completionTime STRING, "
    "stageIds ARRAY<INT>, status STRING, numTasks INT, numCompletedTasks INT, "
    "numSkippedTasks INT, numFailedTasks INT, numCompletedStages INT, numSkippedStages INT"
)

STAGES_SCHEMA = (
    "stageId INT, name STRING, status STRING, numTasks INT, numFailedTasks INT, "
    "submissionTime STRING, completionTime STRING, executorRunTime BIGINT, "
    "executorCpuTime BIGINT, executorDeserializeTime BIGINT, resultSerializationTime BIGINT, "
    "inputBytes BIGINT, inputRecords BIGINT, outputBytes BIGINT, outputRecords BIGINT, "
    "shuffleFetchWaitTime BIGINT, shuffleReadBytes BIGINT, shuffleReadRecords BIGINT, "
    "shuffleWriteBytes BIGINT, shuffleWriteTime BIGINT, shuffleWriteRecords BIGINT, "
    "shuffleRemoteBlocksFetched BIGINT, shuffleLocalBlocksFetched BIGINT, "
    "peakExecutionMemory BIGINT, shuffleRemoteReqsDuration BIGINT, speculationSummary STRUCT<numTasks: BIGINT>"
)

EXECUTORS_SCHEMA = (
    "id STRING, totalCores INT, completedTasks INT, failedTasks INT, totalGCTime BIGINT, "
    "totalShuffleRead BIGINT, totalShuffleWrite BIGINT, diskUsed BIGINT, memoryUsed BIGINT, "
    "memoryMetrics STRUCT<usedOnHeapStorageMemory: BIGINT, usedOffHeapStorageMemory: BIGINT, "
    "totalOnHeapStorageMemory: BIGINT, totalOffHeapStorageMemory: BIGINT>, "
    "peakMemoryMetrics STRUCT<JVMHeapMemory: BIGINT, JVMOffHeapMemory: BIGINT>"
)

DETAILS_SCHEMA = (
    "id STRING, name STRING, attempts ARRAY<STRUCT<startTime: STRING, endTime: STRING, "
    "duration: BIGINT, sparkUser: STRING, completed: BOOLEAN, appSparkVersion: STRING>>"
)

STORAGE_SCHEMA = (
    "id INT, name STRING, numPartitions INT, numCachedPartitions INT, storageLevel STRING, "
    "memoryUsed BIGINT, diskUsed BIGINT"
)

SCHEMAS = {
    "jobs": JOBS_SCHEMA,
    "stages": STAGES_SCHEMA,
    "executors": EXECUTORS_SCHEMA,
    "details": DETAILS_SCHEMA,
    "storage_rdd": STORAGE_SCHEMA,
}


def read_records(spark: SparkSession, runs_glob: str, kind: str) -> DataFrame:
    """All records of one kind under ``runs_glob`` (folders), with ``app_id`` first."""
    if kind not in SCHEMAS:
        raise ValueError(f"unknown record kind {kind!r}; one of {sorted(SCHEMAS)}")
    frame = (
        spark.read.schema(SCHEMAS[kind])
        .option("multiLine", True)
        .json(f"{runs_glob.rstrip('/')}/{kind}.json")
    )
    app = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    return frame.select(app.alias("app_id"), *frame.columns)


# ---------------------------------------------------------------- records from a table
# The run-metric queries of the catalog read the ``events`` table in the shape of run
# records, so their work grows with the data: every user is one application run,
# every event one stage (an ``error`` event is a failed stage, any other complete;
# it runs for ``value`` seconds and its task count is the ``k`` field of ``props``),
# and the events of one type of one user form one job.


def utc_time(frame: DataFrame, column: str = "ts") -> Column:
    """A time column as a timestamp: one without time zone is read as UTC, whatever the session's."""
    if isinstance(frame.schema[column].dataType, TimestampNTZType):
        return F.to_timestamp(F.concat(F.col(column).cast("string"), F.lit("Z")))
    return F.col(column).cast("timestamp")


def stages_from_events(events: DataFrame) -> DataFrame:
    from graphloom.functions.scalar import json_long_or_zero, rest_time_string

    run_ms = F.round(F.col("value") * 1000).cast("bigint")
    start = utc_time(events)
    end = F.timestamp_millis(F.unix_millis(start) + run_ms)
    return events.select(
        F.col("user_id").alias("app_id"),
        F.col("event_id").alias("stageId"),
        F.col("event_type").alias("name"),
        F.when(F.col("event_type") == "error", F.lit("FAILED")).otherwise(F.lit("COMPLETE")).alias("status"),
        json_long_or_zero("props", "k").alias("numTasks"),
        rest_time_string(start).alias("submissionTime"),
        rest_time_string(end).alias("completionTime"),
        run_ms.alias("executorRunTime"),
    )


def jobs_from_events(events: DataFrame) -> DataFrame:
    from graphloom.functions.scalar import rest_time_string

    start = utc_time(events)
    return events.groupBy("user_id", "event_type").agg(
        F.min("event_id").alias("jobId"),
        F.min(start).alias("first_ts"),
        F.max(start).alias("last_ts"),
        F.count(F.lit(1)).alias("numTasks"),
    ).select(
        F.col("user_id").alias("app_id"),
        "jobId",
        F.concat(F.col("event_type"), F.lit(" events")).alias("name"),
        rest_time_string("first_ts").alias("submissionTime"),
        rest_time_string("last_ts").alias("completionTime"),
        F.lit("SUCCEEDED").alias("status"),
        "numTasks",
    )
