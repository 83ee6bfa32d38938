"""Run-metrics report as aggregations per application id.

The single-run text report of the reference becomes rows ``app_id, section, metric,
value, unit`` for any number of runs: the records of all kinds, each projected to its own
metrics, are one union with one grouped aggregation, which ``stack`` unpivots -- no joins, no
driver loop, one exchange. Field names are the
REST API's own (``inputBytes``, ``shuffleFetchWaitTime``, ``peakMemoryMetrics``); an
absent field counts as 0. "Storage memory" is labelled as such. The API tells no shuffle read
time; the time a stage waited for its fetches is the nearest, with that of its remote requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.scalar import duration_ms, field_or_zero, parse_rest_time


def with_durations(records: DataFrame) -> DataFrame:
    """Add ``duration_ms`` (NULL unless both times are present)."""
    start = parse_rest_time("submissionTime")
    end = parse_rest_time("completionTime")
    return records.withColumn(
        "duration_ms",
        F.when(F.col("submissionTime").isNotNull() & F.col("completionTime").isNotNull(),
               duration_ms(start, end)),
    )


def stage_listing(stages: DataFrame) -> DataFrame:
    """Per-stage detail: id, name, status, tasks, duration."""
    return with_durations(stages).select(
        "app_id", "stageId", "name", "status", "numTasks", "duration_ms"
    )


STAGE_SUMS = [
    ("executor_run_time", "executorRunTime", "ms"),
    ("executor_cpu_time", "executorCpuTime", "ns"),
    ("executor_deserialize_time", "executorDeserializeTime", "ms"),
    ("result_serialization_time", "resultSerializationTime", "ms"),
    ("fetch_wait_time", "shuffleFetchWaitTime", "ms"),
    ("bytes_read", "inputBytes", "bytes"),
    ("bytes_written", "outputBytes", "bytes"),
    ("records_read", "inputRecords", "records"),
    ("records_written", "outputRecords", "records"),
    ("shuffle_read_bytes", "shuffleReadBytes", "bytes"),
    ("shuffle_write_time", "shuffleWriteTime", "ns"),
    ("shuffle_records_read", "shuffleReadRecords", "records"),
    ("shuffle_records_written", "shuffleWriteRecords", "records"),
    ("remote_blocks_fetched", "shuffleRemoteBlocksFetched", "blocks"),
    ("local_blocks_fetched", "shuffleLocalBlocksFetched", "blocks"),
    ("failed_tasks", "numFailedTasks", "tasks"),
    ("peak_execution_memory", "peakExecutionMemory", "bytes"),
    ("shuffle_request_time", "shuffleRemoteReqsDuration", "ms"),
    ("speculative_tasks", "speculationSummary.numTasks", "tasks"),
]

EXECUTOR_SUMS = [
    ("shuffle_read", "totalShuffleRead", "bytes"),
    ("shuffle_write", "totalShuffleWrite", "bytes"),
    ("storage_memory_used", "memoryMetrics.usedOnHeapStorageMemory", "bytes"),
    ("storage_memory_off_heap", "memoryMetrics.usedOffHeapStorageMemory", "bytes"),
    ("disk_used", "diskUsed", "bytes"),
    ("gc_time", "totalGCTime", "ms"),
    ("jvm_heap_peak", "peakMemoryMetrics.JVMHeapMemory", "bytes"),
    ("jvm_off_heap_peak", "peakMemoryMetrics.JVMOffHeapMemory", "bytes"),
    ("executor_failed_tasks", "failedTasks", "tasks"),
]


Metric = tuple[str, Column, str]


def _sums(records: DataFrame, fields: list[tuple[str, str, str]]) -> list[Metric]:
    """The sums of ``fields`` whose top-level column ``records`` has."""
    return [(name, field_or_zero(F.col(field).cast("bigint")), unit)
            for name, field, unit in fields if field.split(".")[0] in records.columns]


def stage_metrics(stages: DataFrame, complete_status: str = "COMPLETE") -> list[Metric]:
    complete = F.coalesce(F.col("status") == F.lit(complete_status), F.lit(False))
    return [
        ("total_stages", F.lit(1), "stages"),
        ("executed_stages", complete.cast("int"), "stages"),
        ("skipped_stages", (~complete).cast("int"), "stages"),
        ("total_stage_duration", field_or_zero("duration_ms"), "ms"),
    ] + _sums(stages, STAGE_SUMS)


def executor_metrics(executors: DataFrame) -> list[Metric]:
    return _sums(executors, EXECUTOR_SUMS)


def job_metrics(jobs: DataFrame) -> list[Metric]:
    return [("total_jobs", F.lit(1), "jobs"), ("total_job_duration", field_or_zero("duration_ms"), "ms")]


def run_summary(jobs: DataFrame | None = None, stages: DataFrame | None = None,
                executors: DataFrame | None = None) -> DataFrame:
    """Long-form report ``app_id, section, metric, value, unit`` of all runs given.

    A run without records of a kind has no rows of that section. An absent or null field, and the
    duration of a record without both times, add 0.
    """
    kinds = []
    if stages is not None:
        kinds.append(("stages", with_durations(stages), stage_metrics(stages)))
    if executors is not None:
        kinds.append(("executors", executors, executor_metrics(executors)))
    if jobs is not None:
        kinds.append(("jobs", with_durations(jobs), job_metrics(jobs)))
    if not kinds:
        raise ValueError("run_summary needs at least one of jobs, stages, executors")
    # a record holds null for the metrics of the other kinds, so a sum is null where a run has no record of its kind
    records, labels = None, []
    for section, frame, metrics in kinds:
        own = frame.select("app_id", *[c.cast("bigint").alias(f"{section}_{name}") for name, c, _ in metrics])
        records = own if records is None else records.unionByName(own, allowMissingColumns=True)
        labels += [(section, name, unit) for name, _, unit in metrics]
    totals = records.groupBy("app_id").agg(*[F.sum(f"{s}_{name}").alias(f"{s}_{name}") for s, name, _ in labels])
    parts = ", ".join(f"'{s}', '{name}', CAST(`{s}_{name}` AS DOUBLE), '{unit}'" for s, name, unit in labels)
    long = totals.selectExpr("app_id", f"stack({len(labels)}, {parts}) AS (section, metric, value, unit)")
    return long.where("value IS NOT NULL")


def render_report(summary: DataFrame) -> DataFrame:
    """``app_id, line`` with ``line = "<section>: <metric> = <value> <unit>"``."""
    value = F.format_number(F.col("value"), 0)
    return summary.select(
        "app_id", "section", "metric",
        F.format_string("%s: %s = %s %s", F.col("section"), F.col("metric"), value, F.col("unit")).alias("line"),
    )


def write_report(summary: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per application id (``app_id=<id>``), lines ordered by section and metric."""
    lines = render_report(summary).orderBy("app_id", "section", "metric")
    lines.select("app_id", "line").write.mode(mode).partitionBy("app_id").text(path)
