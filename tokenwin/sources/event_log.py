"""Task and stage tables from Spark's own event log, a JSON table that needs no listener."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = """
`Event` string,
`Stage ID` int,
`Job ID` int,
`Stage IDs` array<int>,
`Properties` struct<`spark.job.tags`: string>,
`Task Info` struct<`Task ID`: bigint, `Launch Time`: bigint, `Finish Time`: bigint, `Failed`: boolean>,
`Task Metrics` struct<
  `Executor Run Time`: bigint, `Executor CPU Time`: bigint, `Peak Execution Memory`: bigint,
  `Shuffle Read Metrics`: struct<`Remote Bytes Read`: bigint, `Local Bytes Read`: bigint>,
  `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint>>,
`Stage Info` struct<
  `Stage ID`: int, `Number of Tasks`: int, `Submission Time`: bigint, `Completion Time`: bigint>
"""


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).json(path)


def task_metrics(log: DataFrame) -> DataFrame:
    """One row per finished task; times in ms, CPU time in ns."""
    info, metrics = F.col("Task Info"), F.col("Task Metrics")
    read, write = metrics["Shuffle Read Metrics"], metrics["Shuffle Write Metrics"]

    def number(c):
        return F.coalesce(c, F.lit(0).cast("bigint"))

    return log.where(F.col("Event") == "SparkListenerTaskEnd").select(
        info["Task ID"].alias("task_id"),
        F.col("Stage ID").alias("stage_id"),
        (info["Finish Time"] - info["Launch Time"]).alias("duration"),
        (number(read["Remote Bytes Read"]) + number(read["Local Bytes Read"])).alias("shuffle_read_bytes"),
        number(write["Shuffle Bytes Written"]).alias("shuffle_write_bytes"),
        info["Failed"].alias("failed"),
        number(metrics["Peak Execution Memory"]).alias("peak_execution_memory"),
        number(metrics["Executor Run Time"]).alias("run_time"),
        number(metrics["Executor CPU Time"]).alias("cpu_time"),
    )


def stage_metrics(log: DataFrame) -> DataFrame:
    """One row per completed stage; the duration runs from submission to completion."""
    info = F.col("Stage Info")
    return log.where(F.col("Event") == "SparkListenerStageCompleted").select(
        info["Stage ID"].alias("stage_id"),
        info["Number of Tasks"].alias("num_tasks"),
        (info["Completion Time"] - info["Submission Time"]).alias("duration"),
    )


def stage_epochs(log: DataFrame) -> DataFrame:
    """``(stage_id, epoch)`` by the epoch tag of the job that first lists the stage."""
    epoch = F.regexp_extract(F.col("Properties")["spark.job.tags"], r"(?:^|,)epoch-(\d+)(?:,|$)", 1)
    jobs = log.where(F.col("Event") == "SparkListenerJobStart").select(
        F.col("Job ID").alias("job_id"), epoch.try_cast("int").alias("epoch"), F.explode("Stage IDs").alias("stage_id")
    )
    first = jobs.groupBy("stage_id").agg(F.min_by("epoch", "job_id").alias("epoch"))
    return first.where(F.col("epoch").isNotNull())
