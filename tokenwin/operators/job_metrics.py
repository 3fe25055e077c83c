"""Summaries of task tables, gradient values and epochs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenwin.shared import write_shared

# Fixed value: a task is skewed when it takes longer than this many times the average.
SKEW_FACTOR = 2


def duration_stats(tasks: DataFrame, by: list[str] | None = None, value: str = "duration") -> DataFrame:
    """Longest, shortest and average duration; 0 where there are no tasks."""
    return tasks.groupBy(*(by or [])).agg(
        F.coalesce(F.max(value), F.lit(0)).alias("max_task_duration"),
        F.coalesce(F.min(value), F.lit(0)).alias("min_task_duration"),
        F.coalesce(F.avg(value), F.lit(0.0)).alias("avg_task_duration"),
    )


def shuffle_totals(tasks: DataFrame, by: list[str] | None = None) -> DataFrame:
    return tasks.groupBy(*(by or [])).agg(
        F.sum(F.coalesce("shuffle_read_bytes", F.lit(0))).alias("total_shuffle_read_bytes"),
        F.sum(F.coalesce("shuffle_write_bytes", F.lit(0))).alias("total_shuffle_write_bytes"),
    )


def failed_tasks(tasks: DataFrame, by: list[str] | None = None) -> DataFrame:
    return tasks.groupBy(*(by or [])).agg(F.count_if("failed").alias("failed_task_count"))


def skewed_tasks(tasks: DataFrame, by: str | None = None, value: str = "duration") -> DataFrame:
    """Rows above SKEW_FACTOR times the average, of all rows or of their ``by`` group.

    The overall average is a scalar subquery. Averages by group are one row per group, joined by
    equality; the optimizer sees their size after the aggregation.
    """
    if by is None:
        average = tasks.agg(F.avg(value)).scalar()
        return tasks.where(F.col(value) > SKEW_FACTOR * average)
    averages = tasks.groupBy(by).agg(F.avg(value).alias("_average"))
    return tasks.join(averages, by).where(F.col(value) > SKEW_FACTOR * F.col("_average")).drop("_average")


def gradient_stats(values: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Mean, maximum, minimum and sample variance of the absolute values; 0.0 where undefined."""
    size = F.abs(F.col(value).cast("double"))
    zero = F.lit(0.0)
    return values.groupBy(*(by or [])).agg(
        F.coalesce(F.avg(size), zero).alias("mean_magnitude"),
        F.coalesce(F.max(size), zero).alias("max_magnitude"),
        F.coalesce(F.min(size), zero).alias("min_magnitude"),
        F.coalesce(F.var_samp(size), zero).alias("variance"),
    )


def resource_use(tasks: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Largest peak of execution memory, and CPU time (ns) over run time (ms)."""
    ratio = F.try_divide(F.sum("cpu_time") / 1e6, F.sum("run_time"))
    return tasks.groupBy(*(by or [])).agg(
        F.coalesce(F.max("peak_execution_memory"), F.lit(0)).alias("peak_execution_memory"),
        F.coalesce(ratio, F.lit(0.0)).alias("cpu_ratio"),
    )


def tasks_by_epoch(tasks: DataFrame, stage_epochs: DataFrame) -> DataFrame:
    """Scope tasks to epochs by their stage; nothing is reset between epochs."""
    return tasks.join(stage_epochs, "stage_id")


def epoch_metrics(epoch_log: DataFrame, tasks: DataFrame) -> DataFrame:
    """One row per epoch: the training log with the totals of the epoch's tasks.

    An epoch without tasks has totals of 0. Values of the log stay as they are, so the NaN of a run that
    has diverged is seen. Tasks are read once: those of an epoch that took equally long are summed up together,
    and all totals, the average and the skewed tasks follow from these sums.
    """
    n = F.count("*").alias("_n")
    sums = [F.sum(F.coalesce(c, F.lit(0))).alias(f"_{c}") for c in ("shuffle_read_bytes", "shuffle_write_bytes")]
    sums += [F.sum(c).alias(f"_{c}") for c in ("cpu_time", "run_time")]
    most = F.max("peak_execution_memory").alias("_peak")
    alike = write_shared(tasks.groupBy("epoch", "duration").agg(n, *sums, F.count_if("failed").alias("_failed"), most), "durations")
    timed = F.when(F.col("duration").isNotNull(), F.col("_n"))
    average = F.sum(F.col("duration") * F.col("_n")) / F.sum(timed)
    ratio = F.try_divide(F.sum("_cpu_time") / 1e6, F.sum("_run_time"))
    # One row for each epoch.
    totals = alike.groupBy("epoch").agg(
        F.sum("_shuffle_read_bytes").alias("total_shuffle_read_bytes"),
        F.sum("_shuffle_write_bytes").alias("total_shuffle_write_bytes"),
        F.coalesce(F.max("duration"), F.lit(0)).alias("max_task_duration"),
        F.coalesce(F.min("duration"), F.lit(0)).alias("min_task_duration"),
        F.coalesce(average, F.lit(0.0)).alias("avg_task_duration"),
        F.sum("_failed").alias("failed_task_count"),
        F.coalesce(F.max("_peak"), F.lit(0)).alias("peak_execution_memory"),
        F.coalesce(ratio, F.lit(0.0)).alias("cpu_ratio"),
    )
    slow = F.col("duration") > SKEW_FACTOR * F.col("avg_task_duration")
    skewed = alike.join(totals.select("epoch", "avg_task_duration"), "epoch").where(slow)
    skewed = skewed.groupBy("epoch").agg(F.sum("_n").alias("skewed_task_count"))
    row = epoch_log.join(totals, "epoch", "left").join(skewed, "epoch", "left")
    return row.na.fill(0, subset=[*totals.columns[1:], "skewed_task_count"]).orderBy("epoch")
