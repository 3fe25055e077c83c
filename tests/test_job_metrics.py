import math
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F
from rules import ROOT

from tokenwin.operators import job_metrics
from tokenwin.plans import queries
from tokenwin.operators.training import EPOCH_LOG
from tokenwin.sources import event_log
from tokenwin.sources.epoch_table import RECORDED_SCHEMA, read_epoch_metrics, summarize_recorded, write_epoch_metrics

TASKS = [
    (1, 0, 10, 100, 5, False, 1), (2, 0, 12, None, 5, True, 1), (3, 1, 11, 50, None, False, 1),
    (4, 1, 90, 1, 1, False, 1), (5, 2, 7, 0, 0, False, 2),
]


@pytest.fixture
def tasks(spark):
    columns = "task_id long, stage_id int, duration long, shuffle_read_bytes long, shuffle_write_bytes long, failed boolean, epoch int"
    df = spark.createDataFrame(TASKS, columns)
    resources = (("peak_execution_memory", 8), ("run_time", 4), ("cpu_time", 2_000_000))
    return df.withColumns({name: F.lit(value).cast("long") for name, value in resources})


def test_totals(tasks):
    assert job_metrics.shuffle_totals(tasks).first()[:] == (151, 11)
    assert job_metrics.failed_tasks(tasks).first()[0] == 1
    assert job_metrics.duration_stats(tasks).first()[:] == (90, 7, 26.0)
    assert job_metrics.duration_stats(tasks.limit(0)).first()[:] == (0, 0, 0.0)
    assert job_metrics.resource_use(tasks).first()[:] == (8, 0.5)


def test_skewed_tasks(tasks):
    assert [r["task_id"] for r in job_metrics.skewed_tasks(tasks).collect()] == [4]
    assert [r["task_id"] for r in job_metrics.skewed_tasks(tasks, "epoch").collect()] == [4]
    exactly_twice = tasks.where("task_id = 1").union(tasks.where("task_id = 1"))
    assert job_metrics.skewed_tasks(exactly_twice).count() == 0


def test_gradient_stats(spark):
    df = spark.createDataFrame([(-3.0,), (1.0,), (2.0,)], "g double")
    assert job_metrics.gradient_stats(df, "g").first()[:] == (2.0, 3.0, 1.0, 1.0)
    assert job_metrics.gradient_stats(df.limit(1), "g").first()[:] == (3.0, 3.0, 3.0, 0.0)
    assert job_metrics.gradient_stats(df.limit(0), "g").first()[:] == (0.0, 0.0, 0.0, 0.0)


def test_epoch_rows(spark, tasks):
    log = spark.createDataFrame([(e, 100 * e, 0.5, 0.1, 0.0, 1.0, 2.0, 0.0, 0.5, 0.001) for e in (1, 2, 3)], EPOCH_LOG)
    rows = job_metrics.epoch_metrics(log, tasks).collect()
    assert len(rows[0]) == 19
    first = rows[0].asDict()
    assert (first["total_shuffle_read_bytes"], first["failed_task_count"], first["max_task_duration"]) == (151, 1, 90)
    assert rows[1]["avg_task_duration"] == 7.0
    assert rows[2]["max_task_duration"] == 0 and rows[2]["duration_ms"] == 300
    for row in rows:
        average = tasks.where(F.col("epoch") == row["epoch"]).agg(F.avg("duration")).first()[0]
        slow = tasks.where((F.col("epoch") == row["epoch"]) & (F.col("duration") > 2 * F.lit(average))).count()
        assert row["skewed_task_count"] == slow


def test_a_diverged_run_keeps_its_nan(spark, tasks):
    nan = float("nan")
    log = spark.createDataFrame([(9, 100, nan, 0.1, 0.0, 1.0, 2.0, 0.0, 0.5, nan)], EPOCH_LOG)
    row = job_metrics.epoch_metrics(log, tasks).first()
    assert math.isnan(row["training_loss"]) and math.isnan(row["learning_rate"]) and row["failed_task_count"] == 0


def test_tasks_are_read_once_for_all_totals(spark, tasks):
    log = spark.createDataFrame([(e, 100, 0.5, 0.1, 0.0, 1.0, 2.0, 0.0, 0.5, 0.001) for e in (1, 2, 3)], EPOCH_LOG)
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = job_metrics.epoch_metrics(log, tasks.mapInArrow(count, tasks.schema)).collect()
    assert len(rows) == 3 and read.value == len(TASKS)


def test_written_event_log_is_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "LOG_ROWS", 10)
    monkeypatch.setattr(queries, "new_path", lambda _, label: str(tmp_path / label))
    log = queries._event_log(spark.range(25).coalesce(1), "SparkListenerJobStart", Job_ID=F.col("id"))
    assert sorted(r["Job ID"] for r in log.collect()) == list(range(25))
    names = [p.name for p in (tmp_path / "event-log").glob("part-*")]
    assert len(names) == 3 and all(n.endswith(".gz") for n in names)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_epoch_table_appends(spark, tmp_path, fmt):
    path = str(tmp_path / "epochs")
    log = spark.createDataFrame([(1, 5, 0.5, 0.1, 0.0, 1.0, 2.0, 0.0, 0.5, 0.001)], EPOCH_LOG)
    write_epoch_metrics(log, path, fmt)
    write_epoch_metrics(log.withColumn("epoch", F.lit(2)), path, fmt)
    rows = read_epoch_metrics(spark, path, EPOCH_LOG, fmt).orderBy("epoch").collect()
    assert [r["epoch"] for r in rows] == [1, 2]
    assert rows[0][:] == log.first()[:]


def test_recorded_csv(spark, tmp_path):
    names = [part.split()[0] for part in RECORDED_SCHEMA.split(",")]
    assert len(names) == 21
    lines = [
        "1,1500,0.2,0.0,0.0,0.0,0.0,0.0,0.0,0.001,300,700,3500,1000,1000,350,0,90.5,0,8.0,-1.0",
        "2,900,0.1,0.2,0.0,0.0,0.0,0.0,0.0,0.001,170,760,3500,1000,1000,170,1,16.25,1,8.0,-1.0",
    ]
    (tmp_path / "metrics.csv").write_text("\n".join([",".join(names), *lines]) + "\n")
    metrics = read_epoch_metrics(spark, str(tmp_path / "metrics.csv"), RECORDED_SCHEMA, "csv")
    summary = summarize_recorded(metrics).first()
    assert summary["epochs"] == 2 and summary["total_ms"] == 2400 and summary["mean_ms"] == 1200.0
    assert (summary["first_loss"], summary["last_loss"], summary["best_training_accuracy"]) == (0.2, 0.1, 0.2)
    assert summary["failed_tasks"] == 1


JOB = """
import sys
import numpy as np
from pyspark.sql import SparkSession
from tokenwin.operators.training import TrainConfig, train
from tokenwin.shared import ship_package
ship_package()
folder = sys.argv[1]
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "3").config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.dir", f"file://{folder}/log").config("spark.checkpoint.dir", f"{folder}/shared")
    .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").getOrCreate()
)
rng = np.random.default_rng(1)
vectors = rng.normal(size=(5, 4)).astype(np.float32).astype(float)
rows = [(0, k, rng.normal(size=8).tolist(), vectors[k % 5].tolist()) for k in range(60)]
examples = spark.createDataFrame(rows, "seq_id long, k long, features array<double>, label array<float>")
emb = spark.createDataFrame([(i + 1, v.tolist()) for i, v in enumerate(vectors)], "idx long, vec array<float>")
names = spark.createDataFrame([(10 * i, i + 1) for i in range(5)], "token long, idx long")
_, log = train(examples, emb, names, TrainConfig(hidden=3, epochs=2, workers=2))
log.write.parquet(f"{folder}/epochs")
spark.stop()
"""


def test_training_run_to_epoch_rows(spark, tmp_path):
    """A finished run's event log gives task, stage and epoch tables, and the full epoch rows."""
    (tmp_path / "log").mkdir()
    script = tmp_path / "job.py"
    script.write_text(textwrap.dedent(JOB))
    env = {**os.environ, "PYTHONPATH": str(ROOT)}
    command = [sys.executable, str(script), str(tmp_path)]
    subprocess.run(command, check=True, env=env, timeout=300, capture_output=True)
    log = event_log.read_event_log(spark, str(tmp_path / "log"))
    tasks, stages, epochs = event_log.task_metrics(log), event_log.stage_metrics(log), event_log.stage_epochs(log)
    assert {r["epoch"] for r in epochs.collect()} == {1, 2}
    per_stage = {r["stage_id"]: r["count"] for r in tasks.groupBy("stage_id").count().collect()}
    done = {r["stage_id"]: r for r in stages.collect()}
    assert per_stage == {stage: r["num_tasks"] for stage, r in done.items()}
    assert all(0 <= r["duration"] < 60_000 for r in done.values())
    assert tasks.where("duration < 0 or failed").count() == 0
    scoped = job_metrics.tasks_by_epoch(tasks, epochs)
    assert 0 < scoped.count() < tasks.count()
    recorded = read_epoch_metrics(spark, str(tmp_path / "epochs"), EPOCH_LOG)
    rows = job_metrics.epoch_metrics(recorded, scoped).collect()
    assert [r["epoch"] for r in rows] == [1, 2] and len(rows[0]) == 19
    for r in rows:
        assert r["total_shuffle_read_bytes"] > 0 and r["total_shuffle_write_bytes"] > 0
        assert 0 <= r["min_task_duration"] <= r["avg_task_duration"] <= r["max_task_duration"] <= r["duration_ms"] + 60_000
        assert r["failed_task_count"] == 0 and r["cpu_ratio"] > 0
