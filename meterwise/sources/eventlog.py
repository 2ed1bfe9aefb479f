"""Stage and task figures of a run from Spark's event log.

The log that Spark writes (``spark.eventLog.dir``) is read as a table after or
during the application: no server is asked.  Task figures are aggregated per
stage and attempt; the ratio of the longest to the median task, and of the
largest to the median task's rows, show skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields that are used, of the JSON events.
EVENT = """Event string, `Stage ID` long, `Stage Attempt ID` long,
  `Task End Reason` struct<Reason: string>,
  `Task Info` struct<`Task ID`: long, `Launch Time`: long, `Finish Time`: long, Failed: boolean>,
  `Task Metrics` struct<`Executor Run Time`: long, `Executor CPU Time`: long, `JVM GC Time`: long,
    `Memory Bytes Spilled`: long, `Disk Bytes Spilled`: long,
    `Input Metrics`: struct<`Bytes Read`: long, `Records Read`: long>,
    `Shuffle Read Metrics`: struct<`Remote Bytes Read`: long, `Local Bytes Read`: long, `Total Records Read`: long>,
    `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: long, `Shuffle Records Written`: long>>,
  `Stage Info` struct<`Stage ID`: long, `Stage Attempt ID`: long, `Stage Name`: string>"""


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The events of one log, of a folder of logs or of a glob of them."""
    return spark.read.schema(EVENT).json(path)


def task_figures(events: DataFrame) -> DataFrame:
    """One row per ended task."""
    m = "`Task Metrics`"
    read = f"{m}.`Shuffle Read Metrics`"
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return events.where("Event = 'SparkListenerTaskEnd'").select(
        F.col("`Stage ID`").alias("stage"), F.col("`Stage Attempt ID`").alias("attempt"),
        F.col("`Task Info`.`Task ID`").alias("task"), (F.col("`Task End Reason`.Reason") == "Success").alias("ok"),
        zero(f"{m}.`Executor Run Time`").alias("run_ms"), zero(f"{m}.`JVM GC Time`").alias("gc_ms"),
        (zero(f"{m}.`Executor CPU Time`") / 1e6).alias("cpu_ms"),
        zero(f"{m}.`Disk Bytes Spilled`").alias("disk_spilled"), zero(f"{m}.`Memory Bytes Spilled`").alias("memory_spilled"),
        (zero(f"{m}.`Input Metrics`.`Records Read`") + zero(f"{read}.`Total Records Read`")).alias("rows_read"),
        (zero(f"{m}.`Input Metrics`.`Bytes Read`") + zero(f"{read}.`Remote Bytes Read`")
         + zero(f"{read}.`Local Bytes Read`")).alias("bytes_read"),
        zero(f"{m}.`Shuffle Write Metrics`.`Shuffle Bytes Written`").alias("shuffle_written"))


def stage_figures(events: DataFrame) -> DataFrame:
    """One row per stage attempt: tasks, time, spill, GC and skew ratios."""
    names = events.where("Event = 'SparkListenerStageCompleted'").select(
        F.col("`Stage Info`.`Stage ID`").alias("stage"), F.col("`Stage Info`.`Stage Attempt ID`").alias("attempt"),
        F.col("`Stage Info`.`Stage Name`").alias("name"))
    # Tasks of one stage: a few numbers each, ranked by a mergeable sketch.
    per_stage = task_figures(events).groupBy("stage", "attempt").agg(
        F.count(F.lit(1)).alias("tasks"), F.count_if(~F.col("ok")).alias("failed_tasks"),
        *[F.sum(c).alias(c) for c in ("run_ms", "gc_ms", "cpu_ms", "disk_spilled", "memory_spilled", "rows_read",
                                      "bytes_read", "shuffle_written")],
        F.max("run_ms").alias("max_run_ms"), F.percentile_approx("run_ms", 0.5).alias("median_run_ms"),
        F.max("rows_read").alias("max_rows"), F.percentile_approx("rows_read", 0.5).alias("median_rows"))
    out = per_stage.withColumns({
        "time_skew": F.col("max_run_ms") / F.greatest(F.lit(1), F.col("median_run_ms")),
        "row_skew": F.col("max_rows") / F.greatest(F.lit(1), F.col("median_rows"))})
    return out.join(names, ["stage", "attempt"], "left")


def run_figures(events: DataFrame) -> DataFrame:
    """One row for the whole log, in the run log's manner."""
    return stage_figures(events).agg(
        F.count(F.lit(1)).alias("stages"), F.sum("tasks").alias("tasks"), F.sum("failed_tasks").alias("failed_tasks"),
        *[F.sum(c).alias(c) for c in ("run_ms", "gc_ms", "cpu_ms", "disk_spilled", "shuffle_written")],
        F.max("time_skew").alias("worst_time_skew"), F.max("row_skew").alias("worst_row_skew"))
