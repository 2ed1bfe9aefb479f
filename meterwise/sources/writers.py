"""Partitioned sinks, overwrite modes, compaction and the run log.

Findings that shape this module:

* G3 - dynamic overwrite replaces every partition the frame *touches*, so a
  stray January row inside the February file wipes January.  Layers fed from
  monthly files are therefore partitioned by the *source* month
  (``src_year``/``src_month``), a value of the load, not of the data.
* G4 - dynamic overwrite never removes a partition that stops being
  produced; a full rebuild must be asked for explicitly (``mode="static"``).
* G9 - the writer sorts by the partition columns whether or not the plan
  shows it; clustering rows by partition (plus a salt for big partitions)
  before the write keeps each task writing few files and the sort cheap.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (LongType, StringType, StructField, StructType,
                               TimestampType)


def cluster_for_write(df: DataFrame, partition_cols: Sequence[str], files_per_partition: int | None = None,
                      salt_cols: Sequence[str] | None = None) -> DataFrame:
    """Cluster rows by output partition before the write.

    Default (``files_per_partition=None``): a ``rebalance`` hint on the
    partition columns.  AQE then sizes the write tasks from the measured
    shuffle (``spark.sql.adaptive.advisoryPartitionSizeInBytes``): a month
    holding a third of the data is split over many tasks and files, small
    months are coalesced, so neither one giant task nor thousands of tiny
    files appear.

    ``files_per_partition=k`` pins the layout instead (compaction): rows go to
    ``(partition, pmod(xxhash64(salt_cols), k))``; the salt is a function of
    row content, so a retried task writes the same rows.
    """
    if not partition_cols:
        return df
    if files_per_partition is None:
        if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            return df.hint("rebalance", *partition_cols)
        # The hint needs adaptive execution; without it, cluster by the
        # partition and a row hash, so that a big month still has many tasks.
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in (salt_cols or df.columns)]), F.lit(8))
        return df.repartition(*[F.col(c) for c in partition_cols], spread)
    keys = [F.col(c) for c in partition_cols]
    if files_per_partition > 1:
        salt_src = [F.col(c) for c in (salt_cols or df.columns)]
        keys.append(F.pmod(F.xxhash64(*salt_src), F.lit(files_per_partition)))
    return df.repartition(*keys)


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] = ("year", "month"),
                      mode: str = "dynamic", files_per_partition: int | None = None,
                      max_records_per_file: int | None = None, cluster: bool = True,
                      fmt: str = "parquet") -> None:
    """Overwrite a partitioned table.

    ``mode="dynamic"`` replaces only the partitions present in ``df``;
    ``mode="static"`` replaces the whole table; ``mode="append"`` appends.
    The overwrite mode is a per-write option, not a session setting, so one
    layer's choice cannot leak into another's.
    """
    if mode not in {"dynamic", "static", "append"}:
        raise ValueError(f"unknown mode {mode!r}")
    out = cluster_for_write(df, partition_cols, files_per_partition) if cluster else df
    w = out.write.format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if mode == "append":
        w.mode("append").save(path)
    else:
        w.mode("overwrite").option("partitionOverwriteMode", mode).save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Unpartitioned overwrite (dimensions)."""
    df.write.format(fmt).mode("overwrite").save(path)


def with_source_month(df: DataFrame, year: int, month: int) -> DataFrame:
    """Tag every row with the month of the file it was loaded from."""
    return df.withColumns({"src_year": F.lit(int(year)), "src_month": F.lit(int(month))})


def load_path(path: str, year: int, month: int) -> str:
    """Folder of one load, in Spark's own (unpadded) partition naming."""
    return f"{path.rstrip('/')}/src_year={int(year)}/src_month={int(month)}"


def save_month(df: DataFrame, path: str, year: int, month: int,
               files_per_partition: int | None = None) -> None:
    """Write one monthly load under ``src_year=Y/src_month=M``.

    Rows whose own timestamp falls in another month stay with the load that
    brought them, so rerunning February can never touch January.  The load's
    folder is overwritten as a whole (explicit path), so a rerun whose output
    is empty also replaces the old rows - dynamic overwrite would keep them
    because it only replaces partitions that receive rows (G4).  A load is
    copied task by task, without a shuffle, unless ``files_per_partition``
    asks for a layout.
    """
    out = df.drop("src_year", "src_month")
    if files_per_partition is not None:
        out = out.repartition(files_per_partition)
    out.write.mode("overwrite").parquet(load_path(path, year, month))


def save_by_data_month(df: DataFrame, path: str, ts_col: str, mode: str = "dynamic") -> None:
    """W1 (reference behaviour): partition by the month of ``ts_col``.

    Kept for compatibility; unsafe with dynamic overwrite when a file holds
    rows of other months (G3) - prefer :func:`save_month`.
    """
    out = df.withColumns({"year": F.year(ts_col), "month": F.month(ts_col)})
    write_partitioned(out, path, ("year", "month"), mode=mode)


def partition_counts(spark: SparkSession, path: str, year_col: str = "year",
                     month_col: str = "month") -> DataFrame:
    """Rows per partition of a written table (post-write check for G3/G4)."""
    return (spark.read.parquet(path).groupBy(year_col, month_col)
            .agg(F.count(F.lit(1)).alias("rows")))


def compact(spark: SparkSession, path: str, out_path: str, partition_cols: Sequence[str] = ("year", "month"),
            files_per_partition: int | None = 1) -> None:
    """Rewrite a table with ``files_per_partition`` files per partition.

    Writes to a new location (the shared storage is not rewritten in place);
    callers swap the location or register it in the catalog.
    """
    df = spark.read.parquet(path)
    write_partitioned(df, out_path, partition_cols, mode="static",
                      files_per_partition=files_per_partition)


RUN_LOG_SCHEMA = StructType([
    StructField("run_id", StringType(), False),
    StructField("layer", StringType(), False),
    StructField("months", StringType(), True),
    StructField("rows_in", LongType(), True),
    StructField("rows_out", LongType(), True),
    StructField("status", StringType(), False),
    StructField("detail", StringType(), True),
    StructField("logged_at", TimestampType(), False),
])


def run_log_row(run_id: str, layer: str, months, rows_in: int | None, rows_out: int | None,
                status: str, detail: dict | None = None) -> tuple:
    """One run-log record as a tuple of :data:`RUN_LOG_SCHEMA`."""
    months_s = ",".join(f"{y:04d}-{m:02d}" for y, m in sorted(months or []))
    return (run_id, layer, months_s, rows_in, rows_out, status,
            json.dumps(detail or {}, sort_keys=True), _dt.datetime.now())


def run_log_record(spark: SparkSession, run_id: str, layer: str, months, rows_in: int | None,
                   rows_out: int | None, status: str, detail: dict | None = None) -> DataFrame:
    """A one-row run-log DataFrame."""
    return spark.createDataFrame([run_log_row(run_id, layer, months, rows_in, rows_out, status, detail)],
                                 RUN_LOG_SCHEMA)


def append_run_log(spark: SparkSession, path: str, record: DataFrame) -> None:
    """Append the record to the run-log table (one small file)."""
    record.coalesce(1).write.mode("append").parquet(path)
