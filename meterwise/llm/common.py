"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.session import checkpoint_dir

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; any path Spark's readers can open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """Within it, a setting has ``value``; the caller's comes back afterwards."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_batches(spark: SparkSession, rows: int = 4_000):
    """Within it, Python workers get at most ``rows`` rows at once (whole texts
    and sets are wide)."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def split_size(spark: SparkSession, size: str):
    """Within it, a task reads files up to ``size`` (as Spark writes sizes)."""
    return _setting(spark, "spark.sql.files.maxPartitionBytes", size)


# Paths of the tables written in the scopes that are open now, innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession):
    """A scope for work tables: those written within it are deleted at its end,
    but for those that the yielded ``keep`` was given, which pass to the scope around it.
    Nothing that reads a deleted table may leave the scope unwritten."""
    own: list[str] = []
    kept: list[str] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table.work_path)
        return table

    token = _SCOPES.set((*_SCOPES.get(), own))
    try:
        yield keep
    finally:
        _SCOPES.reset(token)
        for path in own:
            if path not in kept:
                _delete(spark, path)
        if _SCOPES.get():
            _SCOPES.get()[-1].extend(kept)


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete work tables whose last reader is committed, before their scope ends."""
    for table in tables:
        _delete(spark, table.work_path)


@contextmanager
def _shuffles_end(spark: SparkSession):
    """Within it, a write removes its shuffle files when it is committed."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(spark: SparkSession, df: DataFrame, name: str, *by: str, rows: int = 4_000,
            rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends in
    committed files, so a lost executor costs one task, not the whole job.  The
    write's shuffle files go with its end; the table goes with its scope.  ``by``
    names columns whose values get folders of their own.  Python workers get ``rows``
    rows at once; a file gets ``rows_per_file`` (0: any number)."""
    path = work_path(spark, name)
    schema = df.schema
    if _SCOPES.get():
        _SCOPES.get()[-1].append(path)
    with small_batches(spark, rows), _shuffles_end(spark):
        write = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
        (write.partitionBy(*by) if by else write).parquet(path)
    table = spark.read.schema(schema).parquet(path)
    table.work_path = path
    return table


def n_words(text: Column) -> Column:
    """Number of words of a text; null counts as no text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, for expressions
    that use an expensive array inside higher-order functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def as_written(df: DataFrame, *names: str) -> DataFrame:
    """Only the named input columns, so that extra columns cannot clash with
    the names an operator makes."""
    return df.select(*[F.col(f"`{n}`") for n in names])
