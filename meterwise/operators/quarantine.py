"""Quarantine of rejected rows and replay after a rule change (F8, V4).

One pass over Raw writes every row: kept rows as they are cleaned, rejected rows
as they came, with the names of the rules they failed.  Both stand in one table
under ``status=kept`` and ``status=rejected``, so kept + quarantined rows are the
Raw rows of each load.  When rules are loosened, only the rejected rows are
read again: those that now pass are cleaned and added, the others get their new list of
rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.operators.clean import (DEFAULT_MAX_MINUTES, VariantSpec, get_variant, project, rules, with_features)
from meterwise.sources.writers import write_partitioned

LOAD = ("src_year", "src_month")
KEPT, REJECTED = "kept", "rejected"


def failed_rules(spec: VariantSpec, max_minutes: float = DEFAULT_MAX_MINUTES) -> Column:
    """Names of the rules a row fails; a null result fails, as in the filter."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n))
                                     for n, r in rules(spec, max_minutes)]))


def split_rows(raw: DataFrame, variant: str | VariantSpec = "yellow", money_mode: str = "double",
               max_minutes: float = DEFAULT_MAX_MINUTES, keep: Sequence[str] = LOAD) -> DataFrame:
    """Every row of ``raw`` with status and failed rules: ``cleaned`` holds a kept
    row's output columns, ``raw`` a rejected row's input columns."""
    spec = variant if isinstance(variant, VariantSpec) else get_variant(variant)
    source = F.struct(*[F.col(f"`{c}`") for c in raw.columns if c not in keep])
    rows = with_features(raw.withColumn("_raw", source), spec).withColumn("_failed", failed_rules(spec, max_minutes))
    ok = F.size("_failed") == 0
    return rows.select(
        F.when(ok, F.struct(*project(spec, money_mode, load_ts=False))).alias("cleaned"),
        F.when(~ok, F.col("_raw")).alias("raw"), F.col("_failed").alias("failed"),
        F.when(ok, KEPT).otherwise(REJECTED).alias("status"), *keep)


def write_split(split: DataFrame, path: str, mode: str = "static", keep: Sequence[str] = LOAD) -> None:
    """One write of kept and rejected rows, by status and load; rows stay with the
    task that read them."""
    write_partitioned(split, path, ("status", *keep), mode=mode, cluster=False)


def kept_rows(spark: SparkSession, path: str, keep: Sequence[str] = LOAD) -> DataFrame:
    """The cleaned rows of a split table (reads the kept folders only)."""
    return spark.read.parquet(path).where(F.col("status") == KEPT).select("cleaned.*", *keep)


def rejected_rows(spark: SparkSession, path: str, keep: Sequence[str] = LOAD) -> DataFrame:
    """The quarantined Raw rows and the rules they failed."""
    return spark.read.parquet(path).where(F.col("status") == REJECTED).select("raw.*", "failed", *keep)


def replay(spark: SparkSession, path: str, out_path: str, variant: str | VariantSpec = "yellow",
           money_mode: str = "double", max_minutes: float = DEFAULT_MAX_MINUTES, keep: Sequence[str] = LOAD) -> None:
    """Put the rejected rows through changed rules, writing the split of these rows
    to ``out_path``.  Only quarantined folders are read.  With loosened rules, the kept rows of
    ``path`` and of ``out_path`` together are what a full rerun keeps, and the rejected rows of
    ``out_path`` are what it rejects; rows that passed stay, so tightened rules need a full rerun."""
    again = rejected_rows(spark, path, keep).drop("failed")
    write_split(split_rows(again, variant, money_mode, max_minutes, keep), out_path, keep=keep)
