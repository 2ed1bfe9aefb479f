"""Key-skew measurement and skew-proof aggregation.

The design notes ask for the share of rows per key, the max / median / p95
rows per key and rows per partition.  All of them are aggregations; nothing
is collected to the driver except the final handful of numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_distribution(df: DataFrame, key: str) -> DataFrame:
    """Rows and share of all rows per key value.

    The total is summed from the per-key counts (the same shuffle, reused),
    and attached as a one-row broadcast: no second scan of ``df`` and no
    window over the whole table.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = per_key.agg(F.sum("rows").alias("_total")).withColumn("_j", F.lit(1))
    return (per_key.withColumn("_j", F.lit(1))
            .join(F.broadcast(total), "_j")
            .select(key, "rows", (F.col("rows").cast("double") / F.col("_total").cast("double")).alias("share")))


def skew_summary(df: DataFrame, key: str) -> DataFrame:
    """One row: keys, rows, max / p50 / p95 rows per key, max share and the
    max-to-median ratio (a ratio far above 1 flags a hot key)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum("rows").alias("total_rows"),
        F.max("rows").alias("max_rows"),
        F.percentile_approx("rows", 0.5).alias("p50_rows"),
        F.percentile_approx("rows", 0.95).alias("p95_rows"),
    ).withColumns({
        "max_share": F.col("max_rows").cast("double") / F.col("total_rows").cast("double"),
        "max_to_median": F.col("max_rows").cast("double") / F.col("p50_rows").cast("double"),
    })


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per physical partition of ``df`` as planned."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def hot_keys(df: DataFrame, key: str, min_share: float = 0.05) -> DataFrame:
    """Keys holding at least ``min_share`` of the rows (bounded by 1/min_share
    rows, so the result may be broadcast)."""
    return key_distribution(df, key).where(F.col("share") >= min_share).select(key, "rows", "share")


def salted_aggregate(df: DataFrame, keys: Sequence[str], sums: Sequence[str], salt_buckets: int = 32,
                     salt_cols: Sequence[str] | None = None) -> DataFrame:
    """Two-phase aggregation with a salt.

    Phase 1 groups by ``keys + salt`` so a hot key's rows spread over
    ``salt_buckets`` reducers; phase 2 re-aggregates the (at most
    ``salt_buckets`` per key) partial rows.  The salt is a hash of row
    content, so a retried task salts identically.  Only algebraic
    aggregates (count, sum) are offered: they merge exactly.
    """
    src = [F.col(c) for c in (salt_cols or df.columns)]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*src), F.lit(salt_buckets)))
    p1 = salted.groupBy(*keys, "_salt").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in sums])
    return p1.groupBy(*keys).agg(F.sum("_n").alias("rows"),
                                 *[F.sum(f"_s_{c}").alias(f"sum_{c}") for c in sums])
