"""Equivalence by partition digests (V8).

A digest of a partition is order-independent: the number of rows, the sum and the
exclusive-or of 64-bit hashes of whole rows.  Digests are computed in one
aggregation, are one small row per partition and can be kept with the run log
(:func:`save_digests`).  Two tables are compared by their digests; rows are compared only in
partitions whose digests differ, so an unchanged partition is not read again.

Equal digests of different rows would take a collision of both 64-bit
figures; rows of differing partitions are compared exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.operators.quality import equivalence

FIGURES = ("rows", "hash_sum", "hash_xor")


def partition_digests(df: DataFrame, parts: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``parts``, rows, hash_sum, hash_xor.  ``columns`` (default all others)
    are hashed in the given order, each with whether it is null, so that a value that moves
    from a null column to its neighbour changes the digest."""
    names = list(columns) if columns is not None else [c for c in df.columns if c not in parts]
    cells = [c for n in names for c in (F.col(f"`{n}`").isNull(), F.col(f"`{n}`"))]
    row = F.xxhash64(*cells) if cells else F.lit(0).cast("long")
    return df.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows"),
                                  F.sum(row.cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
                                  F.bit_xor(row).alias("hash_xor"))


def save_digests(spark: SparkSession, path: str, run_id: str, layer: str, digests: DataFrame) -> None:
    """Keep a run's digests of a layer beside the run log; a rerun of the same
    run replaces its own."""
    if not run_id.replace("-", "").isalnum() or not layer.replace("_", "").isalnum():
        raise ValueError(f"bad run or layer name {run_id!r}, {layer!r}")
    digests.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}/layer={layer}")


def differing_partitions(a: DataFrame, b: DataFrame, parts: Sequence[str]) -> DataFrame:
    """``parts`` of the partitions whose digests differ or that one side lacks."""
    tagged = a.select(*parts, *FIGURES, F.lit(1).alias("side")).unionByName(
        b.select(*parts, *FIGURES, F.lit(2).alias("side")))
    same = tagged.groupBy(*parts, *FIGURES).agg(F.count(F.lit(1)).alias("n"))
    return same.where("n = 1").select(*parts).distinct()


def equivalence_by_digests(a: DataFrame, b: DataFrame, parts: Sequence[str], digests_a: DataFrame | None = None,
                           digests_b: DataFrame | None = None, most_listed: int = 1_000) -> DataFrame:
    """V8 as :func:`quality.equivalence`, one row (partitions, differing, left_only,
    right_only), reading only partitions whose digests differ.

    Kept digests may be passed.  Up to ``most_listed`` differing partitions become
    a predicate on partition columns, which prunes folders; more are joined."""
    da = digests_a if digests_a is not None else partition_digests(a, parts, b_columns(a, parts))
    db = digests_b if digests_b is not None else partition_digests(b, parts, b_columns(a, parts))
    total = da.select(*parts).union(db.select(*parts)).distinct().count()
    differ = differing_partitions(da, db, parts)
    found = differ.limit(most_listed + 1).collect()
    names = [*parts, *b_columns(a, parts)]
    if len(found) > most_listed:
        null_safe = lambda df: df.select(*names).join(
            differ.select(*[F.col(p).alias(f"_{p}") for p in parts]),
            reduce(lambda x, y: x & y, [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in parts]), "left_semi")
        left, right = null_safe(a), null_safe(b)
        n = differ.count()
    else:
        inside = F.lit(False)
        for r in found:
            inside |= reduce(lambda x, y: x & y, [
                F.col(p).isNull() if r[p] is None else F.col(p) == F.lit(r[p]) for p in parts])
        left, right = a.select(*names).where(inside), b.select(*names).where(inside)
        n = len(found)
    return equivalence(left, right).select(
        F.lit(total).cast("long").alias("partitions"), F.lit(n).cast("long").alias("differing"),
        F.col("rows_a").alias("compared_a"), F.col("rows_b").alias("compared_b"), "left_only", "right_only")


def b_columns(a: DataFrame, parts: Sequence[str]) -> list[str]:
    """The columns compared: those of the first table, in its order."""
    return [c for c in a.columns if c not in parts]
