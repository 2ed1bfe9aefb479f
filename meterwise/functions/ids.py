"""Deterministic row ids (P15, finding G6): stable content ids for the Fact
(:func:`content_ids`) and dense ordinals per month (:func:`assign_row_ids`).

``monotonically_increasing_id`` depends on the partition layout, so the same
month gets different ids on every run (and may even differ between two actions
of one run under AQE).  A plain 64-bit content hash is repeatable but not
unique: identical trips collide by construction and, at ~10^11 rows, distinct
trips collide too (birthday bound).

:func:`assign_row_ids` gives every row of a scope (a month) a dense ordinal by
content order, computed without ever sending a large group to one task:

1. ``groupBy(scope, identity).count()`` collapses identical rows map-side
   (partial aggregation), so a duplicate row holding a third of the data
   crosses the shuffle as one row per input partition.
2. Each distinct row is cut into chunk rows of at most ``chunk`` copies
   (``explode(sequence(0, n - 1, chunk))``; one chunk for ordinary rows).
3. ``bucket = pmod(xxhash64(scope, identity, chunk_start), B)`` spreads the
   chunk rows evenly, *including* the chunks of one hot row.  A running sum
   of chunk sizes over ``Window.partitionBy(scope, bucket)`` ordered by the
   identity columns gives each chunk its start inside the bucket; per-bucket
   totals (``scope x B`` rows, a proven bound) give the bucket offsets.
4. Rows are regenerated with ``explode(sequence(0, size - 1))`` per chunk,
   so no task ever generates more than ``chunk`` copies of one row.

Ids are ``scope_key << 40 | ordinal``: dense inside a month, disjoint across
months, and identical on every run over the same input multiset (identical
rows are interchangeable, so which copy gets which ordinal is immaterial).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ORDINAL_BITS = 40  # up to ~1.1e12 rows per scope


def _scope_key(scope_cols: Sequence[str]):
    if not scope_cols:
        return F.lit(0).cast("long")
    if list(scope_cols) == ["pickup_year", "pickup_month"]:
        return (F.coalesce(F.col("pickup_year"), F.lit(0)).cast("long") * 12
                + F.coalesce(F.col("pickup_month"), F.lit(1)).cast("long") - 1)
    return F.pmod(F.xxhash64(*[F.col(c) for c in scope_cols]), F.lit(1 << 22))


def content_ids(df: DataFrame, identity_cols: Sequence[str], id_col: str = "trip_id",
                chunk: int = 100_000) -> DataFrame:
    """Identity columns plus a 128-bit id of the row's content and copy number.

    An id depends on nothing but its own row and how many equal rows come
    before it, so a later load never changes the id of a row already there.
    Ids are 32 hex digits (two 64-bit hashes; at 10^12 rows the chance of any
    collision is about 10^-15).  Nulls enter the hash through a null mask.

    One wide shuffle: equal rows collapse map-side, so a row repeated in a
    third of all data crosses it once per input task.  Rows with more than
    ``chunk`` copies are cut into chunks and spread over tasks again before
    their copies are made; that second shuffle carries one row per chunk.
    """
    cols = [F.col(c) for c in identity_cols]
    grouped = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    few = grouped.where(F.col("_n") <= chunk).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    many = (grouped.where(F.col("_n") > chunk)
            .withColumn("_c0", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1,
                                                    F.lit(chunk).cast("long"))))
            .repartition(*cols, "_c0")
            .withColumn("_copy", F.explode(F.sequence(
                F.col("_c0"), F.least(F.col("_c0") + chunk, F.col("_n")) - 1))).drop("_c0"))
    rows = few.unionByName(many)
    mask = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    halves = [F.lpad(F.lower(F.hex(F.xxhash64(F.lit(seed), mask, "_copy", *cols))), 16, "0") for seed in (1, 2)]
    return rows.withColumn(id_col, F.concat(*halves)).select(*cols, id_col)


def assign_row_ids(df: DataFrame, identity_cols: Sequence[str],
                   scope_cols: Sequence[str] = ("pickup_year", "pickup_month"),
                   id_col: str = "trip_id", buckets: int = 1024,
                   chunk: int = 100_000) -> DataFrame:
    """Return ``df`` (restricted to scope + identity columns) with ``id_col``.

    Row multiplicity is preserved exactly.  Columns not in ``identity_cols``
    or ``scope_cols`` are dropped: re-derive them afterwards (load timestamps
    and other non-identity columns must not influence the id anyway).

    With the default month scope the high bits are ``year * 12 + month - 1``,
    so ids are unique across months.  Any other scope is hashed into 22 bits:
    ids are then unique within a scope, and across scopes only as far as
    those hashes differ.
    """
    scope_cols = list(scope_cols)
    ident = [c for c in identity_cols if c not in scope_cols]
    keys = scope_cols + ident

    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    chunks = (grouped
              .withColumn("_c0", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1,
                                                      F.lit(chunk).cast("long"))))
              .withColumn("_m", F.least(F.lit(chunk).cast("long"), F.col("_n") - F.col("_c0")))
              .withColumn("_bkt", F.pmod(F.xxhash64(*[F.col(c) for c in keys], F.col("_c0")),
                                         F.lit(buckets))))

    # Offsets per (scope, bucket): a table of at most |scope| x B rows.
    per_bucket = chunks.groupBy(*scope_cols, "_bkt").agg(F.sum("_m").alias("_bn"))
    wb = (Window.partitionBy(*scope_cols).orderBy("_bkt")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = per_bucket.select(*scope_cols, "_bkt",
                                (F.sum("_bn").over(wb) - F.col("_bn")).alias("_boff"))

    # A 64-bit content hash leads the sort key: the sorter's prefix
    # comparison settles almost every pair without touching the wide key.
    order = ([F.xxhash64(*[F.col(c) for c in ident])]
             + [F.col(c).asc_nulls_first() for c in ident] + [F.col("_c0")])
    w = (Window.partitionBy(*scope_cols, "_bkt").orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    positioned = chunks.withColumn("_start", F.sum("_m").over(w) - F.col("_m"))

    # No hint: the offsets side is |scope| x B rows; AQE measures it at
    # run time and broadcasts it when it is under the broadcast threshold,
    # otherwise the join reuses the window's (scope, bucket) partitioning.
    based = (positioned.join(offsets, on=[*scope_cols, "_bkt"], how="inner")
             .withColumn("_base", F.shiftleft(_scope_key(scope_cols), ORDINAL_BITS)
                         + F.col("_boff") + F.col("_start")))
    rows = based.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1)))
    return rows.select(*keys, (F.col("_base") + F.col("_i")).alias(id_col))
