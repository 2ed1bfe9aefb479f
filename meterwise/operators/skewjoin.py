"""Equi-joins with hot keys: split, salt and union.

A key that holds a large share of one side sends that share to one task.  The
join is cut in two instead:

* hot keys are found by one aggregation over the key columns of each side
  (partial counts first) and are few by construction: a key is hot with at
  least ``share`` of a side's rows, so each side has at most ``1 / share`` of them;
* rows of other keys are joined as they are;
* rows of a hot key are joined on a grid: the key's left rows fall into ``a``
  slices and its right rows into ``b``, each left row is sent to the ``b`` cells of its
  slice and each right row to the ``a`` cells of its own, and every pair of
  rows meets in exactly one cell.

``a`` and ``b`` follow from the counts, so that a slice has about
``slice_rows`` rows.  A slice is chosen by a hash of the row's content: a retried task
deals rows as before.  Copies of one row share a slice; pass ``slice_by`` with
columns that tell them apart, or join their counts instead.

Rows with a null key match nothing; they never enter a shuffle here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 0.02
SLICE_ROWS = 1_000_000
HOWS = ("inner", "left", "left_semi", "left_anti")


def _counts(df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.select(*on).dropna("any", subset=list(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("rows"))


def hot_join_keys(left: DataFrame, right: DataFrame, on: Sequence[str], share: float = SHARE,
                  slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``on``, left_rows, right_rows, a, b of the keys that hold at least ``share`` of
    either side and more rows than a slice.  At most ``2 / share`` rows."""
    sides = [_counts(df, on) for df in (left, right)]
    hot = []
    for per_key in sides:
        # One row: the total, summed from the same counts.
        total = per_key.agg(F.sum("rows").alias("_total")).withColumn("_j", F.lit(1))
        hot.append(per_key.withColumn("_j", F.lit(1)).join(F.broadcast(total), "_j").where(
            (F.col("rows") >= share * F.col("_total")) & (F.col("rows") > slice_rows)).select(*on))
    keys = hot[0].unionByName(hot[1]).distinct()
    left_rows, right_rows = (s.withColumnRenamed("rows", n) for s, n in zip(sides, ("left_rows", "right_rows")))
    out = keys.join(left_rows, list(on), "left").join(right_rows, list(on), "left").fillna(0, ["left_rows", "right_rows"])
    return out.withColumns({
        "a": F.greatest(F.lit(1), F.ceil(F.col("left_rows") / slice_rows)).cast("int"),
        "b": F.greatest(F.lit(1), F.ceil(F.col("right_rows") / slice_rows)).cast("int")})


def _is_hot(on: Sequence[str], keys: list) -> Column:
    """Whether a row's key is among the hot ones (a bounded list of constants)."""
    if not keys:
        return F.lit(False)
    tests = [reduce(lambda x, y: x & y, [F.col(c) == F.lit(k[c]) for c in on]) for k in keys]
    return F.coalesce(reduce(lambda x, y: x | y, tests), F.lit(False))


def grid_side(rows: DataFrame, hot: DataFrame, on: Sequence[str], left: bool,
              slice_by: Sequence[str] | None = None) -> DataFrame:
    """The rows of hot keys, once for every cell (``_i``, ``_j``) they are in."""
    own, other = ("a", "b") if left else ("b", "a")
    source = [F.col(c) for c in (slice_by or rows.columns)]
    # At most 2 / share keys: a proven bound for the broadcast.
    held = rows.join(F.broadcast(hot.select(*on, "a", "b")), list(on))
    slice_ = F.pmod(F.xxhash64(*source), F.col(own)).cast("int")
    cells = held.withColumns({"_own": slice_, "_other": F.explode(F.sequence(F.lit(0), F.col(other) - 1))})
    i, j = ("_own", "_other") if left else ("_other", "_own")
    return cells.withColumns({"_i": F.col(i), "_j": F.col(j)}).drop("a", "b", "_own", "_other")


def _inner(left: DataFrame, right: DataFrame, on: list[str], hot: list, hot_df: DataFrame,
           slice_left: Sequence[str] | None, slice_right: Sequence[str] | None) -> DataFrame:
    if not hot:
        return left.join(right, on)
    is_hot = _is_hot(on, hot)
    plain = left.where(~is_hot).join(right.where(~is_hot), on)
    grid = grid_side(left.where(is_hot), hot_df, on, True, slice_left).join(
        grid_side(right.where(is_hot), hot_df, on, False, slice_right).hint("merge"), [*on, "_i", "_j"]).drop("_i", "_j")
    return plain.unionByName(grid)


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", share: float = SHARE,
              slice_rows: int = SLICE_ROWS, slice_left: Sequence[str] | None = None,
              slice_right: Sequence[str] | None = None, copies: str | None = None) -> DataFrame:
    """``left.join(right, on, how)`` with hot keys of either side on a grid.

    ``copies`` (inner and left joins): right rows that are equal in all their columns
    meet a left row once, and the column of this name tells how many pairs a
    result row stands for (1 for an unmatched left row).  A key that is hot on both sides
    gives left rows x *different* right rows, not left x right rows: pass the right
    columns that are needed, and weigh counts and sums with the column.

    ``how``: inner, left, left_semi or left_anti.  The outer part of a left
    join, and semi and anti joins, need the right side's *keys* only; these
    are made distinct first (copies collapse before the shuffle), so there a hot key
    is hot on the left alone and its one right row goes to all slices.
    """
    on = list(on)
    if how not in HOWS:
        raise ValueError(f"unknown join {how!r}: one of {', '.join(HOWS)}")
    if copies is not None and how not in ("inner", "left"):
        raise ValueError(f"a {how} join has no pairs to count")
    spark = left.sparkSession
    right = right.dropna("any", subset=on)
    if copies is not None:
        right = right.groupBy(*right.columns).agg(F.count(F.lit(1)).alias(copies))
    keyed = left.dropna("any", subset=on)
    keys_of = lambda rows: [{c: r[c] for c in on} for r in rows]
    if how == "inner":
        found = hot_join_keys(keyed, right, on, share, slice_rows).collect()  # at most 2 / share rows
        hot_df = spark.createDataFrame(found, _hot_schema(left, on)) if found else None
        return _inner(keyed, right, on, keys_of(found), hot_df, slice_left, slice_right)
    lone = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in on])
    names = right.select(*on).distinct().withColumn("_met", F.lit(True))
    found = hot_join_keys(keyed, names, on, share, slice_rows).collect()
    hot = keys_of(found)
    # Whether a key is on the right: hot keys ask a bounded list, no row of theirs moves.
    is_hot = _is_hot(on, hot)
    met_hot = keys_of(r for r in found if r["right_rows"])
    cold = keyed.where(~is_hot).join(names.where(~is_hot), on, "left")
    met = cold.where("_met").drop("_met").unionByName(keyed.where(_is_hot(on, met_hot)))
    unmet = cold.where("_met is null").drop("_met").unionByName(
        keyed.where(is_hot & ~_is_hot(on, met_hot))).unionByName(left.where(lone))
    if how == "left_semi":
        return met.select(*left.columns)
    if how == "left_anti":
        return unmet.select(*left.columns)
    inner = skew_join(keyed, right, on, "inner", share, slice_rows, slice_left, slice_right)
    if copies is not None:  # counted above: the inner part carries the column
        unmet = unmet.withColumn(copies, F.lit(1).cast("long"))
    return inner.unionByName(unmet, allowMissingColumns=True)


def _hot_schema(left: DataFrame, on: Sequence[str]):
    from pyspark.sql.types import IntegerType, LongType, StructField, StructType
    return StructType([*[StructField(c, left.schema[c].dataType) for c in on],
                       StructField("left_rows", LongType()), StructField("right_rows", LongType()),
                       StructField("a", IntegerType()), StructField("b", IntegerType())])
