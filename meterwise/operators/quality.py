"""Quality checks, reconciliation and run metrics (V1-V9, M1, M2).

Every check returns a DataFrame report computed with one aggregation per
side; callers decide whether to raise (``assert_passed``).  The reference
prints its checks and never fails; here a failed check can stop a run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from meterwise.operators.cumulative import continuity_summary


def _glue(*frames: DataFrame) -> DataFrame:
    """Attach one-row aggregates to ``frames[0]`` (equi-join on a constant
    key; every frame after the first has exactly one row)."""
    out = frames[0].withColumn("_k", F.lit(1))
    for f in frames[1:]:
        out = out.join(F.broadcast(f.withColumn("_k", F.lit(1))), "_k")
    return out.drop("_k")


def dsum(df: DataFrame, col: str, alias: str) -> Column:
    """``sum`` whose decimal result is widened to precision 38 (Spark sums
    DECIMAL(p,s) as DECIMAL(p+10,s); a fixed result type keeps reports from
    different layers comparable)."""
    from pyspark.sql.types import DecimalType
    t = df.schema[col].dataType
    s = F.sum(col)
    if isinstance(t, DecimalType):
        s = s.cast(DecimalType(38, t.scale))
    return s.alias(alias)


def require_rows(df: DataFrame, what: str = "input") -> None:
    """V3: raise on an empty input (a limit-1 probe, not a count)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")


def validate_mart(fact: DataFrame, mart: DataFrame, tolerance: float = 0.01,
                  count_col: str = "trip_count", amount_col: str = "total_amount",
                  fact_amount_col: str = "total_amount") -> DataFrame:
    """V1: mart trip sum = fact rows; totals agree within ``tolerance``."""
    f = fact.agg(F.count(F.lit(1)).alias("fact_rows"),
                 dsum(fact, fact_amount_col, "fact_total_amount"))
    m = mart.agg(F.count(F.lit(1)).alias("mart_rows"),
                 F.sum(count_col).alias("mart_trip_sum"),
                 dsum(mart, amount_col, "mart_total_amount"))
    g = _glue(f, m)
    diff = F.abs(F.coalesce(F.col("fact_total_amount"), F.lit(0)) - F.coalesce(F.col("mart_total_amount"), F.lit(0)))
    return g.select("fact_rows", "mart_rows", "mart_trip_sum", "fact_total_amount", "mart_total_amount",
                    diff.alias("amount_diff"),
                    ((F.col("fact_rows") == F.coalesce(F.col("mart_trip_sum"), F.lit(0)))
                     & (diff < F.lit(tolerance))).alias("passed"))


def validate_cumulative(fact: DataFrame, cumulative: DataFrame, entity: str,
                        tolerance: float = 0.01) -> DataFrame:
    """V2: V1 on the monthly columns, plus the N5 continuity check."""
    v = validate_mart(fact, cumulative, tolerance, "monthly_trip_count", "monthly_total_amount")
    c = continuity_summary(cumulative, entity)
    return _glue(v, c).withColumn("passed", F.col("passed") & (F.col("violations") == 0))


def cleaned_rules(cleaned: DataFrame) -> DataFrame:
    """V4: rule violations that must be zero after cleaning (one pass)."""
    return cleaned.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("pickup_datetime").isNull() | F.col("dropoff_datetime").isNull()).alias("null_times"),
        F.count_if(F.col("dropoff_datetime") <= F.col("pickup_datetime")).alias("dropoff_not_after_pickup"),
        F.count_if(F.col("trip_duration_min") <= 0).alias("nonpositive_duration"),
        F.count_if(F.col("trip_distance") <= 0).alias("nonpositive_distance"),
        F.count_if(F.col("fare_amount") <= 0).alias("nonpositive_fare"),
        F.count_if(F.col("total_amount") <= 0).alias("nonpositive_total"),
        F.count_if(F.col("passenger_count") <= 0).alias("nonpositive_passengers"),
    )


def fact_rules(cleaned: DataFrame, fact: DataFrame) -> DataFrame:
    """V5: counts equal; duration > 0; tip_rate >= 0; fare_per_mile > 0."""
    c = cleaned.agg(F.count(F.lit(1)).alias("cleaned_rows"))
    f = fact.agg(F.count(F.lit(1)).alias("fact_rows"),
                 F.count_if(F.col("trip_duration_min") <= 0).alias("nonpositive_duration"),
                 F.count_if(F.col("tip_rate") < 0).alias("negative_tip_rate"),
                 F.count_if(F.col("fare_per_mile") <= 0).alias("nonpositive_fare_per_mile"))
    return _glue(c, f)


def reconcile_by_month(fact: DataFrame, mart: DataFrame, count_col: str = "trip_count",
                       amount_col: str = "total_amount") -> DataFrame:
    """V6: per month, fact trips/amounts against the mart's sums.

    Both sides are reduced to one row per month before the full outer join,
    so the join is months x months, whatever the data size.
    """
    f = fact.groupBy(F.col("pickup_year").alias("year"), F.col("pickup_month").alias("month")).agg(
        F.count(F.lit(1)).alias("fact_trips"), dsum(fact, "total_amount", "fact_amount"))
    m = mart.groupBy("year", "month").agg(F.sum(count_col).alias("mart_trips"),
                                          dsum(mart, amount_col, "mart_amount"))
    j = f.join(m, ["year", "month"], "full_outer")
    return j.select("year", "month",
                    F.coalesce("fact_trips", F.lit(0)).alias("fact_trips"),
                    F.coalesce("mart_trips", F.lit(0)).alias("mart_trips"),
                    "fact_amount", "mart_amount",
                    (F.coalesce("fact_amount", F.lit(0)) - F.coalesce("mart_amount", F.lit(0))).alias("amount_diff"))


def key_nulls(mart: DataFrame, keys: Sequence[str]) -> DataFrame:
    """V7: null count per grain key (one pass)."""
    return mart.agg(F.count(F.lit(1)).alias("rows"),
                    *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys])


def equivalence(a: DataFrame, b: DataFrame) -> DataFrame:
    """V8: two results are equal as multisets.  Each side is read once: the
    tagged union is grouped by all columns (by position, as ``exceptAll``
    does) and the surplus of either side is summed."""
    names = [f"c{i}" for i in range(len(a.columns))]
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = (a.toDF(*names).withColumns({"a": one, "b": none})
            .union(b.toDF(*names).withColumns({"a": none, "b": one})))
    counts = both.groupBy(*names).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))

    def total(c) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    return counts.agg(total(F.col("a")).alias("rows_a"), total(F.col("b")).alias("rows_b"),
                      total(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("left_only"),
                      total(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("right_only"))


def partition_outliers(counts: DataFrame, rows_col: str = "rows", ratio: float = 0.1) -> DataFrame:
    """V9: partitions (months) with fewer than ``ratio`` x the median rows,
    the symptom of a month wiped by a stray-row overwrite.  ``counts`` has
    one row per partition, so the median is over a calendar-sized table."""
    med = counts.agg(F.percentile_approx(rows_col, 0.5, 1_000_000).alias("median_rows"))
    return _glue(counts, med).withColumn("is_outlier", F.col(rows_col) < F.col("median_rows") * F.lit(ratio))


def observe(df: DataFrame, name: str, amount_col: str | None = None) -> tuple[DataFrame, Observation]:
    """M1: row count (and amount sum) collected *while* ``df`` is written,
    so metrics cost no extra pass over the data."""
    obs = Observation(name)
    metrics: list[Column] = [F.count(F.lit(1)).alias("rows")]
    if amount_col:
        metrics.append(F.sum(amount_col).alias("amount"))
    return df.observe(obs, *metrics), obs


def profile(df: DataFrame, cols: Sequence[str], moments: bool = False) -> DataFrame:
    """M2: rows plus min / max / nulls per column, one aggregation; numeric
    columns also get their mean and deviation with ``moments``."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"),
                 F.count_if(F.col(c).isNull()).alias(f"nulls_{c}")]
        if moments:
            aggs += [F.avg(F.col(c).cast("double")).alias(f"mean_{c}"),
                     F.stddev_samp(F.col(c).cast("double")).alias(f"stddev_{c}")]
    return df.agg(*aggs)


def assert_passed(report: DataFrame, flag: str = "passed") -> None:
    """Raise when any report row has ``flag`` false (reports are tiny)."""
    bad = report.where(~F.coalesce(F.col(flag), F.lit(False))).limit(1).collect()
    if bad:
        raise AssertionError(f"check failed: {bad[0].asDict()}")
