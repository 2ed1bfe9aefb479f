"""Exact percentiles from mergeable daily histograms.

A daily partial keeps, per hour and entity, how many trips had each whole-second
duration.  Counts add, so days merge into months exactly, and a percentile is the
smallest value whose running count reaches ``q`` of all: what
``percentile_disc`` gives on the trips.

Finding it never brings a group together.  Values fall into buckets of
``BUCKET`` seconds; a running count over the *buckets* of a group (a day has 24,
a year 8,760) tells the bucket that holds each rank, and only that bucket's
values (at most ``BUCKET``) are counted through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterwise.operators.partial import DAY_GRAIN

VALUE = "trip_duration_sec"
BUCKET = 3_600
MONTH_GRAIN = ("year_month", "pickup_year", "pickup_month", "pickup_hour")


def build_daily_histogram(fact: DataFrame, entity: str = "pickup_location_id", value: str = VALUE) -> DataFrame:
    """Date x hour x entity x value -> trips: one row per distinct value.
    Rows without a value are not counted."""
    rows = fact.where(F.col(value).isNotNull())
    return rows.groupBy(*DAY_GRAIN, entity, F.col(value).cast("long").alias("value")).agg(
        F.count(F.lit(1)).alias("trips"))


def merge_histograms(partial: DataFrame, entity: str = "pickup_location_id",
                     grain: Sequence[str] = MONTH_GRAIN) -> DataFrame:
    """Histograms of days added up to ``grain`` x entity."""
    named = partial.withColumn("year_month", F.date_format("pickup_date", "yyyy-MM"))
    return named.groupBy(*grain, entity, "value").agg(F.sum("trips").alias("trips"))


def exact_percentiles(histogram: DataFrame, keys: Sequence[str], quantiles: dict[str, float],
                      bucket: int = BUCKET) -> DataFrame:
    """``keys``, trips and for each name in ``quantiles`` the value of that rank.

    ``histogram`` has ``keys``, value and trips; values may be repeated.  Null
    keys form groups as in any aggregation."""
    keys = list(keys)
    held = histogram.withColumn("_bucket", F.floor(F.col("value") / bucket))
    per_bucket = held.groupBy(*keys, "_bucket").agg(F.sum("trips").alias("_n"))
    by_bucket = Window.partitionBy(*keys).orderBy("_bucket")
    per_bucket = per_bucket.withColumns({
        "_until": F.sum("_n").over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_all": F.sum("_n").over(Window.partitionBy(*keys))})
    # The rank of a quantile, and whether this bucket holds it.
    asked = F.array(*[F.struct(F.lit(name).alias("name"),
                               F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("_all"))).cast("long").alias("rank"))
                      for name, q in quantiles.items()])
    before = F.col("_until") - F.col("_n")
    found = per_bucket.select(*keys, "_bucket", before.alias("_before"), F.col("_all"), F.explode(
        F.filter(asked, lambda x: (x["rank"] > before) & (x["rank"] <= F.col("_until")))).alias("_asked"))
    found = found.withColumnsRenamed({c: f"_of_{c}" for c in [*keys, "_bucket"]})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys] + [F.col("_bucket") == F.col("_of__bucket")]
    inside = held.join(found, same).select(*keys, "value", "trips", "_before", "_all", "_asked.name", "_asked.rank")
    # At most ``bucket`` distinct values are counted through.
    by_value = Window.partitionBy(*keys, "name").orderBy("value").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    counted = inside.withColumn("_run", F.col("_before") + F.sum("trips").over(by_value))
    return counted.where(F.col("_run") >= F.col("rank")).groupBy(*keys).agg(
        F.max("_all").alias("trips"),
        *[F.min(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in quantiles])


def duration_percentiles(partial: DataFrame, entity: str = "pickup_location_id",
                         grain: Sequence[str] = MONTH_GRAIN) -> DataFrame:
    """Grain x entity: trips, exact p50 and p90 of the duration, in seconds and in
    minutes of two decimals as the Fact has them (rounding keeps the order)."""
    names = {"p50_duration_sec": 0.5, "p90_duration_sec": 0.9}
    out = exact_percentiles(merge_histograms(partial, entity, grain), [*grain, entity], names)
    return out.withColumns({n.replace("_sec", "_min"): F.round(F.col(n).cast("double") / 60.0, 2) for n in names})
