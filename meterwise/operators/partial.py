"""Daily partial marts and their merge into monthly marts.

A daily partial keeps only *mergeable* state: counts, sums and a KLL
quantile sketch of the trip duration.  Monthly hour x entity marts are then
a second aggregation over partials: re-sum the sums, derive averages as
``sum / count`` (never an average of averages) and merge the sketches.
Loading a day therefore touches one day of facts, and a month's mart is
rebuilt from ~30 small partitions instead of the month's trips.

KLL percentiles are approximate with a bounded rank error; exact
``percentile_approx`` answers on the same data are within that error, not
bit-identical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from meterwise.operators.marts import SUM_DECIMAL, ZONE_HOUR, attach_dim, mart_ratios

# partial column -> (kind, fact column)
PARTIAL_METRICS = (
    ("trip_count", "count", None),
    ("passenger_count", "sum_long", "passenger_count"),
    ("distance", "sum", "trip_distance"),
    ("duration_min", "sum", "trip_duration_min"),
    ("fare_amount", "sum", "fare_amount"),
    ("tip_amount", "sum", "tip_amount"),
    ("tolls_amount", "sum", "tolls_amount"),
    ("total_amount", "sum", "total_amount"),
)
DAY_GRAIN = ("pickup_date", "pickup_year", "pickup_month", "pickup_day", "pickup_hour")
KLL_K = 200  # sketch size parameter: normalized rank error ~1.65% at k=200


def _sum(c: Column, money_mode: str) -> Column:
    if money_mode == "decimal":
        return F.sum(c.cast(DecimalType(18, 2))).cast(SUM_DECIMAL)
    return F.sum(c.cast("double"))


def build_daily_partial(fact: DataFrame, entity: str = "pickup_location_id",
                        money_mode: str = "double", sketch: bool = True) -> DataFrame:
    """Date x hour x entity partial aggregates (+ duration sketch)."""
    aggs = []
    for name, kind, src in PARTIAL_METRICS:
        if kind == "count":
            aggs.append(F.count(F.lit(1)).alias(name))
        elif kind == "sum_long":
            aggs.append(F.sum(F.col(src).cast("long")).alias(name))
        else:
            aggs.append(_sum(F.col(src), money_mode).alias(name))
    if sketch:
        aggs.append(F.expr(f"kll_sketch_agg_double(CAST(trip_duration_min AS DOUBLE), {KLL_K})")
                    .alias("duration_sketch"))
    return fact.groupBy(*DAY_GRAIN, entity).agg(*aggs)


def merge_partials(partial: DataFrame, entity: str = "pickup_location_id",
                   money_mode: str = "double", quantiles: bool = True) -> DataFrame:
    """Month x hour x entity mart from daily partials."""
    sums = []
    for name, kind, _ in PARTIAL_METRICS:
        if kind in ("count", "sum_long"):
            sums.append(F.sum(name).alias(name if name != "passenger_count" else "total_passenger_count"))
        else:
            s = F.sum(name)
            s = s.cast(SUM_DECIMAL) if money_mode == "decimal" else s
            sums.append(s.alias("total_" + name if not name.startswith("total") else name))
    if quantiles and "duration_sketch" in partial.columns:
        sums.append(F.expr("kll_merge_agg_double(duration_sketch)").alias("_sk"))
    m = (partial.withColumn("year_month", F.date_format("pickup_date", "yyyy-MM"))
         .groupBy("year_month", "pickup_year", "pickup_month", "pickup_hour", entity).agg(*sums))
    n = F.col("trip_count").cast("double")
    derived = {
        "avg_distance": F.col("total_distance").cast("double") / n,
        "avg_duration_min": F.col("total_duration_min").cast("double") / n,
        "avg_fare_amount": F.col("total_fare_amount").cast("double") / n,
        "avg_tip_amount": F.col("total_tip_amount").cast("double") / n,
        "avg_total_amount": F.col("total_amount").cast("double") / n,
    }
    if quantiles and "duration_sketch" in partial.columns:
        derived["p50_duration_min"] = F.expr("kll_sketch_get_quantile_double(_sk, 0.5)")
        derived["p90_duration_min"] = F.expr("kll_sketch_get_quantile_double(_sk, 0.9)")
    out = m.withColumns(derived)
    return out.drop("_sk") if "_sk" in out.columns else out


def mart_from_partials(partial: DataFrame, zone_dim: DataFrame, money_mode: str = "double") -> DataFrame:
    """A17 in the layout of the hour x zone mart: merged sums and sketches,
    averages, ratios and the zone columns."""
    merged = merge_partials(partial, ZONE_HOUR.entity, money_mode).withColumns(mart_ratios(money_mode))
    joined, zone_cols = attach_dim(merged, ZONE_HOUR, zone_dim)
    return joined.select(F.col("pickup_year").alias("year"), F.col("pickup_month").alias("month"), "year_month",
                         "pickup_hour", merged[ZONE_HOUR.entity], *zone_cols,
                         *[F.col(n) for n, _, _ in ZONE_HOUR.metrics], "fare_per_minute", "fare_per_mile")


def split_by_entity(mart: DataFrame, entity: str) -> DataFrame:
    """A18: "one mart per entity" as one job: the mart is written with
    ``partitionBy(entity)`` (see ``write_partitioned``) instead of one
    filter + aggregation per entity; this only clusters rows by entity (a
    ``rebalance`` hint, so AQE splits an entity with many rows)."""
    return mart.hint("rebalance", entity)
