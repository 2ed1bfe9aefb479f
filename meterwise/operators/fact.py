"""Cleaned -> Fact (P10-P15), built only for the months a load touched.

One row per trip.  The fact keeps the Cleaned columns used downstream, adds
three guarded ratios computed on ``fare_amount`` (the marts' ratios use
``total_amount`` sums instead, finding G5: both are kept, neither is derived
from the other), a deterministic ``trip_id`` and the ``year``/``month``
partition columns (the pickup month).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.functions.ids import assign_row_ids, content_ids
from meterwise.functions.numeric import guarded_ratio
from meterwise.sources.readers import month_filter

# Fact columns between trip_id and the ratios, in contract order.
FACT_BASE_COLUMNS = (
    "vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "year_month",
    "pickup_year", "pickup_month", "pickup_day", "pickup_hour", "pickup_dayofweek",
    "pickup_location_id", "dropoff_location_id", "payment_type", "ratecode_id",
    "passenger_count", "trip_distance", "trip_duration_sec", "trip_duration_min",
    "fare_amount", "tip_amount", "tolls_amount", "total_amount", "extra", "mta_tax",
    "improvement_surcharge", "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
)
RATIO_COLUMNS = ("tip_rate", "fare_per_mile", "fare_per_minute")
# Columns some variants lack (fhv has no fares, fhvhv no vendor): typed nulls.
_LONG_COLUMNS = {"vendor_id", "payment_type", "ratecode_id", "passenger_count"}


def trip_ratios(money_mode: str = "double") -> dict:
    """Ratios guarded against zero/negative denominators.  The
    reference rounds them (4 / 2 / 2 dp); exact mode keeps the quotient."""
    exact = money_mode == "decimal"
    return {
        "tip_rate": guarded_ratio("tip_amount", "total_amount", None if exact else 4),
        "fare_per_mile": guarded_ratio("fare_amount", "trip_distance", None if exact else 2),
        "fare_per_minute": guarded_ratio("fare_amount", "trip_duration_min", None if exact else 2),
    }


def build_fact(cleaned: DataFrame, with_ids: bool = True, load_ts: bool = True,
               id_buckets: int = 1024, money_mode: str = "double", ids: str = "content") -> DataFrame:
    """P10: the fact frame for whatever Cleaned rows it is given.

    Columns that a variant does not have (e.g. fhv has no fares) become
    typed nulls so every variant yields the same fact schema.  With
    ``with_ids`` every row gets a ``trip_id`` over all fact base columns:
    ``ids="content"`` a hash that no later load changes (:func:`content_ids`),
    ``ids="dense"`` ordinals per pickup month (:func:`assign_row_ids`).
    """
    present = {c.lower() for c in cleaned.columns}
    money_t = "decimal(18,2)" if money_mode == "decimal" else "double"

    def missing(c: str):
        return F.lit(None).cast("long" if c in _LONG_COLUMNS else money_t).alias(c)

    base = cleaned.select(*[F.col(c) if c.lower() in present else missing(c) for c in FACT_BASE_COLUMNS])
    if ids not in ("content", "dense"):
        raise ValueError(f"unknown ids {ids!r}")
    if with_ids and ids == "content":
        base = content_ids(base, FACT_BASE_COLUMNS)
    elif with_ids:
        base = assign_row_ids(base, FACT_BASE_COLUMNS, ("pickup_year", "pickup_month"),
                              id_col="trip_id", buckets=id_buckets)
    else:
        base = base.withColumn("trip_id", F.lit(None).cast("string" if ids == "content" else "long"))
    out = base.withColumns(trip_ratios(money_mode))
    cols = ["trip_id", *FACT_BASE_COLUMNS, *RATIO_COLUMNS]
    sel = [F.col(c) for c in cols]
    if load_ts:
        sel.append(F.current_timestamp().alias("created_at"))
    sel += [F.col("pickup_year").alias("year"), F.col("pickup_month").alias("month")]
    return out.select(*sel)


def cleaned_for_months(cleaned_all: DataFrame, months: Iterable[tuple[int, int]]) -> DataFrame:
    """Every Cleaned row whose *pickup* month is in ``months``, whichever load
    brought it.  Rebuilding a Fact month from all loads keeps a stray row in
    the February file from replacing January's partition with itself (G3).
    The predicate is on data columns, so Parquet row-group statistics skip
    the loads that hold no such month."""
    return cleaned_all.where(month_filter(months, "pickup_year", "pickup_month"))
