"""Trip time features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_seconds(pickup, dropoff) -> Column:
    """Whole seconds between two timestamps (NTZ or LTZ)."""
    return F.unix_timestamp(_c(dropoff)) - F.unix_timestamp(_c(pickup))


def year_month_label(ts) -> Column:
    """Zero-padded ``yyyy-MM``.  The unpadded ``2024-1`` label sorts October
    before February; we never sort on the label anyway (finding G1)."""
    return F.date_format(_c(ts), "yyyy-MM")


def time_features(pickup, dropoff) -> dict[str, Column]:
    """The eleven shared time columns of the Cleaned layer, as a mapping for
    ``DataFrame.withColumns`` (one Project, no chained withColumn)."""
    pu, do = _c(pickup), _c(dropoff)
    secs = duration_seconds(pu, do)
    return {
        "pickup_datetime": pu,
        "dropoff_datetime": do,
        "pickup_date": F.to_date(pu),
        "pickup_year": F.year(pu),
        "pickup_month": F.month(pu),
        "pickup_day": F.dayofmonth(pu),
        "pickup_hour": F.hour(pu),
        "pickup_dayofweek": F.dayofweek(pu),  # 1 = Sunday
        "year_month": year_month_label(pu),
        "trip_duration_sec": secs,
        "trip_duration_min": F.round(secs / F.lit(60.0), 2),
    }
