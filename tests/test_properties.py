"""Property tests (hypothesis): invariants between layers on random trips."""
import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterwise.functions.ids import assign_row_ids
from meterwise.operators import cumulative as N
from meterwise.operators import marts as M
from meterwise.operators.partial import build_daily_partial, merge_partials

SCHEMA = ("year_month string, pickup_year int, pickup_month int, pickup_hour int, pickup_date date, "
          "pickup_day int, vendor_id long, pickup_location_id long, passenger_count long, "
          "trip_distance decimal(18,2), trip_duration_min double, fare_amount decimal(18,2), "
          "tip_amount decimal(18,2), tolls_amount decimal(18,2), total_amount decimal(18,2)")

money = st.decimals(min_value=Decimal("0.01"), max_value=Decimal("500"), places=2)
trip = st.tuples(st.integers(1, 12), st.integers(1, 28), st.integers(0, 23), st.integers(0, 3),
                 st.integers(1, 4), money, money, st.integers(1, 600))
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, trips):
    rows = []
    for month, day, hour, vendor, zone, fare, tip, mins in trips:
        rows.append((f"2024-{month:02d}", 2024, month, hour, dt.date(2024, month, day), day, vendor, zone,
                     1, fare, mins / 10.0, fare, tip, Decimal("0.00"), fare + tip))
    return spark.createDataFrame(rows, SCHEMA)


@SETTINGS
@given(st.lists(trip, min_size=1, max_size=40))
def test_mart_sums_equal_fact_sums(spark, trips):
    f = frame(spark, trips)
    z = spark.createDataFrame([(i, "b", "z", "s") for i in range(1, 5)],
                              "location_id long, borough string, zone string, service_zone string")
    mart = M.build_metric_mart(f, M.ZONE_HOUR, z, "decimal", load_ts=False)
    got = mart.agg(F.sum("trip_count").alias("n"), F.sum("total_amount").alias("t")).first()
    assert got.n == len(trips)
    assert got.t == sum(t[5] + t[6] for t in trips)


@SETTINGS
@given(st.lists(trip, min_size=1, max_size=40))
def test_partials_merge_to_direct(spark, trips):
    f = frame(spark, trips)
    cols = ["year_month", "pickup_hour", "pickup_location_id", "trip_count", "total_amount", "total_fare_amount"]
    direct = M.aggregate(f, M.ZONE_HOUR, "decimal").select(*cols)
    merged = merge_partials(build_daily_partial(f, money_mode="decimal", sketch=False),
                            money_mode="decimal", quantiles=False).select(*cols)
    assert direct.exceptAll(merged).count() == 0 and merged.exceptAll(direct).count() == 0


@SETTINGS
@given(st.lists(trip, min_size=2, max_size=40), st.integers(2, 11))
def test_incremental_equals_full(spark, trips, split):
    f = frame(spark, trips)
    dim = spark.createDataFrame([(1, "A")], "vendor_id long, vendor_name string")
    full = N.build_cumulative_mart(f, M.VENDOR_MONTH, dim, "decimal", load_ts=False)
    prev = N.build_cumulative_mart(f.where(F.col("pickup_month") < split), M.VENDOR_MONTH, dim, "decimal",
                                   load_ts=False)
    new = N.incremental_cumulative(prev, f.where(F.col("pickup_month") >= split), M.VENDOR_MONTH, dim,
                                   "decimal", load_ts=False)
    both = prev.unionByName(new)
    assert both.exceptAll(full).count() == 0 and full.exceptAll(both).count() == 0


@SETTINGS
@given(st.lists(trip, min_size=1, max_size=30), st.integers(0, 5))
def test_ids_unique_and_repeatable(spark, trips, dups):
    f = frame(spark, trips + trips[:1] * dups)
    ident = ["pickup_date", "pickup_hour", "vendor_id", "pickup_location_id", "fare_amount", "tip_amount"]
    a = assign_row_ids(f, ident, ("pickup_year", "pickup_month"), buckets=4, chunk=2)
    b = assign_row_ids(f.repartition(5), ident, ("pickup_year", "pickup_month"), buckets=4, chunk=2)
    assert a.count() == f.count() == a.select("trip_id").distinct().count()
    assert a.exceptAll(b).count() == 0
