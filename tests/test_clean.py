import datetime as dt

from pyspark.sql import functions as F

from meterwise.operators import clean as C

T0 = dt.datetime(2024, 1, 15, 8, 0, 0)


def yellow_rows(spark, rows, airport_col="Airport_fee", with_cbd=False):
    """rows: (minutes, passengers, distance, fare, total, vendor)"""
    data = []
    for i, (mins, pax, dist, fare, total, vendor) in enumerate(rows):
        r = {"VendorID": vendor, "tpep_pickup_datetime": T0,
             "tpep_dropoff_datetime": T0 + dt.timedelta(minutes=mins) if mins is not None else None,
             "passenger_count": None if pax is None else float(pax), "trip_distance": float(dist),
             "RatecodeID": 1.0, "store_and_fwd_flag": "N",
             "PULocationID": 10 + i, "DOLocationID": 20, "payment_type": 1, "fare_amount": float(fare),
             "extra": 0.0, "mta_tax": 0.5, "tip_amount": 1.0, "tolls_amount": 0.0,
             "improvement_surcharge": 0.3, "total_amount": float(total), "congestion_surcharge": 2,
             airport_col: 0.0}
        if with_cbd:
            r["cbd_congestion_fee"] = 0.75
        data.append(r)
    schema = ("VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
              "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
              "PULocationID int, DOLocationID int, payment_type long, fare_amount double, extra double, "
              "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
              f"total_amount double, congestion_surcharge int, {airport_col} double"
              + (", cbd_congestion_fee double" if with_cbd else ""))
    return spark.createDataFrame([tuple(r.values()) for r in data], schema)


def test_duration_boundaries(spark):
    rows = [(0, 1, 1.0, 5.0, 6.0, 1), (1, 1, 1.0, 5.0, 6.0, 1), (1440, 1, 1.0, 5.0, 6.0, 1),
            (1441, 1, 1.0, 5.0, 6.0, 1), (-5, 1, 1.0, 5.0, 6.0, 1), (None, 1, 1.0, 5.0, 6.0, 1)]
    out = C.clean(yellow_rows(spark, rows), "yellow", load_ts=False)
    mins = sorted(r.trip_duration_min for r in out.collect())
    assert mins == [1.0, 1440.0]


def test_passenger_and_distance_bounds(spark):
    rows = [(10, p, 1.0, 5.0, 6.0, 1) for p in (0, 1, 8, 9, None)]
    rows += [(10, 1, d, 5.0, 6.0, 1) for d in (0.0, 200.0, 200.01)]
    out = C.clean(yellow_rows(spark, rows), "yellow", load_ts=False).collect()
    kept = sorted((r.passenger_count, r.trip_distance) for r in out)
    assert kept == [(1, 1.0), (1, 200.0), (8, 1.0)]


def test_case_variance_and_optional_fee(spark):
    rows = [(10, 1, 1.0, 5.0, 6.0, 1)]
    a = C.clean(yellow_rows(spark, rows, airport_col="airport_fee"), "yellow", load_ts=False)
    assert a.first().airport_fee == 0.0
    assert a.first().cbd_congestion_fee is None
    assert dict(a.dtypes)["cbd_congestion_fee"] == "double"
    assert dict(a.dtypes)["congestion_surcharge"] == "double"  # INT32 normalised
    b = C.clean(yellow_rows(spark, rows, with_cbd=True), "yellow", load_ts=False)
    assert b.first().cbd_congestion_fee == 0.75
    assert a.columns == b.columns


def test_stats_and_reject_reasons(spark):
    rows = [(10, 1, 1.0, 5.0, 6.0, 1), (10, 0, 1.0, 5.0, 6.0, 1), (10, None, 1.0, 5.0, 6.0, 1),
            (0, 1, 1.0, -1.0, 6.0, 1)]
    raw = yellow_rows(spark, rows)
    st = C.filter_stats(raw, "yellow").first()
    assert (st.initial_count, st.kept_count, st.dropped_count) == (4, 1, 3)
    assert abs(st.pass_rate_pct - 25.0) < 1e-9
    rr = {r.rule: r.rejected_count for r in C.reject_reasons(raw, "yellow").collect()}
    assert rr["passenger_count_positive"] == 2  # 0 and null
    assert rr["fare_amount_positive"] == 1
    assert rr["duration_positive"] == 1
    assert rr["dropoff_after_pickup"] == 1


def test_fhv_spellings(spark):
    df = spark.createDataFrame(
        [("B1", T0, T0 + dt.timedelta(minutes=12), 5.0, 7.0, None, "B2")],
        "dispatching_base_num string, pickup_datetime timestamp, dropOff_datetime timestamp, "
        "PUlocationID double, DOlocationID double, SR_Flag int, Affiliated_base_number string")
    out = C.clean(df, "fhv", load_ts=False).first()
    assert out.pickup_location_id == 5 and out.dropoff_location_id == 7
    assert out.trip_duration_min == 12.0 and out.affiliated_base_num == "B2"


def test_year_month_padded_and_dayofweek(spark):
    rows = [(10, 1, 1.0, 5.0, 6.0, 1)]
    r = C.clean(yellow_rows(spark, rows), "yellow", load_ts=False).first()
    assert r.year_month == "2024-01"
    assert r.pickup_dayofweek == 2  # 2024-01-15 is a Monday; 1 = Sunday


def test_unknown_variant(spark):
    import pytest
    with pytest.raises(ValueError):
        C.clean(spark.range(1), "limo")


def test_fact_schema_same_for_every_variant(spark):
    from meterwise.operators.fact import build_fact
    rows = [(10, 1, 1.0, 5.0, 6.0, 1)]
    y = C.clean(yellow_rows(spark, rows), "yellow", load_ts=False)
    fhv = spark.createDataFrame(
        [("B1", T0, T0 + dt.timedelta(minutes=12), 5.0, 7.0, None, "B2")],
        "dispatching_base_num string, pickup_datetime timestamp, dropOff_datetime timestamp, "
        "PUlocationID double, DOlocationID double, SR_Flag int, Affiliated_base_number string")
    f = C.clean(fhv, "fhv", load_ts=False)
    a = build_fact(y, with_ids=False, load_ts=False)
    b = build_fact(f, with_ids=False, load_ts=False)
    assert a.dtypes == b.dtypes
    assert b.first().fare_amount is None and b.first().fare_per_mile == 0.0
