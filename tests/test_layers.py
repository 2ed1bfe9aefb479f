"""Monthly runs through every layer, on literal source files."""
import datetime as dt
import os

from pyspark.sql import functions as F

from meterwise.plans.layers import Layout, backfill, run_month

SCHEMA = ("VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
          "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
          "PULocationID int, DOLocationID int, payment_type long, fare_amount double, extra double, "
          "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
          "total_amount double, congestion_surcharge double, Airport_fee double")


def month_rows(year, month, n, stray_from=None, dup=0):
    rows = []
    for i in range(n):
        pu = dt.datetime(year, month, 1 + i % 27, i % 24, 5)
        rows.append((1 + i % 3, pu, pu + dt.timedelta(minutes=5 + i), 1.0 + i % 4, 1.5 + i, 1.0, "N",
                     1 + i % 4, 2, 1, 10.0 + i, 0.0, 0.5, 1.0, 0.0, 0.3, 11.8 + i, 2.5, 0.0))
    rows += [rows[0]] * dup  # identical trips
    if stray_from:
        y, m = stray_from
        pu = dt.datetime(y, m, 28, 23, 50)
        rows.append((2, pu, pu + dt.timedelta(minutes=20), 1.0, 3.0, 1.0, "N", 3, 4, 1, 20.0, 0.0, 0.5,
                     2.0, 0.0, 0.3, 22.8, 2.5, 0.0))
    return rows


def write_source(spark, root, y, m, rows):
    p = os.path.join(root, "source", "yellow", f"year={y}", f"month={m:02d}")
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(p)
    return p


def zone_dim(spark):
    return spark.createDataFrame([(i, f"B{i % 2}", f"Z{i}", "Yellow Zone") for i in range(1, 6)],
                                 "location_id long, borough string, zone string, service_zone string")


def _fact(spark, lay):
    return spark.read.parquet(lay.fact).select("trip_id", "pickup_datetime", "fare_amount", "year", "month")


def _cum(spark, lay, name):
    return spark.read.parquet(lay.mart(name)).drop("created_at", "updated_at")


def test_monthly_runs_match_backfill_and_rerun(spark, out):
    src_root = os.path.join(out, "src")
    jan = write_source(spark, src_root, 2024, 1, month_rows(2024, 1, 40, dup=3))
    feb = write_source(spark, src_root, 2024, 2, month_rows(2024, 2, 30, stray_from=(2024, 1)))
    z = zone_dim(spark)

    lay = Layout(os.path.join(out, "monthly"))
    run_month(spark, lay, jan, 2024, 1, z)
    run_month(spark, lay, feb, 2024, 2, z)
    f1 = _fact(spark, lay)
    # January: 40 trips + 3 identical copies + the stray row from February's file
    by_month = {(r.year, r.month): r.n for r in f1.groupBy("year", "month").agg(F.count("*").alias("n")).collect()}
    assert by_month == {(2024, 1): 44, (2024, 2): 30}

    # ids are unique, and a rerun of February changes nothing
    assert f1.select("trip_id").distinct().count() == f1.count()
    before = sorted(map(tuple, f1.collect()))
    cum_before = sorted(map(tuple, _cum(spark, lay, "zone_cumulative").collect()))
    run_month(spark, lay, feb, 2024, 2, z)
    assert sorted(map(tuple, _fact(spark, lay).collect())) == before
    assert sorted(map(tuple, _cum(spark, lay, "zone_cumulative").collect())) == cum_before

    # a backfill of the same files gives the same fact (ids included) and marts
    lay_b = Layout(os.path.join(out, "backfill"))
    metrics = backfill(spark, lay_b, os.path.join(src_root, "source", "yellow"), z)
    assert metrics["raw_rows"] == 74
    assert sorted(map(tuple, _fact(spark, lay_b).collect())) == before
    for name in ("zone_cumulative", "vendor_cumulative"):
        a = _cum(spark, lay, name)
        b = _cum(spark, lay_b, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    hz_a = spark.read.parquet(lay.mart("zone_hour")).drop("created_at", "updated_at")
    hz_b = spark.read.parquet(lay_b.mart("zone_hour")).drop("created_at", "updated_at")
    assert hz_a.exceptAll(hz_b).count() == 0 and hz_b.exceptAll(hz_a).count() == 0

    log = spark.read.parquet(lay.run_log)
    assert log.count() == 15  # three runs x (raw, cleaned, fact, mart, validate)
    assert {r.layer for r in log.collect()} == {"raw", "cleaned", "fact", "mart", "validate"}
    assert {r.status for r in log.where("layer = 'validate'").collect()} == {"ok"}


def test_multi_load_clean_clears_emptied_load(spark, out):
    from meterwise.plans.layers import clean_loads, load_raw
    src_root = os.path.join(out, "src")
    jan = write_source(spark, src_root, 2024, 1, month_rows(2024, 1, 5))
    feb = write_source(spark, src_root, 2024, 2, month_rows(2024, 2, 4))
    lay = Layout(os.path.join(out, "lay"))
    load_raw(spark, lay, jan, 2024, 1)
    load_raw(spark, lay, feb, 2024, 2)
    clean_loads(spark, lay, [(2024, 1), (2024, 2)])
    assert spark.read.parquet(lay.cleaned).count() == 9
    # February is reloaded with trips that all fail the rules, then both loads are re-cleaned
    bad = [r[:10] + (-1.0,) + r[11:] for r in month_rows(2024, 2, 4)]
    load_raw(spark, lay, write_source(spark, src_root, 2024, 2, bad), 2024, 2)
    clean_loads(spark, lay, [(2024, 1), (2024, 2)])
    got = {(r.src_month): r.n for r in spark.read.parquet(lay.cleaned)
           .groupBy("src_month").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 5}
    lm = {r.src_month for r in spark.read.parquet(lay.load_months).collect()}
    assert lm == {1}


def test_run_log_carries_metrics(spark, out):
    import json
    src_root = os.path.join(out, "src")
    jan = write_source(spark, src_root, 2024, 1, month_rows(2024, 1, 6))
    lay = Layout(os.path.join(out, "lay"))
    run_month(spark, lay, jan, 2024, 1, zone_dim(spark))
    rows = {r.layer: r for r in spark.read.parquet(lay.run_log).collect()}
    assert rows["raw"].rows_out == 6 and rows["cleaned"].rows_out == 6
    d = json.loads(rows["raw"].detail)
    assert d["bytes"] > 0 and d["seconds"] >= 0
    assert rows["validate"].status == "ok"


def test_empty_source_fails_the_run(spark, out):
    import pytest
    src_root = os.path.join(out, "src")
    empty = write_source(spark, src_root, 2024, 3, [])
    lay = Layout(os.path.join(out, "lay"))
    with pytest.raises(ValueError):
        run_month(spark, lay, empty, 2024, 3, zone_dim(spark))
    log = spark.read.parquet(lay.run_log).collect()
    assert [(r.layer, r.status) for r in log] == [("run", "failed")]
