"""Plan shape checks: pruning, pushdown and the single mart shuffle."""
import contextlib
import io
import os
import re

from pyspark.sql import functions as F

from meterwise.operators import marts as M
from meterwise.sources.readers import read_table
from meterwise.sources.writers import write_partitioned


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_mart_over_written_fact_prunes_and_shuffles_once(spark, out):
    rows = [(y, m, h, 1, z, float(h + 1)) for y in (2023, 2024) for m in (1, 2, 3) for h in range(3)
            for z in (1, 2)]
    f = spark.createDataFrame(rows, "year int, month int, pickup_hour int, vendor_id long, "
                                    "pickup_location_id long, fare_amount double")
    f = f.withColumns({
        "pickup_year": F.col("year"), "pickup_month": F.col("month"),
        "year_month": F.format_string("%04d-%02d", "year", "month"),
        "passenger_count": F.lit(1).cast("long"), "trip_distance": F.lit(2.0),
        "trip_duration_min": F.lit(10.0), "tip_amount": F.lit(1.0), "tolls_amount": F.lit(0.0),
        "total_amount": F.col("fare_amount") + 1.0, "trip_id": F.monotonically_increasing_id(),
        "unused_wide_column": F.lit("x" * 50)})
    p = os.path.join(out, "fact")
    write_partitioned(f, p, ("year", "month"), mode="static")
    fact = read_table(spark, p, [(2024, 2)])
    zones = spark.createDataFrame([(1, "b", "z", "s"), (2, "b", "z", "s")],
                                  "location_id long, borough string, zone string, service_zone string")
    mart = M.build_metric_mart(fact, M.ZONE_HOUR, zones, load_ts=False)
    text = plan(mart)
    assert "PartitionFilters: [isnotnull(year" in text or "PartitionFilters: [(year" in text
    assert "unused_wide_column" not in text.split("ReadSchema:")[1].split("\n")[0]
    assert "trip_id" not in text.split("ReadSchema:")[1].split("\n")[0]
    # the trips are shuffled once (partial -> final aggregate); the join only
    # sees aggregated rows, and AQE broadcasts the measured-small dimension
    assert "ObjectHashAggregate" in text or "HashAggregate" in text
    assert mart.count() == 3 * 2
    mart.collect()
    final = mart._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final.split("Initial Plan")[0]


def test_cleaning_pushes_null_filters_to_scan(spark, out):
    import datetime as dt
    from meterwise.operators.clean import clean
    t = dt.datetime(2024, 1, 1, 8)
    raw = spark.createDataFrame(
        [(1, t, t + dt.timedelta(minutes=5), 1.0, 2.0, 1.0, "N", 3, 4, 1, 9.0, 0.0, 0.5, 1.0, 0.0, 0.3,
          10.8, 2.5, 0.0)],
        "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
        "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
        "PULocationID int, DOLocationID int, payment_type long, fare_amount double, extra double, "
        "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
        "total_amount double, congestion_surcharge double, Airport_fee double")
    p = os.path.join(out, "raw")
    raw.write.parquet(p)
    text = plan(clean(spark.read.parquet(p), "yellow", load_ts=False))
    pushed = text.split("PushedFilters:")[1].split("\n")[0]
    for c in ("tpep_pickup_datetime", "PULocationID", "passenger_count", "fare_amount"):
        assert c in pushed


def _trip_tables(path):
    """Line items, orders, suppliers and customers small enough to be broadcast, with
    repeated and unknown keys."""
    import duckdb
    c = duckdb.connect()
    rows = {
        "lineitem": "SELECT i // 3 AS l_orderkey, i % 5 AS l_suppkey, CAST(i % 3 AS INTEGER) AS l_linenumber, 2.0 AS l_quantity, "
                    "10.5 + i AS l_extendedprice, 0.1 AS l_discount, 0.2 AS l_tax, 'F' AS l_linestatus, "
                    "TIMESTAMP '1996-03-01' + to_days(CAST(i AS INTEGER)) AS l_shipdate FROM range(60) r(i)",
        "orders": "SELECT i AS o_orderkey, CASE WHEN i % 4 > 0 THEN i % 7 END AS o_custkey, "
                  "TIMESTAMP '1996-02-01' AS o_orderdate, 'x' AS o_orderpriority FROM range(18) r(i)",
        "supplier": "SELECT i % 4 AS s_suppkey, CAST(i AS INTEGER) AS s_nationkey FROM range(5) r(i)",
        "customer": "SELECT i AS c_custkey, CAST(i AS INTEGER) AS c_nationkey FROM range(6) r(i)"}
    for name, sql in rows.items():
        c.execute(f"COPY ({sql}) TO '{path}/{name}.parquet' (FORMAT parquet)")
    return c.execute(f"""SELECT count(*), sum(l_linenumber) FROM '{path}/lineitem.parquet' JOIN '{path}/orders.parquet'
        ON l_orderkey = o_orderkey JOIN '{path}/supplier.parquet' ON l_suppkey = s_suppkey
        JOIN '{path}/customer.parquet' ON o_custkey = c_custkey""").fetchone()


def test_trips_are_merged_at_every_size(spark, out):
    """No broadcast of orders at a small size that is a shuffle at the next."""
    from meterwise.plans.fixtures import trips_orders
    want = _trip_tables(out)
    trips = trips_orders(spark, out)
    assert (trips.count(), trips.agg(F.sum("passenger_count")).first()[0]) == want
    assert "SortMergeJoin Inner" in plan(trips)


def test_staged_trips_are_joined_once(spark, out):
    """the reads of a staged frame do not repeat the joins behind it."""
    from meterwise.plans.fixtures import trips_orders
    from meterwise.plans.queries import staged
    n = _trip_tables(out)[0]
    back = staged(spark, trips_orders(spark, out).withColumn("m", F.month("pickup_datetime")), "once", "m")
    assert back.count() == n and "Join" not in plan(back)
    assert re.search(r"PartitionFilters: \[.*m#", plan(back.where("m = 2")))


def test_layer_writes_are_bounded(spark, monkeypatch):
    """A run's write tasks get small splits, the session keeps its own."""
    from meterwise.plans import layers
    from meterwise.session import WRITE_CONF
    seen = []
    monkeypatch.setattr(layers.P, "recover", lambda *a: (seen.append({k: spark.conf.get(k) for k in WRITE_CONF}), 1 / 0))
    before = {k: spark.conf.get(k, None) for k in WRITE_CONF}
    for run in (lambda: layers.run_month(spark, layers.Layout("/nowhere"), "s", 2024, 1, None),
                lambda: layers.backfill(spark, layers.Layout("/nowhere"), "/nowhere", None)):
        try:
            run()
        except ZeroDivisionError:
            pass
    assert seen == [WRITE_CONF, WRITE_CONF]
    assert {k: spark.conf.get(k, None) for k in WRITE_CONF} == before
