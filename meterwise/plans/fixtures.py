"""Trip-shaped views over the driver's test tables.

The workload is monthly trip files; the test tables are a TPC-H-like star
plus an events stream.  Two views give them the trip shape the layers
expect (column mapping in FIXTURES.md section 3):

* ``trips_orders`` - lineitem joined to orders, supplier and customer: one
  trip per line item, pickup at the order date, drop-off at the ship date,
  80 calendar months (exercises running totals across October-December).
* ``trips_events`` - one trip per event: 24 hours x 30 days of one month.

Both grow linearly with the tables.  ``money_mode="decimal"`` makes every
money column DECIMAL(18,2) *before* any arithmetic, so derived amounts
(tip = price x discount) are exact and identical in any engine.

Each view also has a raw, variant-shaped form (``as_variant_raw``) with the
source column spellings of one of the four variants, so that the cleaning
step runs on realistic raw input.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

DEC = DecimalType(18, 2)
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")  # code = position + 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _money(c, mode: str):
    return c.cast(DEC) if mode == "decimal" else c.cast("double")


def trips_orders(spark: SparkSession, sf_dir: str, money_mode: str = "decimal") -> DataFrame:
    """Line items as trips.

    ``supplier``/``customer`` are joined without a broadcast hint: they grow
    with the scale factor (10k / 150k rows per SF), so AQE decides from
    runtime sizes.  Customers meet the orders first, so that line items are not
    shuffled again for them.  Line items and orders grow alike: they are merged at every
    size, never broadcast at a small one and shuffled at the next.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_linestatus", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    oc = o.join(c, o.o_custkey == c.c_custkey, "inner")
    j = (li.join(oc.hint("merge"), li.l_orderkey == oc.o_orderkey, "inner")
         .join(s, li.l_suppkey == s.s_suppkey, "inner"))
    price = _money(F.col("l_extendedprice"), money_mode)
    disc = _money(F.col("l_discount"), money_mode)
    tax = _money(F.col("l_tax"), money_mode)
    tip = price * disc
    tolls = price * tax
    if money_mode == "decimal":
        tip, tolls = tip.cast(DEC), tolls.cast(DEC)
    fare = price
    total = fare + tip + tolls
    if money_mode == "decimal":
        total = total.cast(DEC)
    return j.select(
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        (F.col("l_suppkey") % 3).cast("long").alias("vendor_id"),
        F.col("s_nationkey").cast("long").alias("pickup_location_id"),
        F.col("c_nationkey").cast("long").alias("dropoff_location_id"),
        F.lit(1).cast("long").alias("ratecode_id"),
        ((F.col("l_orderkey") % 4) + 1).cast("long").alias("payment_type"),
        F.when(F.col("l_linestatus") == "F", "Y").otherwise("N").alias("store_and_fwd_flag"),
        F.col("l_linenumber").cast("long").alias("passenger_count"),
        _money(F.col("l_quantity"), money_mode).alias("trip_distance"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        tolls.alias("tolls_amount"),
        total.alias("total_amount"),
    )


def trips_events(spark: SparkSession, sf_dir: str, money_mode: str = "decimal") -> DataFrame:
    """Events as trips: drop-off is ``floor(value * 60)`` seconds later."""
    e = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    code = F.lit(None).cast("long")
    for i, t in reversed(list(enumerate(EVENT_TYPES, start=1))):
        code = F.when(F.col("event_type") == t, F.lit(i).cast("long")).otherwise(code)
    v = _money(F.col("value"), money_mode)
    zero = F.lit(0).cast(DEC) if money_mode == "decimal" else F.lit(0.0)
    return e.select(
        F.col("ts").alias("pickup_datetime"),
        F.timestamp_add("SECOND", F.floor(F.col("value") * 60).cast("int"), F.col("ts"))
        .alias("dropoff_datetime"),
        code.alias("vendor_id"),
        (F.col("user_id") % 25).cast("long").alias("pickup_location_id"),
        ((F.col("user_id") + 1) % 25).cast("long").alias("dropoff_location_id"),
        F.lit(1).cast("long").alias("ratecode_id"),
        F.lit(1).cast("long").alias("payment_type"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.lit(1).cast("long").alias("passenger_count"),
        v.alias("trip_distance"),
        v.alias("fare_amount"),
        zero.alias("tip_amount"),
        zero.alias("tolls_amount"),
        v.alias("total_amount"),
    )


def zone_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones = nations; borough = region name, zone = nation name,
    service_zone = region name for even nation keys else 'Boro Zone'."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("n_nationkey").cast("long").alias("location_id"),
                    F.col("r_name").alias("borough"),
                    F.col("n_name").alias("zone"),
                    F.when(F.col("n_nationkey") % 2 == 0, F.col("r_name"))
                    .otherwise(F.lit("Boro Zone")).alias("service_zone")))


def as_variant_raw(trips: DataFrame, variant: str) -> DataFrame:
    """Rename a trip view to one variant's raw column spellings.

    Extra fee columns are derived from the view so that every raw column is
    a function of the test tables.  ``cbd_congestion_fee`` is left out on
    purpose: the cleaning step must add it as a typed null (P2).
    """
    money_t = dict(trips.dtypes)["fare_amount"]
    z = F.lit(0).cast(money_t)
    half = F.lit(0.5).cast(money_t)
    if variant in ("yellow", "green"):
        pre = "tpep" if variant == "yellow" else "lpep"
        cols = [
            F.col("vendor_id").cast("int").alias("VendorID"),
            F.col("pickup_datetime").alias(f"{pre}_pickup_datetime"),
            F.col("dropoff_datetime").alias(f"{pre}_dropoff_datetime"),
            F.col("passenger_count").cast("double").alias("passenger_count"),
            F.col("trip_distance"),
            F.col("ratecode_id").cast("double").alias("RatecodeID"),
            F.col("store_and_fwd_flag"),
            F.col("pickup_location_id").cast("int").alias("PULocationID"),
            F.col("dropoff_location_id").cast("int").alias("DOLocationID"),
            F.col("payment_type"),
            F.col("fare_amount"), z.alias("extra"), half.alias("mta_tax"),
            F.col("tip_amount"), F.col("tolls_amount"), z.alias("improvement_surcharge"),
            F.col("total_amount"), z.alias("congestion_surcharge"),
        ]
        if variant == "yellow":
            cols.append(z.alias("Airport_fee"))
        else:
            cols += [F.lit(1).cast("double").alias("trip_type"), z.alias("ehail_fee")]
        return trips.select(*cols)
    if variant == "fhvhv":
        return trips.select(
            F.format_string("HV%04d", F.col("vendor_id")).alias("hvfhs_license_num"),
            F.format_string("B%05d", F.col("pickup_location_id")).alias("dispatching_base_num"),
            F.format_string("B%05d", F.col("dropoff_location_id")).alias("originating_base_num"),
            F.col("pickup_datetime").alias("request_datetime"),
            F.col("pickup_datetime").alias("on_scene_datetime"),
            F.col("pickup_datetime"), F.col("dropoff_datetime"),
            F.col("pickup_location_id").alias("PULocationID"),
            F.col("dropoff_location_id").alias("DOLocationID"),
            F.col("trip_distance").alias("trip_miles"),
            (F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")).alias("trip_time"),
            F.col("fare_amount").alias("base_passenger_fare"),
            F.col("tolls_amount").alias("tolls"), z.alias("bcf"), z.alias("sales_tax"),
            z.alias("congestion_surcharge"), z.alias("airport_fee"),
            F.col("tip_amount").alias("tips"), F.col("fare_amount").alias("driver_pay"),
            F.lit("N").alias("shared_request_flag"), F.lit("N").alias("shared_match_flag"),
            F.lit("N").alias("wav_request_flag"), F.col("store_and_fwd_flag").alias("wav_match_flag"),
        )
    if variant == "fhv":
        return trips.select(
            F.format_string("B%05d", F.col("pickup_location_id")).alias("dispatching_base_num"),
            F.col("pickup_datetime"),
            F.col("dropoff_datetime").alias("dropOff_datetime"),
            F.col("pickup_location_id").cast("double").alias("PUlocationID"),
            F.col("dropoff_location_id").cast("double").alias("DOlocationID"),
            F.lit(None).cast("int").alias("SR_Flag"),
            F.format_string("B%05d", F.col("dropoff_location_id")).alias("Affiliated_base_number"),
        )
    raise ValueError(f"unknown variant {variant!r}")
