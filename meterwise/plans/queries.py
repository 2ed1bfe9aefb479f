"""The query catalogue: one Spark callable and (where SQL can say it) one
DuckDB oracle statement per operator of SURVEY section 2.

Every query reads the whole test tables through the trip views of
:mod:`meterwise.plans.fixtures`; nothing is sampled or capped (the only
``limit`` calls are the top-k and sample operators, where the limit *is*
the feature).  Outputs use exact arithmetic (``money_mode="decimal"``) and
BIGINT integers so the same numbers come out of both engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, FloatType, IntegerType, ShortType

from meterwise.operators import clean as C
from meterwise.operators import cumulative as N
from meterwise.operators import marts as M
from meterwise.operators.dims import (build_dim_time, build_dim_vendor, dim_date_for,
                                      VENDOR_NAMES)
from meterwise.operators.fact import build_fact
from meterwise.plans import fixtures as FX
from meterwise.plans import sqlparts as Q
from meterwise.session import apply_query_conf, bounded_writes

MODE = "decimal"
# Orders ship up to ~7 years after the order date; a one-day cap would drop
# nearly every line item, so the order-based trips use a 365-day cap.
ORDERS_MAX_MINUTES = 525_600.0
EVENTS_MAX_MINUTES = C.DEFAULT_MAX_MINUTES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_query_conf(spark)
            return conform(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def conform(df: DataFrame) -> DataFrame:
    """Widen small integer and float columns (Spark INT vs DuckDB BIGINT)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            cols.append(F.col(f"`{f.name}`").cast("long").alias(f.name))
        elif isinstance(f.dataType, FloatType):
            cols.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


# ---------------------------------------------------------------- helpers

def trips(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    if which == "orders":
        return FX.trips_orders(spark, sf_dir, MODE)
    return FX.trips_events(spark, sf_dir, MODE)


def cap(which: str) -> float:
    return ORDERS_MAX_MINUTES if which == "orders" else EVENTS_MAX_MINUTES


def cleaned(spark: SparkSession, sf_dir: str, which: str, variant: str = "yellow") -> DataFrame:
    raw = FX.as_variant_raw(trips(spark, sf_dir, which), variant)
    return C.clean(raw, variant, money_mode=MODE, max_minutes=cap(which), load_ts=False)


def fact(spark: SparkSession, sf_dir: str, which: str, with_ids: bool = False) -> DataFrame:
    return build_fact(cleaned(spark, sf_dir, which), with_ids=with_ids, load_ts=False, money_mode=MODE)


def zone(spark, sf_dir):
    return FX.zone_dim(spark, sf_dir)


def vendor_dim(spark, sf_dir, which):
    return build_dim_vendor(cleaned(spark, sf_dir, which))


def static_vendor_dim(spark):
    return spark.createDataFrame(sorted(VENDOR_NAMES.items()), "vendor_id long, vendor_name string")


CL_TE = Q.cleaned("te", EVENTS_MAX_MINUTES)
CL_TO = Q.cleaned("tor", ORDERS_MAX_MINUTES)
W_TE = Q.with_clauses(Q.TE, CL_TE, Q.ZONE)
W_TO = Q.with_clauses(Q.TO, CL_TO, Q.ZONE)
VD_TE = f"vd AS (SELECT DISTINCT vendor_id, {Q.vendor_name('vendor_id')} AS vendor_name FROM cl)"


# ------------------------------------------------------------ hourly marts

def _zone_hour_sql(with_prefix: str) -> str:
    return with_prefix + f"""
SELECT m.pickup_year AS year, m.pickup_month AS month, m.year_month, m.pickup_hour,
       m.pickup_location_id, z.borough, z.zone, z.service_zone,
       {', '.join(k for k in Q.HOUR_METRICS)},
       {Q.ratio('total_amount', 'total_duration_min')} AS fare_per_minute,
       {Q.ratio('total_amount', 'total_distance')} AS fare_per_mile
FROM (SELECT year_month, pickup_year, pickup_month, pickup_hour, pickup_location_id,
         {Q.metric_list(Q.HOUR_METRICS)}
      FROM cl GROUP BY year_month, pickup_year, pickup_month, pickup_hour, pickup_location_id) m
LEFT JOIN zone z ON m.pickup_location_id = z.location_id"""


@register("flagship_hour_zone_mart", _zone_hour_sql(W_TE))
def flagship_hour_zone_mart(spark, sf_dir):
    """A1 + J1 + P14: month x hour x zone metrics over the event trips."""
    return M.build_metric_mart(fact(spark, sf_dir, "events"), M.ZONE_HOUR, zone(spark, sf_dir),
                               money_mode=MODE, load_ts=False)


@register("hour_vendor_mart", Q.with_clauses(Q.TE, CL_TE, VD_TE) + f"""
SELECT m.pickup_year AS year, m.pickup_month AS month, m.year_month, m.pickup_hour, m.vendor_id,
       COALESCE(vd.vendor_name, 'Unknown') AS vendor_name,
       {', '.join(k for k in Q.VENDOR_HOUR_METRICS)},
       {Q.ratio('total_amount', 'total_duration_min')} AS fare_per_minute,
       {Q.ratio('total_amount', 'total_distance')} AS fare_per_mile
FROM (SELECT year_month, pickup_year, pickup_month, pickup_hour, vendor_id,
         {Q.metric_list(Q.VENDOR_HOUR_METRICS)}
      FROM cl GROUP BY year_month, pickup_year, pickup_month, pickup_hour, vendor_id) m
LEFT JOIN vd ON m.vendor_id IS NOT DISTINCT FROM vd.vendor_id""")
def hour_vendor_mart(spark, sf_dir):
    """A2 + J2: month x hour x vendor metrics, null-safe vendor join."""
    return M.build_metric_mart(fact(spark, sf_dir, "events"), M.VENDOR_HOUR,
                               vendor_dim(spark, sf_dir, "events"), money_mode=MODE, load_ts=False)


@register("percentiles_by_group", W_TE + """
SELECT vendor_id, pickup_hour, count(*) AS trips,
       quantile_disc(trip_duration_min, 0.5) AS p50_duration_min,
       quantile_disc(trip_duration_min, 0.9) AS p90_duration_min
FROM cl GROUP BY vendor_id, pickup_hour""")
def percentiles_by_group(spark, sf_dir):
    """A8 + X16: approximate duration percentiles per vendor and hour."""
    f = fact(spark, sf_dir, "events")
    return f.groupBy("vendor_id", "pickup_hour").agg(
        F.count(F.lit(1)).alias("trips"),
        F.percentile_approx("trip_duration_min", 0.5).alias("p50_duration_min"),
        F.percentile_approx("trip_duration_min", 0.9).alias("p90_duration_min"))


# ------------------------------------------------------------ cleaning

@register("time_features", Q.with_clauses(Q.TO, Q.with_duration("tor", "d")) + f"""
SELECT {Q.FEATURES}, trip_duration_sec, {Q.DUR_MIN} AS trip_duration_min FROM d""")
def time_features(spark, sf_dir):
    """P1 + X1-X5: the eleven time columns for every trip (before filtering)."""
    from meterwise.functions.time import time_features as tf
    t = trips(spark, sf_dir, "orders")
    feats = tf("pickup_datetime", "dropoff_datetime")
    return t.select(*[v.alias(k) for k, v in feats.items()])


@register("optional_column_union", Q.with_clauses(Q.TO) + """
SELECT pickup_datetime, fare_amount, CAST(NULL AS DOUBLE) AS cbd_congestion_fee
FROM tor WHERE year(pickup_datetime) < 1998
UNION ALL
SELECT pickup_datetime, fare_amount, CAST(0.75 AS DOUBLE) AS cbd_congestion_fee
FROM tor WHERE year(pickup_datetime) >= 1998""")
def optional_column_union(spark, sf_dir):
    """P2 + U1: an older load lacks the fee column; it is added as a typed
    null and the loads are unioned by name."""
    t = trips(spark, sf_dir, "orders").select("pickup_datetime", "fare_amount")
    old = t.where(F.year("pickup_datetime") < 1998)
    new = t.where(F.year("pickup_datetime") >= 1998).withColumn("cbd_congestion_fee", F.lit(0.75))
    old = C.add_optional_doubles(old, ["cbd_congestion_fee"])
    return old.unionByName(new)


@register("drift_union_cast", Q.with_clauses(Q.TO) + f"""
SELECT pickup_datetime, vendor_id, CAST(passenger_count AS DOUBLE) AS congestion_surcharge
FROM tor WHERE year(pickup_datetime) % 2 = 0
UNION ALL
SELECT pickup_datetime, vendor_id, round(CAST(passenger_count AS DOUBLE) * 0.5, 2) AS congestion_surcharge
FROM tor WHERE year(pickup_datetime) % 2 = 1""")
def drift_union_cast(spark, sf_dir):
    """S12 + P3 + P4: one load encodes the fee as INT and the vendor as INT,
    the other as DOUBLE and LONG; each is cast, then unioned by name."""
    from meterwise.functions.numeric import cast_long, round_double
    from meterwise.sources.readers import union_months
    t = trips(spark, sf_dir, "orders")
    even = t.where(F.year("pickup_datetime") % 2 == 0).select(
        "pickup_datetime", F.col("vendor_id").cast("int").alias("vendor_id"),
        F.col("passenger_count").cast("int").alias("congestion_surcharge"))
    odd = t.where(F.year("pickup_datetime") % 2 == 1).select(
        "pickup_datetime", "vendor_id",
        (F.col("passenger_count").cast("double") * 0.5).alias("congestion_surcharge"))
    norm = [f.select("pickup_datetime", cast_long("vendor_id").alias("vendor_id"),
                     round_double("congestion_surcharge").alias("congestion_surcharge"))
            for f in (even, odd)]
    return union_months(norm)


def _clean_sql(variant: str) -> str:
    rules = Q.base_rules(ORDERS_MAX_MINUTES)
    if variant in ("yellow", "green"):
        rules += Q.TRIP_RULES
    elif variant == "fhvhv":
        rules += [("trip_miles_positive", "trip_distance > 0"),
                  ("trip_miles_max_200", "trip_distance <= 200"),
                  ("base_passenger_fare_positive", "fare_amount > 0")]
    where = " AND ".join(f"({p})" for _, p in rules)
    dec0 = f"CAST(0 AS {Q.DEC})"
    dur = f"trip_duration_sec, {Q.DUR_MIN} AS trip_duration_min"
    if variant == "yellow":
        cols = f"""'yellow' AS taxi_type, vendor_id, pickup_location_id, dropoff_location_id,
       ratecode_id, payment_type, store_and_fwd_flag, {Q.FEATURES}, passenger_count, trip_distance,
       {dur}, fare_amount, {dec0} AS extra, CAST(0.5 AS {Q.DEC}) AS mta_tax, tip_amount, tolls_amount,
       {dec0} AS improvement_surcharge, total_amount, {dec0} AS congestion_surcharge,
       {dec0} AS airport_fee, CAST(NULL AS {Q.DEC}) AS cbd_congestion_fee"""
    elif variant == "green":
        cols = f"""'green' AS taxi_type, vendor_id, pickup_location_id, dropoff_location_id,
       ratecode_id, payment_type, store_and_fwd_flag, CAST(1 AS BIGINT) AS trip_type, {Q.FEATURES},
       passenger_count, trip_distance, {dur}, fare_amount, {dec0} AS extra,
       CAST(0.5 AS {Q.DEC}) AS mta_tax, tip_amount, tolls_amount, {dec0} AS ehail_fee,
       {dec0} AS improvement_surcharge, total_amount, {dec0} AS congestion_surcharge,
       CAST(NULL AS {Q.DEC}) AS cbd_congestion_fee"""
    elif variant == "fhvhv":
        cols = f"""'fhvhv' AS taxi_type, printf('HV%04d', vendor_id) AS hvfhs_license_num,
       printf('B%05d', pickup_location_id) AS dispatching_base_num,
       printf('B%05d', dropoff_location_id) AS originating_base_num,
       pickup_location_id, dropoff_location_id, pickup_datetime AS request_datetime,
       pickup_datetime AS on_scene_datetime, {Q.FEATURES}, trip_distance,
       trip_duration_sec AS trip_time, {dur}, fare_amount AS base_passenger_fare,
       tolls_amount AS tolls, {dec0} AS bcf, {dec0} AS sales_tax, {dec0} AS congestion_surcharge,
       {dec0} AS airport_fee, tip_amount AS tips, fare_amount AS driver_pay,
       CAST(NULL AS {Q.DEC}) AS cbd_congestion_fee, 'N' AS shared_request_flag,
       'N' AS shared_match_flag, 'N' AS wav_request_flag, store_and_fwd_flag AS wav_match_flag"""
    else:
        cols = f"""'fhv' AS taxi_type, printf('B%05d', pickup_location_id) AS dispatching_base_num,
       printf('B%05d', dropoff_location_id) AS affiliated_base_num,
       pickup_location_id, dropoff_location_id, {Q.FEATURES}, {dur},
       CAST(NULL AS VARCHAR) AS sr_flag"""
    return Q.with_clauses(Q.TO, Q.with_duration("tor", "d")) + f"SELECT {cols}\nFROM d WHERE {where}"


def _clean_query(variant):
    def q(spark, sf_dir):
        return cleaned(spark, sf_dir, "orders", variant)
    q.__doc__ = f"P5-P9 + F1-F4: clean the {variant} variant."
    return q


for _key, _variant in (("clean_variant_a", "yellow"), ("clean_variant_b", "green"),
                       ("clean_variant_c", "fhvhv"), ("clean_variant_d", "fhv")):
    register(_key, _clean_sql(_variant))(_clean_query(_variant))


@register("legacy_clean", Q.with_clauses(Q.TE) + """
SELECT CAST(hour(pickup_datetime) AS BIGINT) AS pickup_hour, count(*) AS count
FROM te
WHERE passenger_count > 0 AND trip_distance > 0 AND fare_amount > 0 AND total_amount > 0
GROUP BY 1""")
def legacy_clean(spark, sf_dir):
    """P18 + F5 + A14: the legacy job's four positivity filters and hourly count."""
    raw = FX.as_variant_raw(trips(spark, sf_dir, "events"), "yellow")
    return M.hourly_counts(C.legacy_transform(raw))


def _rules_sql(max_minutes):
    return Q.base_rules(max_minutes) + Q.TRIP_RULES


@register("filter_stats", Q.with_clauses(Q.TO, Q.with_duration("tor", "d")) + f"""
SELECT initial_count, kept_count, initial_count - kept_count AS dropped_count,
       CASE WHEN initial_count > 0 THEN CAST(kept_count AS DOUBLE) * 100.0 / CAST(initial_count AS DOUBLE)
            ELSE 0.0 END AS pass_rate_pct
FROM (SELECT count(*) AS initial_count,
             count(*) FILTER (WHERE {' AND '.join(f'({p})' for _, p in _rules_sql(ORDERS_MAX_MINUTES))}) AS kept_count
      FROM d)""")
def filter_stats(spark, sf_dir):
    """initial / kept / dropped / pass rate in one pass."""
    raw = FX.as_variant_raw(trips(spark, sf_dir, "orders"), "yellow")
    return C.filter_stats(raw, "yellow", ORDERS_MAX_MINUTES)


@register("reject_reasons", Q.with_clauses(Q.TO, Q.with_duration("tor", "d")) + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS rule, count(*) FILTER (WHERE NOT coalesce({p}, false)) AS rejected_count FROM d"
    for n, p in _rules_sql(ORDERS_MAX_MINUTES)))
def reject_reasons(spark, sf_dir):
    """F8: rows failing each named rule."""
    raw = FX.as_variant_raw(trips(spark, sf_dir, "orders"), "yellow")
    return C.reject_reasons(raw, "yellow", ORDERS_MAX_MINUTES)


# ------------------------------------------------------------ fact + dims

@register("fact_ratios", W_TO + f"""
SELECT pickup_datetime, dropoff_datetime, vendor_id, pickup_location_id, fare_amount, tip_amount,
       total_amount, trip_distance, trip_duration_min,
       {Q.ratio('tip_amount', 'total_amount')} AS tip_rate,
       {Q.ratio('fare_amount', 'trip_distance')} AS fare_per_mile,
       {Q.ratio('fare_amount', 'trip_duration_min')} AS fare_per_minute
FROM cl""")
def fact_ratios(spark, sf_dir):
    """Fact rows with the three guarded ratios."""
    return fact(spark, sf_dir, "orders").select(
        "pickup_datetime", "dropoff_datetime", "vendor_id", "pickup_location_id", "fare_amount",
        "tip_amount", "total_amount", "trip_distance", "trip_duration_min",
        "tip_rate", "fare_per_mile", "fare_per_minute")


@register("fact_trip_id_unique", W_TO + """
SELECT count(*) AS row_count, count(*) AS distinct_trip_ids, count(*) AS dense_span,
       count(DISTINCT (pickup_year, pickup_month)) AS months FROM cl""")
def fact_trip_id_unique(spark, sf_dir):
    """P15 (G6), dense ids: unique and gapless per month, the per-month span
    ``max - min + 1`` summed over months equals the row count."""
    f = build_fact(cleaned(spark, sf_dir, "orders"), load_ts=False, money_mode=MODE, ids="dense")
    per_month = f.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("trip_id").alias("d"),
        (F.max("trip_id") - F.min("trip_id") + 1).alias("span"))
    return per_month.agg(F.sum("n").alias("row_count"), F.sum("d").alias("distinct_trip_ids"),
                         F.sum("span").alias("dense_span"), F.count(F.lit(1)).alias("months"))


@register("fact_trip_id_stable", W_TO + """
SELECT count(*) AS rows, count(*) AS distinct_ids, CAST(0 AS BIGINT) AS changed_ids,
       count(*) FILTER (WHERE (pickup_year, pickup_month) <>
         (SELECT (max(pickup_year), max(pickup_month) FILTER (WHERE pickup_year = (SELECT max(pickup_year) FROM cl)))
          FROM cl)) AS ids_before
FROM cl""")
def fact_trip_id_stable(spark, sf_dir):
    """P15 (G6), content ids: ids of all months, built with and without the
    last month; ids that a later load changed are counted (none)."""
    c = cleaned(spark, sf_dir, "orders")
    key = _month_key()
    last = c.agg(F.max(key)).first()[0]  # one number
    before = c.where(key < F.lit(last))
    ids = [build_fact(x, load_ts=False, money_mode=MODE).select("trip_id") for x in (c, before)]
    tagged = (ids[0].withColumns({"now": F.lit(1), "old": F.lit(0)})
              .unionByName(ids[1].withColumns({"now": F.lit(0), "old": F.lit(1)})))
    per_id = tagged.groupBy("trip_id").agg(F.sum("now").alias("now"), F.sum("old").alias("old"))
    return per_id.agg(F.sum("now").alias("rows"), F.count_if(F.col("now") > 0).alias("distinct_ids"),
                      F.count_if((F.col("old") > 0) & (F.col("old") != F.col("now"))).alias("changed_ids"),
                      F.sum("old").alias("ids_before"))


@register("dim_vendor", W_TO + f"""
SELECT DISTINCT vendor_id, {Q.vendor_name('vendor_id')} AS vendor_name FROM cl""")
def dim_vendor(spark, sf_dir):
    """D1 + A15 + U2: distinct vendors with names."""
    return vendor_dim(spark, sf_dir, "orders")


@register("dim_zone", Q.with_clauses(Q.ZONE) + "SELECT * FROM zone")
def dim_zone(spark, sf_dir):
    """Zone dimension (location_id, borough, zone, service_zone)."""
    return zone(spark, sf_dir)


@register("dim_date", W_TO + """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS date_id, d AS date,
       CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month, CAST(day(d) AS BIGINT) AS day,
       CAST(dayofweek(d) + 1 AS BIGINT) AS day_of_week, dayname(d) AS day_name,
       CAST(weekofyear(d) AS BIGINT) AS week_of_year, CAST(quarter(d) AS BIGINT) AS quarter,
       dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(min(pickup_date), max(pickup_date), INTERVAL 1 DAY)) AS DATE) AS d
      FROM cl)""")
def dim_date(spark, sf_dir):
    """D3 + S11: calendar over the span of the cleaned pickup dates."""
    return dim_date_for(cleaned(spark, sf_dir, "orders"), "pickup_date")


@register("dim_time", Q.with_clauses(Q.TE, CL_TE) + """
SELECT h.hour, printf('%02d:00', h.hour) AS hour_label,
       CASE WHEN h.hour < 6 THEN 'night' WHEN h.hour < 10 THEN 'morning_commute'
            WHEN h.hour < 12 THEN 'midday' WHEN h.hour < 14 THEN 'lunch'
            WHEN h.hour < 16 THEN 'afternoon' WHEN h.hour < 20 THEN 'evening_commute'
            ELSE 'night' END AS time_bucket,
       count(cl.pickup_hour) AS trips
FROM (SELECT CAST(range AS BIGINT) AS hour FROM range(24)) h
LEFT JOIN cl ON cl.pickup_hour = h.hour
GROUP BY 1, 2, 3""")
def dim_time(spark, sf_dir):
    """The 24-hour dimension with the trips of each hour."""
    per_hour = (cleaned(spark, sf_dir, "events").groupBy("pickup_hour")
                .agg(F.count(F.lit(1)).alias("trips")))
    d = build_dim_time(spark)
    # per_hour has at most 24 rows (hour of day): a proven broadcast bound.
    j = d.join(F.broadcast(per_hour), d.hour == per_hour.pickup_hour, "left")
    return j.select("hour", "hour_label", "time_bucket",
                    F.coalesce(F.col("trips"), F.lit(0)).alias("trips"))


# ------------------------------------------------------------ monthly + cumulative

def _monthly_sql(entity: str, dim: str) -> str:
    if dim == "vendor":
        head = f"m.vendor_id, COALESCE(vd.vendor_name, 'Unknown') AS vendor_name"
        join = "LEFT JOIN vd ON m.vendor_id IS NOT DISTINCT FROM vd.vendor_id"
        extra = [VD_TE]
    else:
        head = "m.pickup_location_id, z.borough, z.zone, z.service_zone"
        join = "LEFT JOIN zone z ON m.pickup_location_id = z.location_id"
        extra = []
    return head, join, extra


def _monthly_query_sql(entity, dim):
    head, join, extra = _monthly_sql(entity, dim)
    return Q.with_clauses(Q.TO, CL_TO, Q.ZONE, *extra) + f"""
SELECT m.pickup_year AS year, m.pickup_month AS month, m.year_month, {head},
       {', '.join(Q.MONTHLY_METRICS)}
FROM (SELECT year_month, pickup_year, pickup_month, {entity}, {Q.metric_list(Q.MONTHLY_METRICS)}
      FROM cl GROUP BY year_month, pickup_year, pickup_month, {entity}) m
{join}"""


def _cumulative_query_sql(entity, dim):
    head, join, extra = _monthly_sql(entity, dim)
    return Q.with_clauses(Q.TO, CL_TO, Q.ZONE, *extra) + f"""
SELECT m.pickup_year AS year, m.pickup_month AS month, m.year_month, {head},
       {', '.join(Q.MONTHLY_METRICS)}, {', '.join(c for _, c in Q.CUM)}
FROM (SELECT *, {Q.cumulative_cols(entity)}
      FROM (SELECT year_month, pickup_year, pickup_month, {entity}, {Q.metric_list(Q.MONTHLY_METRICS)}
            FROM cl GROUP BY year_month, pickup_year, pickup_month, {entity})) m
{join}"""


@register("monthly_vendor", _monthly_query_sql("vendor_id", "vendor"))
def monthly_vendor(spark, sf_dir):
    """A3 + J3: monthly vendor aggregate."""
    return M.build_metric_mart(fact(spark, sf_dir, "orders"), M.VENDOR_MONTH,
                               vendor_dim(spark, sf_dir, "orders"), MODE, load_ts=False)


@register("monthly_zone", _monthly_query_sql("pickup_location_id", "zone"))
def monthly_zone(spark, sf_dir):
    """A4 + J4: monthly zone aggregate."""
    return M.build_metric_mart(fact(spark, sf_dir, "orders"), M.ZONE_MONTH, zone(spark, sf_dir),
                               MODE, load_ts=False)


@register("cumulative_vendor", _cumulative_query_sql("vendor_id", "vendor"))
def cumulative_vendor(spark, sf_dir):
    """N1 + J3: vendor running totals in calendar order (G1)."""
    return N.build_cumulative_mart(fact(spark, sf_dir, "orders"), M.VENDOR_MONTH,
                                   vendor_dim(spark, sf_dir, "orders"), MODE, load_ts=False)


@register("cumulative_zone", _cumulative_query_sql("pickup_location_id", "zone"))
def cumulative_zone(spark, sf_dir):
    """N2 + J4: zone running totals in calendar order (G1)."""
    return N.build_cumulative_mart(fact(spark, sf_dir, "orders"), M.ZONE_MONTH, zone(spark, sf_dir),
                                   MODE, load_ts=False)


SPLIT = (1999, 1)  # first month treated as "new" by the incremental queries


def _month_key(y="pickup_year", m="pickup_month"):
    return F.col(y) * 12 + F.col(m)


@register("cumulative_incremental", _cumulative_query_sql("vendor_id", "vendor"))
def cumulative_incremental(spark, sf_dir):
    """N3 + J5: months before SPLIT by a full build (the 'previous run'),
    months from SPLIT on from that state plus the new facts only; the union
    must equal the full recompute."""
    f = fact(spark, sf_dir, "orders")
    dim = vendor_dim(spark, sf_dir, "orders")
    k = SPLIT[0] * 12 + SPLIT[1]
    prev = N.build_cumulative_mart(f.where(_month_key() < k), M.VENDOR_MONTH, dim, MODE, load_ts=False)
    new = N.incremental_cumulative(prev, f.where(_month_key() >= k), M.VENDOR_MONTH, dim, MODE,
                                   load_ts=False)
    return prev.unionByName(new)


@register("cumulative_recompute_from", _cumulative_query_sql("pickup_location_id", "zone"))
def cumulative_recompute_from(spark, sf_dir):
    """Recompute zone running totals from SPLIT on, seeded by the state
    before SPLIT; months before SPLIT come from the previous table."""
    f = fact(spark, sf_dir, "orders")
    z = zone(spark, sf_dir)
    full_prev = N.build_cumulative_mart(f, M.ZONE_MONTH, z, MODE, load_ts=False)
    k = SPLIT[0] * 12 + SPLIT[1]
    kept = full_prev.where(_month_key("year", "month") < k)
    redone = N.recompute_from(f, full_prev, M.ZONE_MONTH, z, SPLIT, MODE, load_ts=False)
    return kept.unionByName(redone)


@register("cumulative_continuity", Q.with_clauses(Q.TO, CL_TO) + f"""
, mm AS (SELECT pickup_year, pickup_month, vendor_id, {Q.metric_list(Q.MONTHLY_METRICS)}
         FROM cl GROUP BY pickup_year, pickup_month, vendor_id)
, cu AS (SELECT *, {Q.cumulative_cols('vendor_id')} FROM mm)
, lg AS (SELECT *, {', '.join(f"coalesce(lag({c}) OVER w, 0) AS prev_{c}" for _, c in Q.CUM)}
         FROM cu WINDOW w AS (PARTITION BY vendor_id ORDER BY pickup_year, pickup_month))
SELECT count(*) AS checked_rows,
       count(*) FILTER (WHERE {' OR '.join(f"{c} - prev_{c} <> {m}" for m, c in Q.CUM)}) AS violations
FROM lg""")
def cumulative_continuity(spark, sf_dir):
    """cumulative(t) - cumulative(t-1) = monthly(t) for every metric."""
    cum = N.build_cumulative_mart(fact(spark, sf_dir, "orders"), M.VENDOR_MONTH,
                                  vendor_dim(spark, sf_dir, "orders"), MODE, load_ts=False)
    return N.continuity_summary(cum, "vendor_id")


# ------------------------------------------------------------ roll-ups, top-k

def _vendor_hour_mart_sql() -> str:
    return f"""(SELECT pickup_hour, vendor_id, {Q.metric_list(Q.VENDOR_HOUR_METRICS)}
      FROM cl GROUP BY year_month, pickup_year, pickup_month, pickup_hour, vendor_id)"""


@register("vendor_hour_rollup", Q.with_clauses(Q.TE, CL_TE) + f"""
SELECT pickup_hour, CAST(sum(trip_count) AS BIGINT) AS total_trips,
       round(avg(avg_fare_amount), 6) AS avg_of_avg_fare,
       CAST(sum(total_fare_amount) AS DOUBLE) / CAST(sum(trip_count) AS DOUBLE) AS weighted_avg_fare
FROM {_vendor_hour_mart_sql()} m GROUP BY pickup_hour""")
def vendor_hour_rollup(spark, sf_dir):
    """A10: hour roll-up of the vendor mart (unweighted and weighted fare)."""
    vm = M.build_metric_mart(fact(spark, sf_dir, "events"), M.VENDOR_HOUR,
                             vendor_dim(spark, sf_dir, "events"), MODE, load_ts=False)
    r = M.vendor_hour_rollup(vm)
    return r.withColumn("avg_of_avg_fare", F.round("avg_of_avg_fare", 6))


def _monthly_sql_cte(entity, dim):
    head, join, extra = _monthly_sql(entity, dim)
    return Q.with_clauses(Q.TO, CL_TO, Q.ZONE, *extra) + f""", mart AS (
SELECT m.pickup_year AS year, m.pickup_month AS month, m.year_month, {head},
       {', '.join(Q.MONTHLY_METRICS)}
FROM (SELECT year_month, pickup_year, pickup_month, {entity}, {Q.metric_list(Q.MONTHLY_METRICS)}
      FROM cl GROUP BY year_month, pickup_year, pickup_month, {entity}) m
{join})
"""


def _monthly_vendor_df(spark, sf_dir):
    return M.build_metric_mart(fact(spark, sf_dir, "orders"), M.VENDOR_MONTH,
                               vendor_dim(spark, sf_dir, "orders"), MODE, load_ts=False)


def _monthly_zone_df(spark, sf_dir):
    return M.build_metric_mart(fact(spark, sf_dir, "orders"), M.ZONE_MONTH, zone(spark, sf_dir),
                               MODE, load_ts=False)


@register("vendor_totals", _monthly_sql_cte("vendor_id", "vendor") + f"""
SELECT vendor_name, CAST(sum(monthly_trip_count) AS BIGINT) AS total_trips,
       CAST(sum(monthly_total_amount) AS {Q.SUMDEC}) AS total_revenue
FROM mart GROUP BY vendor_name""")
def vendor_totals(spark, sf_dir):
    """Trips and revenue by vendor name over all months."""
    return M.entity_totals(_monthly_vendor_df(spark, sf_dir), ["vendor_name"], MODE)


_ZONE_TOTALS_SQL = f"""
SELECT pickup_location_id, borough, zone, CAST(sum(monthly_trip_count) AS BIGINT) AS total_trips,
       CAST(sum(monthly_total_amount) AS {Q.SUMDEC}) AS total_revenue
FROM mart GROUP BY pickup_location_id, borough, zone"""


@register("zone_totals", _monthly_sql_cte("pickup_location_id", "zone") + _ZONE_TOTALS_SQL)
def zone_totals(spark, sf_dir):
    """A12 + A13: trips and revenue by zone over all months."""
    return M.entity_totals(_monthly_zone_df(spark, sf_dir), ["pickup_location_id", "borough", "zone"], MODE)


@register("top_zones_revenue", _monthly_sql_cte("pickup_location_id", "zone")
          + f", zt AS ({_ZONE_TOTALS_SQL})\nSELECT * FROM zt ORDER BY total_revenue DESC, "
            "pickup_location_id LIMIT 10")
def top_zones_revenue(spark, sf_dir):
    """K2: top 10 zones by revenue (tie-break on zone id)."""
    t = M.entity_totals(_monthly_zone_df(spark, sf_dir), ["pickup_location_id", "borough", "zone"], MODE)
    return M.top_k(t, "total_revenue", 10, ["pickup_location_id"])


@register("top_zones_trips", _monthly_sql_cte("pickup_location_id", "zone")
          + f", zt AS ({_ZONE_TOTALS_SQL})\nSELECT * FROM zt ORDER BY total_trips DESC, "
            "pickup_location_id LIMIT 10")
def top_zones_trips(spark, sf_dir):
    """K3: top 10 zones by trips (tie-break on zone id)."""
    t = M.entity_totals(_monthly_zone_df(spark, sf_dir), ["pickup_location_id", "borough", "zone"], MODE)
    return M.top_k(t, "total_trips", 10, ["pickup_location_id"])


@register("sample_entities", _monthly_sql_cte("pickup_location_id", "zone") + """
SELECT * FROM mart WHERE pickup_location_id IN
  (SELECT DISTINCT pickup_location_id FROM mart ORDER BY pickup_location_id LIMIT 3)""")
def sample_entities(spark, sf_dir):
    """K4 + K5 + F6: three sampled zones (deterministic order) and all their
    monthly rows through one semi-join."""
    mz = _monthly_zone_df(spark, sf_dir)
    s = M.sample_entities(mz, "pickup_location_id", 3)
    return M.lookup_entities(mz, s, "pickup_location_id")


# ------------------------------------------------------------ daily partials

_PARTIAL_SUMS = {
    "trip_count": "count(*)",
    "passenger_count": "CAST(sum(passenger_count) AS BIGINT)",
    "distance": Q.sum_dec("trip_distance"),
    "duration_min": Q.sum_dec("trip_duration_min"),
    "fare_amount": Q.sum_dec("fare_amount"),
    "tip_amount": Q.sum_dec("tip_amount"),
    "tolls_amount": Q.sum_dec("tolls_amount"),
    "total_amount": Q.sum_dec("total_amount"),
}
_PARTIAL_SQL = f"""(SELECT pickup_date, pickup_year, pickup_month, pickup_day, pickup_hour, pickup_location_id,
         {Q.metric_list(_PARTIAL_SUMS)}
  FROM cl GROUP BY pickup_date, pickup_year, pickup_month, pickup_day, pickup_hour, pickup_location_id)"""


@register("partial_day_mart", Q.with_clauses(Q.TE, CL_TE) + f"SELECT * FROM {_PARTIAL_SQL} p")
def partial_day_mart(spark, sf_dir):
    """Date x hour x zone partial sums (sketch column left out here:
    binary sketches are checked by ``partial_percentiles``)."""
    from meterwise.operators.partial import build_daily_partial
    return build_daily_partial(fact(spark, sf_dir, "events"), money_mode=MODE, sketch=False)


KLL_ERROR = 0.0165  # normalized rank error of a sketch of size 200
_MERGED_SQL = f"""
SELECT strftime(pickup_date, '%Y-%m') AS year_month, pickup_year, pickup_month, pickup_hour, pickup_location_id,
       CAST(sum(trip_count) AS BIGINT) AS trip_count,
       CAST(sum(passenger_count) AS BIGINT) AS total_passenger_count,
       CAST(sum(distance) AS {Q.SUMDEC}) AS total_distance,
       CAST(sum(duration_min) AS {Q.SUMDEC}) AS total_duration_min,
       CAST(sum(fare_amount) AS {Q.SUMDEC}) AS total_fare_amount,
       CAST(sum(tip_amount) AS {Q.SUMDEC}) AS total_tip_amount,
       CAST(sum(tolls_amount) AS {Q.SUMDEC}) AS total_tolls_amount,
       CAST(sum(total_amount) AS {Q.SUMDEC}) AS total_amount,
       CAST(sum(distance) AS DOUBLE) / CAST(sum(trip_count) AS DOUBLE) AS avg_distance,
       CAST(sum(duration_min) AS DOUBLE) / CAST(sum(trip_count) AS DOUBLE) AS avg_duration_min,
       CAST(sum(fare_amount) AS DOUBLE) / CAST(sum(trip_count) AS DOUBLE) AS avg_fare_amount,
       CAST(sum(tip_amount) AS DOUBLE) / CAST(sum(trip_count) AS DOUBLE) AS avg_tip_amount,
       CAST(sum(total_amount) AS DOUBLE) / CAST(sum(trip_count) AS DOUBLE) AS avg_total_amount
FROM {_PARTIAL_SQL} p
GROUP BY 1, pickup_year, pickup_month, pickup_hour, pickup_location_id"""


@register("partial_merged_mart", Q.with_clauses(Q.TE, CL_TE) + _MERGED_SQL)
def partial_merged_mart(spark, sf_dir):
    """Monthly hour x zone mart merged from daily partials (additive
    columns; averages from sums and counts, never averages of averages)."""
    from meterwise.operators.partial import build_daily_partial, merge_partials
    p = build_daily_partial(fact(spark, sf_dir, "events"), money_mode=MODE, sketch=False)
    return merge_partials(p, money_mode=MODE, quantiles=False)


@register("partial_percentiles", Q.with_clauses(Q.TE, CL_TE) + """
SELECT count(*) AS groups, count(*) AS p50_within, count(*) AS p90_within
FROM (SELECT DISTINCT year_month, pickup_hour, pickup_location_id FROM cl) g""")
def partial_percentiles(spark, sf_dir):
    """A17 percentiles: KLL sketches per day merged per month.  The true ranks
    of the answers, counted over the trips, must hold the asked rank within
    twice the error that the sketch size documents (1.65% at k=200)."""
    from meterwise.operators.partial import build_daily_partial, merge_partials
    f = fact(spark, sf_dir, "events")
    merged = merge_partials(build_daily_partial(f, money_mode=MODE), money_mode=MODE).select(
        "year_month", "pickup_hour", "pickup_location_id", "trip_count",
        F.col("p50_duration_min").alias("kll_p50"), F.col("p90_duration_min").alias("kll_p90"))
    grain = ["year_month", "pickup_hour", "pickup_location_id"]
    # No hint: one row per group, AQE broadcasts it when measured small.
    j = f.select(*grain, F.col("trip_duration_min").cast("double").alias("d")).join(merged, grain)
    n = F.count(F.lit(1))
    ranks = j.groupBy(*grain).agg(*[
        ((F.count_if(F.col("d") < F.col(q)) / n <= r + 2 * KLL_ERROR)
         & (F.count_if(F.col("d") <= F.col(q)) / n >= r - 2 * KLL_ERROR)).alias(q)
        for q, r in (("kll_p50", 0.5), ("kll_p90", 0.9))])
    return ranks.agg(n.alias("groups"), F.count_if("kll_p50").alias("p50_within"),
                     F.count_if("kll_p90").alias("p90_within"))


# ------------------------------------------------------------ quality

@register("reconcile_mart", _monthly_sql_cte("pickup_location_id", "zone") + f"""
SELECT f.fact_rows, m.mart_rows, m.mart_trip_sum, f.fact_total_amount, m.mart_total_amount,
       abs(coalesce(f.fact_total_amount, 0) - coalesce(m.mart_total_amount, 0)) AS amount_diff,
       f.fact_rows = coalesce(m.mart_trip_sum, 0)
         AND abs(coalesce(f.fact_total_amount, 0) - coalesce(m.mart_total_amount, 0)) < 0.01 AS passed
FROM (SELECT count(*) AS fact_rows, CAST(sum(total_amount) AS {Q.SUMDEC}) AS fact_total_amount FROM cl) f,
     (SELECT count(*) AS mart_rows, CAST(sum(monthly_trip_count) AS BIGINT) AS mart_trip_sum,
             CAST(sum(monthly_total_amount) AS {Q.SUMDEC}) AS mart_total_amount FROM mart) m""")
def reconcile_mart(spark, sf_dir):
    """V1 (+ V2's monthly form): mart trip sum = fact rows, totals agree."""
    from meterwise.operators.quality import validate_mart
    return validate_mart(fact(spark, sf_dir, "orders"), _monthly_zone_df(spark, sf_dir),
                         count_col="monthly_trip_count", amount_col="monthly_total_amount")


@register("reconcile_by_month", _monthly_sql_cte("pickup_location_id", "zone") + f"""
SELECT coalesce(f.year, m.year) AS year, coalesce(f.month, m.month) AS month,
       coalesce(f.fact_trips, 0) AS fact_trips, coalesce(m.mart_trips, 0) AS mart_trips,
       f.fact_amount, m.mart_amount,
       coalesce(f.fact_amount, 0) - coalesce(m.mart_amount, 0) AS amount_diff
FROM (SELECT pickup_year AS year, pickup_month AS month, count(*) AS fact_trips,
             CAST(sum(total_amount) AS {Q.SUMDEC}) AS fact_amount FROM cl GROUP BY 1, 2) f
FULL JOIN (SELECT year, month, CAST(sum(monthly_trip_count) AS BIGINT) AS mart_trips,
                  CAST(sum(monthly_total_amount) AS {Q.SUMDEC}) AS mart_amount FROM mart GROUP BY 1, 2) m
  ON f.year = m.year AND f.month = m.month""")
def reconcile_by_month(spark, sf_dir):
    """V6: fact vs mart per month (full outer join of two month aggregates)."""
    from meterwise.operators.quality import reconcile_by_month as rbm
    return rbm(fact(spark, sf_dir, "orders"), _monthly_zone_df(spark, sf_dir),
               "monthly_trip_count", "monthly_total_amount")


@register("quality_cleaned", W_TO + """
SELECT count(*) AS rows,
       count(*) FILTER (WHERE pickup_datetime IS NULL OR dropoff_datetime IS NULL) AS null_times,
       count(*) FILTER (WHERE dropoff_datetime <= pickup_datetime) AS dropoff_not_after_pickup,
       count(*) FILTER (WHERE trip_duration_min <= 0) AS nonpositive_duration,
       count(*) FILTER (WHERE trip_distance <= 0) AS nonpositive_distance,
       count(*) FILTER (WHERE fare_amount <= 0) AS nonpositive_fare,
       count(*) FILTER (WHERE total_amount <= 0) AS nonpositive_total,
       count(*) FILTER (WHERE passenger_count <= 0) AS nonpositive_passengers
FROM cl""")
def quality_cleaned(spark, sf_dir):
    """V3 + V4: the cleaned layer's rule report (violations must be 0)."""
    from meterwise.operators.quality import cleaned_rules, require_rows
    c = cleaned(spark, sf_dir, "orders")
    require_rows(c, "cleaned trips")
    return cleaned_rules(c)


@register("quality_fact", W_TO + f"""
SELECT count(*) AS cleaned_rows, count(*) AS fact_rows,
       count(*) FILTER (WHERE trip_duration_min <= 0) AS nonpositive_duration,
       count(*) FILTER (WHERE {Q.ratio('tip_amount', 'total_amount')} < 0) AS negative_tip_rate,
       count(*) FILTER (WHERE {Q.ratio('fare_amount', 'trip_distance')} <= 0) AS nonpositive_fare_per_mile
FROM cl""")
def quality_fact(spark, sf_dir):
    """V5: cleaned -> fact rules."""
    from meterwise.operators.quality import fact_rules
    return fact_rules(cleaned(spark, sf_dir, "orders"), fact(spark, sf_dir, "orders"))


@register("mart_key_nulls", Q.with_clauses(Q.TE, CL_TE) + """
SELECT count(*) AS rows, count(*) FILTER (WHERE year_month IS NULL) AS null_year_month,
       count(*) FILTER (WHERE pickup_hour IS NULL) AS null_pickup_hour,
       count(*) FILTER (WHERE pickup_location_id IS NULL) AS null_pickup_location_id
FROM (SELECT DISTINCT year_month, pickup_year, pickup_month, pickup_hour, pickup_location_id FROM cl)""")
def mart_key_nulls(spark, sf_dir):
    """V7: null grain keys in the hour x zone mart."""
    from meterwise.operators.quality import key_nulls
    mart = M.build_metric_mart(fact(spark, sf_dir, "events"), M.ZONE_HOUR, zone(spark, sf_dir),
                               MODE, load_ts=False)
    return key_nulls(mart, ["year_month", "pickup_hour", "pickup_location_id"])


@register("dim_coverage", W_TO + """
SELECT count(*) AS rows, count(*) FILTER (WHERE vendor_id NOT IN (1, 2) OR vendor_id IS NULL) AS unmatched_rows,
       count(DISTINCT vendor_id) FILTER (WHERE vendor_id NOT IN (1, 2)) AS unmatched_keys
FROM cl""")
def dim_coverage(spark, sf_dir):
    """Fact vendor codes missing from the published vendor list."""
    return M.dim_coverage(fact(spark, sf_dir, "orders"), static_vendor_dim(spark), "vendor_id", "vendor_id")


@register("partition_outliers", W_TO + """
, c AS (SELECT pickup_year AS year, pickup_month AS month, count(*) AS rows FROM cl GROUP BY 1, 2)
SELECT c.year, c.month, c.rows, m.median_rows, c.rows < m.median_rows * 0.1 AS is_outlier
FROM c, (SELECT quantile_disc(rows, 0.5) AS median_rows FROM c) m""")
def partition_outliers(spark, sf_dir):
    """V9: months with implausibly few rows against the median month."""
    from meterwise.operators.quality import partition_outliers as po
    c = (cleaned(spark, sf_dir, "orders")
         .groupBy(F.col("pickup_year").alias("year"), F.col("pickup_month").alias("month"))
         .agg(F.count(F.lit(1)).alias("rows")))
    return po(c)


_EQ_DIRECT = f"""SELECT year_month, pickup_year, pickup_month, pickup_hour, pickup_location_id,
       count(*) AS trip_count, {Q.sum_dec('total_amount')} AS total_amount
  FROM cl GROUP BY year_month, pickup_year, pickup_month, pickup_hour, pickup_location_id"""
_EQ_PARTIAL = f"""SELECT strftime(pickup_date, '%Y-%m') AS year_month, pickup_year, pickup_month, pickup_hour,
       pickup_location_id, CAST(sum(trip_count) AS BIGINT) AS trip_count,
       CAST(sum(total_amount) AS {Q.SUMDEC}) AS total_amount
  FROM {_PARTIAL_SQL} p GROUP BY 1, pickup_year, pickup_month, pickup_hour, pickup_location_id"""


@register("equivalence_two_paths", Q.with_clauses(Q.TE, CL_TE) + f"""
SELECT (SELECT count(*) FROM ({_EQ_DIRECT})) AS rows_a,
       (SELECT count(*) FROM ({_EQ_PARTIAL})) AS rows_b,
       (SELECT count(*) FROM (({_EQ_DIRECT}) EXCEPT ALL ({_EQ_PARTIAL}))) AS left_only,
       (SELECT count(*) FROM (({_EQ_PARTIAL}) EXCEPT ALL ({_EQ_DIRECT}))) AS right_only""")
def equivalence_two_paths(spark, sf_dir):
    """V8: the hour x zone mart built directly and through daily partials
    are equal as multisets (exceptAll both ways)."""
    from meterwise.operators.partial import build_daily_partial, merge_partials
    from meterwise.operators.quality import equivalence
    f = fact(spark, sf_dir, "events")
    cols = ["year_month", "pickup_year", "pickup_month", "pickup_hour", "pickup_location_id",
            "trip_count", "total_amount"]
    direct = M.aggregate(f, M.ZONE_HOUR, MODE).select(*cols)
    merged = merge_partials(build_daily_partial(f, money_mode=MODE, sketch=False),
                            money_mode=MODE, quantiles=False).select(*cols)
    return equivalence(direct, merged)


# ------------------------------------------------------------ skew

@register("skew_report", W_TO + """
SELECT pickup_location_id, count(*) AS rows,
       CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM cl) AS DOUBLE) AS share
FROM cl GROUP BY pickup_location_id""")
def skew_report(spark, sf_dir):
    """Rows and share of rows per zone key."""
    from meterwise.operators.skew import key_distribution
    return key_distribution(fact(spark, sf_dir, "orders"), "pickup_location_id")


@register("salted_aggregate", W_TO + f"""
SELECT vendor_id, count(*) AS rows, {Q.sum_dec('total_amount')} AS sum_total_amount
FROM cl GROUP BY vendor_id""")
def salted_aggregate(spark, sf_dir):
    """Two-phase salted aggregation by vendor (same result as a plain one)."""
    from meterwise.operators.skew import salted_aggregate as sa
    f = fact(spark, sf_dir, "orders")
    out = sa(f, ["vendor_id"], ["total_amount"], salt_buckets=16,
             salt_cols=["pickup_datetime", "dropoff_datetime", "fare_amount", "pickup_location_id"])
    return out.withColumn("sum_total_amount", F.col("sum_total_amount").cast(M.SUM_DECIMAL))


# ------------------------------------------------------------ sources, sinks, months

def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location."""
    import uuid
    from meterwise.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/meterwise/{name}-{uuid.uuid4().hex[:12]}"


def staged(spark: SparkSession, df: DataFrame, name: str, *partition_cols: str) -> DataFrame:
    """``df`` written once and read back, for queries that read it several times:
    the joins behind it run once.  With ``partition_cols``, readers of some
    partitions read no others."""
    from meterwise.sources.writers import write_partitioned
    path = scratch(spark, name)
    write_partitioned(df, path, partition_cols, mode="static")
    return spark.read.schema(df.schema).parquet(path)


COVER_FROM, COVER_TO = (1994, 6), (2002, 3)


@register("month_coverage", W_TO + f"""
, req AS (SELECT CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month
          FROM (SELECT unnest(generate_series(DATE '{COVER_FROM[0]}-{COVER_FROM[1]:02d}-01',
                DATE '{COVER_TO[0]}-{COVER_TO[1]:02d}-01', INTERVAL 1 MONTH)) AS d))
, av AS (SELECT DISTINCT pickup_year AS year, pickup_month AS month FROM cl)
SELECT r.year, r.month, CASE WHEN a.year IS NOT NULL THEN 'matched' ELSE 'missing' END AS status
FROM req r LEFT JOIN av a ON r.year = a.year AND r.month = a.month""")
def month_coverage(spark, sf_dir):
    """S8 + S9 + S11 + U3: requested month range against the months present."""
    from meterwise.sources.months import month_coverage as mc, month_range, months_of
    avail = months_of(cleaned(spark, sf_dir, "orders"), "pickup_year", "pickup_month")
    return mc(month_range(spark, COVER_FROM, COVER_TO), avail)


PRUNE_MONTHS = [(1996, 1), (1996, 2), (1996, 3)]
_PRUNE_WHERE = " OR ".join(f"(pickup_year = {y} AND pickup_month = {m})" for y, m in PRUNE_MONTHS)


@register("pruned_read", W_TO + f"""
SELECT pickup_year AS year, pickup_month AS month, pickup_datetime, vendor_id, pickup_location_id,
       fare_amount, total_amount
FROM cl WHERE {_PRUNE_WHERE}""")
def pruned_read(spark, sf_dir):
    """S10 + S14 + W3/W4: write a year/month partitioned layer, read three
    months back through a partition filter (directory pruning)."""
    from meterwise.sources.readers import read_table
    from meterwise.sources.writers import write_partitioned
    path = scratch(spark, "pruned")
    c = cleaned(spark, sf_dir, "orders").withColumns({"year": F.col("pickup_year"), "month": F.col("pickup_month")})
    write_partitioned(c, path, ("year", "month"), mode="static")
    back = read_table(spark, path, PRUNE_MONTHS)
    return back.select("year", "month", "pickup_datetime", "vendor_id", "pickup_location_id",
                       "fare_amount", "total_amount")


@register("overwrite_dynamic_safe", W_TO + """
SELECT pickup_year AS src_year, pickup_month AS src_month, pickup_year, pickup_month, count(*) AS rows
FROM cl GROUP BY pickup_year, pickup_month
UNION ALL
SELECT CAST(1996 AS BIGINT), CAST(2 AS BIGINT), pickup_year, pickup_month, count(*)
FROM cl WHERE pickup_year = 1996 AND pickup_month = 1 AND payment_type = 1
GROUP BY pickup_year, pickup_month""")
def overwrite_dynamic_safe(spark, sf_dir):
    """W2 + W8 (G3): every month is loaded, then one February load - which
    also carries stray January rows - is loaded twice.  Partitioning by the source
    month keeps January intact and the rerun idempotent."""
    from meterwise.sources.writers import save_month, write_partitioned
    path = scratch(spark, "loads")
    c = staged(spark, cleaned(spark, sf_dir, "orders"), "trips")  # read by three loads
    feb = c.where((F.col("pickup_year") == 1996)
                  & ((F.col("pickup_month") == 2)
                     | ((F.col("pickup_month") == 1) & (F.col("payment_type") == 1))))
    every = c.withColumns({"src_year": F.col("pickup_year"), "src_month": F.col("pickup_month")})
    write_partitioned(every, path, ("src_year", "src_month"), mode="static")
    save_month(feb, path, 1996, 2)
    save_month(feb, path, 1996, 2)
    back = spark.read.parquet(path)
    return back.groupBy("src_year", "src_month", "pickup_year", "pickup_month").agg(
        F.count(F.lit(1)).alias("rows"))


@register("compacted_output", W_TO + f"""
SELECT pickup_year AS year, pickup_month AS month, count(*) AS rows,
       {Q.sum_dec('total_amount')} AS amount, CAST(1 AS BIGINT) AS files
FROM cl GROUP BY 1, 2""")
def compacted_output(spark, sf_dir):
    """A table written with 4 files per month is compacted to one file
    per month; rows and amounts are unchanged."""
    from meterwise.sources.writers import compact, write_partitioned
    src, dst = scratch(spark, "many"), scratch(spark, "compact")
    write_partitioned(fact(spark, sf_dir, "orders"), src, ("year", "month"), mode="static",
                      files_per_partition=4)
    compact(spark, src, dst, ("year", "month"), files_per_partition=1)
    back = spark.read.parquet(dst).select("year", "month", "total_amount",
                                          F.col("_metadata.file_path").alias("file"))
    return back.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_amount").cast(M.SUM_DECIMAL).alias("amount"),
        F.count_distinct("file").alias("files"))


@register("catalog_partitions", W_TO + """
SELECT pickup_year AS year, pickup_month AS month, count(*) AS rows FROM cl GROUP BY 1, 2""")
def catalog_partitions(spark, sf_dir):
    """External partitioned table; every month registered with
    ALTER TABLE ... ADD PARTITION (no full MSCK listing)."""
    import uuid
    from meterwise.sources.catalog import add_month_partition, register_table
    from meterwise.sources.writers import write_partitioned
    path = scratch(spark, "catalog")
    c = cleaned(spark, sf_dir, "orders").withColumns({"year": F.col("pickup_year"), "month": F.col("pickup_month")})
    write_partitioned(c, path, ("year", "month"), mode="static")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in c.drop("year", "month").schema.fields)
    name = f"mw_cleaned_{uuid.uuid4().hex[:10]}"
    register_table(spark, name, path, ddl + ", year INT, month INT")
    months = spark.read.parquet(path).select("year", "month").distinct().collect()  # folder names
    for y, m in sorted((r["year"], r["month"]) for r in months):
        add_month_partition(spark, name, path, y, m)
    return spark.table(name).groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


@register("table_profile", W_TE + """
SELECT count(*) AS rows,
       min(fare_amount) AS min_fare_amount, max(fare_amount) AS max_fare_amount,
       count(*) FILTER (WHERE fare_amount IS NULL) AS nulls_fare_amount,
       min(trip_duration_min) AS min_trip_duration_min, max(trip_duration_min) AS max_trip_duration_min,
       count(*) FILTER (WHERE trip_duration_min IS NULL) AS nulls_trip_duration_min,
       min(pickup_hour) AS min_pickup_hour, max(pickup_hour) AS max_pickup_hour,
       count(*) FILTER (WHERE pickup_hour IS NULL) AS nulls_pickup_hour
FROM cl""")
def table_profile(spark, sf_dir):
    """S13 + M2: row count and per-column min / max / nulls in one pass."""
    from meterwise.operators.quality import profile
    return profile(cleaned(spark, sf_dir, "events"), ["fare_amount", "trip_duration_min", "pickup_hour"])


# ------------------------------------------------------------ layered monthly runs

NEW_MONTHS = 2  # the latest months arrive as monthly runs after a backfill of the rest


def _layered_run(spark, sf_dir):
    """History by backfill, then the latest months by monthly runs.

    Monthly source files for every month are derived from the tables; all
    but the last ``NEW_MONTHS`` months go through :func:`backfill`, the last
    ones through :func:`run_month` each (incremental fact, dims and marts,
    running totals seeded from the backfilled state).  Every row of the
    tables flows through the layers.
    """
    from meterwise.plans.layers import Layout, backfill, run_month
    from meterwise.sources.months import month_paths
    from meterwise.sources.readers import month_filter
    root = scratch(spark, "layers")
    lay = Layout(root)
    src = write_monthly_sources(spark, sf_dir, root)
    # Folder listing only (partition columns): a calendar-sized result.
    months = [(r["year"], r["month"]) for r in spark.read.parquet(src).select("year", "month").distinct()
              .orderBy(F.col("year").desc(), F.col("month").desc()).limit(NEW_MONTHS).collect()]
    new = sorted(months)
    z = zone(spark, sf_dir)
    backfill(spark, lay, src, z, MODE, ORDERS_MAX_MINUTES, source_filter=~month_filter(new))
    for y, m in new:
        run_month(spark, lay, month_paths(src, [(y, m)], padded=False), y, m, z, MODE, ORDERS_MAX_MINUTES)
    return lay


_RUN_LOG_SQL = Q.with_clauses(Q.TO, CL_TO) + f"""
, rc AS (SELECT CAST(year(pickup_datetime) AS BIGINT) AS y, CAST(month(pickup_datetime) AS BIGINT) AS m,
                count(*) AS n FROM tor GROUP BY 1, 2)
, lm AS (SELECT * FROM rc ORDER BY y DESC, m DESC LIMIT {NEW_MONTHS})
, cc AS (SELECT pickup_year AS y, pickup_month AS m, count(*) AS n FROM cl GROUP BY 1, 2)
, mm AS (SELECT pickup_year AS y, pickup_month AS m,
         CAST(count(DISTINCT (pickup_hour, pickup_location_id)) + count(DISTINCT pickup_location_id)
              + count(DISTINCT (pickup_hour, vendor_id)) + count(DISTINCT vendor_id) AS BIGINT) AS mart_n
       FROM cl GROUP BY 1, 2)
, a AS (SELECT rc.y, rc.m, rc.n AS raw_n, coalesce(cc.n, 0) AS cl_n, coalesce(mm.mart_n, 0) AS mart_n,
               printf('%04d-%02d', rc.y, rc.m) AS ym, lm.n IS NOT NULL AS is_new
        FROM rc LEFT JOIN cc ON rc.y = cc.y AND rc.m = cc.m LEFT JOIN mm ON rc.y = mm.y AND rc.m = mm.m
        LEFT JOIN lm ON rc.y = lm.y AND rc.m = lm.m)
, j AS (SELECT * FROM a WHERE is_new)
, h AS (SELECT CAST(sum(raw_n) AS BIGINT) AS raw_n, CAST(sum(cl_n) AS BIGINT) AS cl_n,
               CAST(sum(mart_n) AS BIGINT) AS mart_n FROM a WHERE NOT is_new)
SELECT 'raw' AS layer, ym AS months, CAST(NULL AS BIGINT) AS rows_in, raw_n AS rows_out, 'ok' AS status FROM j
UNION ALL SELECT 'cleaned', ym, raw_n, cl_n, 'ok' FROM j
UNION ALL SELECT 'fact', CASE WHEN cl_n > 0 THEN ym ELSE '' END, cl_n, cl_n, 'ok' FROM j
UNION ALL SELECT 'mart', CASE WHEN cl_n > 0 THEN ym ELSE '' END, cl_n, mart_n, 'ok' FROM j
UNION ALL SELECT 'validate', ym, cl_n, cl_n, 'ok' FROM j WHERE cl_n > 0
UNION ALL SELECT 'raw', '', NULL, raw_n, 'ok' FROM h
UNION ALL SELECT 'cleaned', '', raw_n, cl_n, 'ok' FROM h
UNION ALL SELECT 'fact', '', cl_n, cl_n, 'ok' FROM h
UNION ALL SELECT 'mart', '', cl_n, mart_n, 'ok' FROM h
UNION ALL SELECT 'validate', '', cl_n, cl_n, 'ok' FROM h"""


@register("run_log", _RUN_LOG_SQL)
def run_log(spark, sf_dir):
    """O1-O4 + W11 + M1 + V1: after a backfill, the latest months run
    through every layer; the run log holds one record per layer and run, the
    backfill included, and a validation record read from the written tables."""
    lay = _layered_run(spark, sf_dir)
    return spark.read.parquet(lay.run_log).select("layer", "months", "rows_in", "rows_out", "status")


@register("layered_zone_cumulative", _cumulative_query_sql("pickup_location_id", "zone"))
def layered_zone_cumulative(spark, sf_dir):
    """O2-O4 + N4: the zone running-total mart as written by a backfill plus
    monthly runs (each seeded from the state before its month), read back."""
    lay = _layered_run(spark, sf_dir)
    return spark.read.parquet(lay.mart("zone_cumulative")).drop("created_at", "updated_at")


@register("layered_fact_ids", Q.with_clauses(Q.TO, CL_TO) + f"""
SELECT pickup_year AS year, pickup_month AS month, count(*) AS rows, count(*) AS distinct_ids,
       {Q.sum_dec('total_amount')} AS amount
FROM cl GROUP BY 1, 2""")
def layered_fact_ids(spark, sf_dir):
    """P15 on the written fact: ids unique in every month."""
    lay = _layered_run(spark, sf_dir)
    f = spark.read.parquet(lay.fact)
    return f.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("trip_id").alias("distinct_ids"),
        F.sum("total_amount").cast(M.SUM_DECIMAL).alias("amount"))


@bounded_writes
def write_monthly_sources(spark, sf_dir, root: str) -> str:
    """Monthly source files (yellow spelling) derived from the tables, one
    folder per pickup month, written in one job."""
    src = f"{root}/source/yellow"
    raw = FX.as_variant_raw(by_pickup(trips(spark, sf_dir, "orders")), "yellow")
    (raw.withColumns({"year": F.year("tpep_pickup_datetime"), "month": F.month("tpep_pickup_datetime")})
     .write.partitionBy("year", "month").mode("overwrite").parquet(src))
    return src


def by_pickup(trips_view: DataFrame, *parts: str) -> DataFrame:
    """Trips clustered by parts of their pickup time (default year and month), so that a write
    task holds few folders.  A view is clustered before it is spelled as a variant: fewer columns move."""
    at = {"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")}
    parts = parts or ("year", "month")
    return trips_view.withColumns({p: at[p] for p in parts}).hint("rebalance", *parts)


def run_backfill(spark, sf_dir):
    from meterwise.plans.layers import Layout, backfill
    root = scratch(spark, "backfill")
    src = write_monthly_sources(spark, sf_dir, root)
    lay = Layout(root)
    metrics = backfill(spark, lay, src, zone(spark, sf_dir), MODE, ORDERS_MAX_MINUTES)
    return lay, metrics


@register("backfill_vendor_cumulative", _cumulative_query_sql("vendor_id", "vendor"))
def backfill_vendor_cumulative(spark, sf_dir):
    """O4 backfill: all months through raw, cleaned, fact (with ids), dims
    and marts in one job per layer; the written vendor running-total mart."""
    lay, _ = run_backfill(spark, sf_dir)
    return spark.read.parquet(lay.mart("vendor_cumulative")).drop("created_at", "updated_at")


# ------------------------------------------------------------ strategies, CSV, skew summary

@register("hour_zone_mart_merge_join", _zone_hour_sql(W_TE))
def hour_zone_mart_merge_join(spark, sf_dir):
    """The flagship mart with the dimension join forced to sort-merge
    (the comparison run of the join-strategy option); same result."""
    return M.build_metric_mart(fact(spark, sf_dir, "events"), M.ZONE_HOUR, zone(spark, sf_dir),
                               money_mode=MODE, load_ts=False, strategy="merge")


@register("zone_lookup_csv", Q.with_clauses(Q.ZONE) + "SELECT * FROM zone")
def zone_lookup_csv(spark, sf_dir):
    """S1 (CSV branch) + S7 + D2: the zone lookup written as a headed CSV in
    the published column spelling, read back with an explicit schema."""
    from meterwise.operators.dims import build_dim_zone
    from meterwise.sources.readers import read_zone_lookup
    path = scratch(spark, "zone_lookup_csv")
    (zone(spark, sf_dir).select(F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"),
                                F.col("zone").alias("Zone"), "service_zone")
     .coalesce(1).write.option("header", "true").csv(path))
    return build_dim_zone(read_zone_lookup(spark, path))


@register("split_mart_by_zone", _zone_hour_sql(W_TE))
def split_mart_by_zone(spark, sf_dir):
    """A18: "one mart per zone" as one job - the mart written partitioned by
    zone (one folder per entity), then read back whole."""
    from meterwise.operators.partial import split_by_entity
    from meterwise.sources.writers import write_partitioned
    path = scratch(spark, "split_mart")
    mart = M.build_metric_mart(fact(spark, sf_dir, "events"), M.ZONE_HOUR, zone(spark, sf_dir),
                               money_mode=MODE, load_ts=False)
    write_partitioned(split_by_entity(mart, "pickup_location_id"), path, ("pickup_location_id",),
                      mode="static", cluster=False)
    back = spark.read.parquet(path)
    return back.select(*mart.columns)


@register("skew_summary", W_TO + """
, k AS (SELECT pickup_location_id, count(*) AS rows FROM cl GROUP BY 1)
, s AS (SELECT list_sort(list(rows)) AS xs, count(*) AS n, sum(rows) AS total, max(rows) AS mx FROM k)
SELECT n AS keys, CAST(total AS BIGINT) AS total_rows, mx AS max_rows,
       xs[CAST(ceil(0.5 * n) AS BIGINT)] AS p50_rows, xs[CAST(ceil(0.95 * n) AS BIGINT)] AS p95_rows,
       CAST(mx AS DOUBLE) / CAST(total AS DOUBLE) AS max_share,
       CAST(mx AS DOUBLE) / CAST(xs[CAST(ceil(0.5 * n) AS BIGINT)] AS DOUBLE) AS max_to_median
FROM s""")
def skew_summary(spark, sf_dir):
    """Keys, max / p50 / p95 rows per key and the max-to-median ratio."""
    from meterwise.operators.skew import skew_summary as ss
    return ss(fact(spark, sf_dir, "orders"), "pickup_location_id")


@register("validate_cumulative_vendor", _cumulative_query_sql("vendor_id", "vendor").replace(
    "\nSELECT m.pickup_year AS year", ", cum AS (\nSELECT m.pickup_year AS year", 1) + f""")
, lg AS (SELECT *, {', '.join(f"coalesce(lag({c}) OVER w, 0) AS prev_{c}" for _, c in Q.CUM)}
         FROM cum WINDOW w AS (PARTITION BY vendor_id ORDER BY year, month))
, f AS (SELECT count(*) AS fact_rows, CAST(sum(total_amount) AS {Q.SUMDEC}) AS fact_total_amount FROM cl)
, m AS (SELECT count(*) AS mart_rows, CAST(sum(monthly_trip_count) AS BIGINT) AS mart_trip_sum,
               CAST(sum(monthly_total_amount) AS {Q.SUMDEC}) AS mart_total_amount,
               count(*) AS checked_rows,
               count(*) FILTER (WHERE {' OR '.join(f"{c} - prev_{c} <> {mm}" for mm, c in Q.CUM)}) AS violations
        FROM lg)
SELECT f.fact_rows, m.mart_rows, m.mart_trip_sum, f.fact_total_amount, m.mart_total_amount,
       abs(f.fact_total_amount - m.mart_total_amount) AS amount_diff,
       m.checked_rows, m.violations,
       f.fact_rows = m.mart_trip_sum AND abs(f.fact_total_amount - m.mart_total_amount) < 0.01
         AND m.violations = 0 AS passed
FROM f, m""")
def validate_cumulative_vendor(spark, sf_dir):
    """V2: the cumulative mart's monthly columns reconcile with the fact and
    every running total continues the previous month's."""
    from meterwise.operators.quality import validate_cumulative
    f = staged(spark, fact(spark, sf_dir, "orders"), "fact")  # read for the dimension, the mart and the totals
    cum = N.build_cumulative_mart(f, M.VENDOR_MONTH, build_dim_vendor(f), MODE, load_ts=False)
    return validate_cumulative(f, cum, "vendor_id")


@register("cumulative_zone_from_hourly", _cumulative_query_sql("pickup_location_id", "zone"))
def cumulative_zone_from_hourly(spark, sf_dir):
    """N2 rolled up from the hour x zone mart (exact in decimal mode): the
    running totals cost no pass over the fact."""
    z = zone(spark, sf_dir)
    hourly = M.build_metric_mart(fact(spark, sf_dir, "orders"), M.ZONE_HOUR, z, MODE, load_ts=False)
    return N.cumulative_from_hourly(hourly, M.ZONE_MONTH, z, MODE, load_ts=False)


@register("hour_zone_mart_reference_rounding")
def hour_zone_mart_reference_rounding(spark, sf_dir):
    """A1 in the reference's own arithmetic (double amounts, sums and
    averages rounded to 2 dp, ratios rounded).  Rounding a double is not
    portable between engines (finding G12), so this form has a row check
    only; ``hour_zone_mart_rounding_check`` holds it against the exact form."""
    raw = FX.as_variant_raw(FX.trips_events(spark, sf_dir, "double"), "yellow")
    cl = C.clean(raw, "yellow", money_mode="double", max_minutes=EVENTS_MAX_MINUTES, load_ts=False)
    f = build_fact(cl, with_ids=False, load_ts=False, money_mode="double")
    return M.build_metric_mart(f, M.ZONE_HOUR, zone(spark, sf_dir), money_mode="double", load_ts=False)


@register("hour_zone_mart_rounding_check", W_TE + """
SELECT count(*) AS groups, count(*) AS within_a_cent
FROM (SELECT DISTINCT year_month, pickup_hour, pickup_location_id FROM cl) g""")
def hour_zone_mart_rounding_check(spark, sf_dir):
    """A1 in both arithmetics: groups, and groups whose rounded sums and
    averages are within a cent of the exact ones."""
    rounded, z = hour_zone_mart_reference_rounding(spark, sf_dir), zone(spark, sf_dir)
    exact = M.build_metric_mart(fact(spark, sf_dir, "events"), M.ZONE_HOUR, z, money_mode=MODE, load_ts=False)
    grain = ["year_month", "pickup_hour", "pickup_location_id"]
    names = [n for n, kind, _ in M.ZONE_HOUR.metrics if kind in ("sum", "avg")]
    j = rounded.select(*grain, *names).join(
        exact.select(*grain, *[F.col(n).cast("double").alias("x_" + n) for n in names]), grain, "full_outer")
    near = [F.coalesce(F.abs(F.col(n) - F.col("x_" + n)) <= 0.01 + 1e-9, F.lit(False)) for n in names]
    return j.agg(F.count(F.lit(1)).alias("groups"), F.count_if(reduce(lambda a, b: a & b, near)).alias("within_a_cent"))
