"""DuckDB SQL fragments that restate the fixture views and layers.

Used only by ``oracle_sql()``: each oracle query is an independent SQL
statement over the raw test tables, so it checks the Spark result rather
than sharing code with it.  Rules (SURVEY section 7.4): money is
DECIMAL(18,2) before arithmetic, sums DECIMAL(38,2), averages
``double(sum) / count``, integers BIGINT, ``dayofweek`` + 1.
"""

from __future__ import annotations

DEC = "DECIMAL(18,2)"
SUMDEC = "DECIMAL(38,2)"

TE = f"""te AS (
  SELECT ts AS pickup_datetime,
         ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS dropoff_datetime,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
              WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS BIGINT) AS vendor_id,
         CAST(user_id % 25 AS BIGINT) AS pickup_location_id,
         CAST((user_id + 1) % 25 AS BIGINT) AS dropoff_location_id,
         CAST(1 AS BIGINT) AS ratecode_id,
         CAST(1 AS BIGINT) AS payment_type,
         'N' AS store_and_fwd_flag,
         CAST(1 AS BIGINT) AS passenger_count,
         CAST(value AS {DEC}) AS trip_distance,
         CAST(value AS {DEC}) AS fare_amount,
         CAST(0 AS {DEC}) AS tip_amount,
         CAST(0 AS {DEC}) AS tolls_amount,
         CAST(value AS {DEC}) AS total_amount
  FROM events)"""

_PRICE = f"CAST(l.l_extendedprice AS {DEC})"
_TIP = f"CAST({_PRICE} * CAST(l.l_discount AS {DEC}) AS {DEC})"
_TOLLS = f"CAST({_PRICE} * CAST(l.l_tax AS {DEC}) AS {DEC})"

TO = f"""tor AS (
  SELECT o.o_orderdate AS pickup_datetime,
         l.l_shipdate AS dropoff_datetime,
         CAST(l.l_suppkey % 3 AS BIGINT) AS vendor_id,
         CAST(s.s_nationkey AS BIGINT) AS pickup_location_id,
         CAST(c.c_nationkey AS BIGINT) AS dropoff_location_id,
         CAST(1 AS BIGINT) AS ratecode_id,
         CAST(l.l_orderkey % 4 + 1 AS BIGINT) AS payment_type,
         CASE WHEN l.l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         CAST(l.l_linenumber AS BIGINT) AS passenger_count,
         CAST(l.l_quantity AS {DEC}) AS trip_distance,
         {_PRICE} AS fare_amount,
         {_TIP} AS tip_amount,
         {_TOLLS} AS tolls_amount,
         CAST({_PRICE} + {_TIP} + {_TOLLS} AS {DEC}) AS total_amount
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN customer c ON o.o_custkey = c.c_custkey)"""

ZONE = """zone AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id, r_name AS borough, n_name AS zone,
         CASE WHEN n_nationkey % 2 = 0 THEN r_name ELSE 'Boro Zone' END AS service_zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

DUR_MIN = "round(CAST(trip_duration_sec AS DOUBLE) / 60.0::DOUBLE, 2)"

FEATURES = """pickup_datetime, dropoff_datetime,
         CAST(pickup_datetime AS DATE) AS pickup_date,
         strftime(pickup_datetime, '%Y-%m') AS year_month,
         CAST(year(pickup_datetime) AS BIGINT) AS pickup_year,
         CAST(month(pickup_datetime) AS BIGINT) AS pickup_month,
         CAST(day(pickup_datetime) AS BIGINT) AS pickup_day,
         CAST(hour(pickup_datetime) AS BIGINT) AS pickup_hour,
         CAST(dayofweek(pickup_datetime) + 1 AS BIGINT) AS pickup_dayofweek"""


def with_duration(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT *, (epoch_us(dropoff_datetime) // 1000000) - (epoch_us(pickup_datetime) // 1000000)
            AS trip_duration_sec
  FROM {src})"""


def base_rules(max_minutes: float, pu: str = "pickup_location_id", do: str = "dropoff_location_id") -> list[tuple[str, str]]:
    return [
        ("pickup_not_null", "pickup_datetime IS NOT NULL"),
        ("dropoff_not_null", "dropoff_datetime IS NOT NULL"),
        ("dropoff_after_pickup", "dropoff_datetime > pickup_datetime"),
        ("duration_positive", f"{DUR_MIN} > 0"),
        ("duration_max", f"{DUR_MIN} <= {max_minutes}"),
        ("pickup_location_not_null", f"{pu} IS NOT NULL"),
        ("dropoff_location_not_null", f"{do} IS NOT NULL"),
    ]


TRIP_RULES = [
    ("passenger_count_positive", "passenger_count > 0"),
    ("passenger_count_max_8", "passenger_count <= 8"),
    ("trip_distance_positive", "trip_distance > 0"),
    ("trip_distance_max_200", "trip_distance <= 200"),
    ("fare_amount_positive", "fare_amount > 0"),
    ("total_amount_positive", "total_amount > 0"),
]


def cleaned(src: str, max_minutes: float, name: str = "cl") -> str:
    """Yellow-rule cleaning of a trip view: features + WHERE (two CTEs)."""
    rules = base_rules(max_minutes) + TRIP_RULES
    where = " AND ".join(f"({p})" for _, p in rules)
    return with_duration(src, name + "0") + f""",
{name} AS (
  SELECT vendor_id, pickup_location_id, dropoff_location_id, ratecode_id, payment_type,
         store_and_fwd_flag, {FEATURES},
         passenger_count, trip_distance, trip_duration_sec,
         {DUR_MIN} AS trip_duration_min,
         fare_amount, tip_amount, tolls_amount, total_amount
  FROM {name}0
  WHERE {where})"""


def with_clauses(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def vendor_name(col: str) -> str:
    return (f"CASE WHEN {col} = 1 THEN 'Creative Mobile Technologies' "
            f"WHEN {col} = 2 THEN 'VeriFone' ELSE 'Unknown' END")


def sum_dec(col: str) -> str:
    return f"CAST(sum(CAST({col} AS {DEC})) AS {SUMDEC})"


def avg_dec(col: str) -> str:
    return f"CAST(sum(CAST({col} AS {DEC})) AS DOUBLE) / CAST(count({col}) AS DOUBLE)"


def ratio(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0 END"


HOUR_METRICS = {
    "trip_count": "count(*)",
    "total_passenger_count": "CAST(sum(passenger_count) AS BIGINT)",
    "total_distance": sum_dec("trip_distance"),
    "avg_distance": avg_dec("trip_distance"),
    "total_duration_min": sum_dec("trip_duration_min"),
    "avg_duration_min": avg_dec("trip_duration_min"),
    "p50_duration_min": "quantile_disc(trip_duration_min, 0.5)",
    "p90_duration_min": "quantile_disc(trip_duration_min, 0.9)",
    "total_fare_amount": sum_dec("fare_amount"),
    "total_tip_amount": sum_dec("tip_amount"),
    "total_tolls_amount": sum_dec("tolls_amount"),
    "total_amount": sum_dec("total_amount"),
    "avg_fare_amount": avg_dec("fare_amount"),
    "avg_tip_amount": avg_dec("tip_amount"),
    "avg_total_amount": avg_dec("total_amount"),
}
VENDOR_HOUR_METRICS = {k: v for k, v in HOUR_METRICS.items()
                       if k not in ("total_tolls_amount", "avg_tip_amount")}
MONTHLY_METRICS = {
    "monthly_trip_count": "count(*)",
    "monthly_passenger_count": "CAST(sum(passenger_count) AS BIGINT)",
    "monthly_distance": sum_dec("trip_distance"),
    "monthly_fare_amount": sum_dec("fare_amount"),
    "monthly_tip_amount": sum_dec("tip_amount"),
    "monthly_total_amount": sum_dec("total_amount"),
}
CUM = [("monthly_trip_count", "cumulative_trip_count"),
       ("monthly_passenger_count", "cumulative_passenger_count"),
       ("monthly_distance", "cumulative_distance"),
       ("monthly_fare_amount", "cumulative_fare_amount"),
       ("monthly_tip_amount", "cumulative_tip_amount"),
       ("monthly_total_amount", "cumulative_total_amount")]


def metric_list(metrics: dict) -> str:
    return ",\n         ".join(f"{v} AS {k}" for k, v in metrics.items())


def cumulative_cols(partition: str) -> str:
    out = []
    for m, c in CUM:
        expr = (f"sum({m}) OVER (PARTITION BY {partition} ORDER BY pickup_year, pickup_month "
                f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
        if m in ("monthly_trip_count", "monthly_passenger_count"):
            expr = f"CAST({expr} AS BIGINT)"
        else:
            expr = f"CAST({expr} AS {SUMDEC})"
        out.append(f"{expr} AS {c}")
    return ",\n         ".join(out)
