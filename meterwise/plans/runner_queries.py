"""Queries of the layer runner: loads that drift, are corrected, come in
ranges, belong to several variants, and daily partials as a table.

The source files are derived from the whole test tables and written under the
shared scratch folder; every oracle states the result from the tables alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.operators import marts as M
from meterwise.operators.partial import mart_from_partials
from meterwise.operators.skew import hot_keys as hot
from meterwise.plans import fixtures as FX
from meterwise.plans import sqlparts as Q
from meterwise.plans.layers import (MART_COLUMNS, Layout, backfill, build_daily_partials, run_month, run_range,
                                    validation_report)
from meterwise.plans.queries import (CL_TE, CL_TO, MODE, ORDERS_MAX_MINUTES, W_TE, W_TO, _cumulative_query_sql,
                                     _monthly_query_sql, _zone_hour_sql, by_pickup, cleaned, fact, register,
                                     run_backfill, scratch, staged, trips, zone)
from meterwise.session import bounded_writes
from meterwise.sources.readers import read_loads, read_source
from meterwise.sources.writers import write_partitioned

DRIFT_FROM = 1998 * 12 + 6  # the optional fee column exists from July 1998 on


def write_sources(df: DataFrame, path: str, year, month, mode: str = "append") -> str:
    """Monthly source folders in the published (padded) naming."""
    (df.withColumns({"year": year, "month": F.format_string("%02d", month)})
     .write.partitionBy("year", "month").mode(mode).parquet(path))
    return path


def yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.as_variant_raw(trips(spark, sf_dir, "orders"), "yellow")


def _pickup(prefix: str = "tpep"):
    at = F.col(f"{prefix}_pickup_datetime")
    return F.year(at), F.month(at)


# ------------------------------------------------------------ drifting schemas

@register("layered_schema_drift", Q.with_clauses(Q.TO, CL_TO) + f"""
SELECT pickup_year AS src_year, pickup_month AS src_month, count(*) AS rows,
       CAST(sum(payment_type) AS {Q.SUMDEC}) AS extra, count(*) AS extra_given,
       CAST(sum(CASE WHEN late THEN 0.25 * payment_type END) AS {Q.SUMDEC}) AS congestion,
       count(*) FILTER (WHERE late) AS congestion_given
FROM (SELECT *, pickup_year * 12 + pickup_month - 1 >= {DRIFT_FROM} AS late FROM cl) c GROUP BY 1, 2""")
def layered_schema_drift(spark, sf_dir):
    """S2 + S12 + P2 + O1: one fee comes as DOUBLE, INT or BIGINT by turns and
    an optional fee only in later months; no load loses a value."""
    root = scratch(spark, "drift")
    year, month = _pickup()
    raw = staged(spark, yellow(spark, sf_dir).withColumn("_m", year * 12 + month - 1), "drift-trips", "_m")
    for turn, kind in enumerate(("double", "int", "bigint")):
        part = raw.where(F.col("_m") % 3 == turn).withColumn("extra", F.col("payment_type").cast(kind))
        early, late = part.where(F.col("_m") < DRIFT_FROM), part.where(F.col("_m") >= DRIFT_FROM)
        write_sources(early.drop("_m"), f"{root}/source", year, month)
        write_sources(late.withColumn("cbd_congestion_fee", F.col("payment_type").cast("double") * 0.25).drop("_m"),
                      f"{root}/source", year, month)
    lay = Layout(root)
    backfill(spark, lay, f"{root}/source", zone(spark, sf_dir), MODE, ORDERS_MAX_MINUTES)
    return read_loads(spark, lay.cleaned).groupBy("src_year", "src_month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("extra").cast(M.SUM_DECIMAL).alias("extra"),
        F.count("extra").alias("extra_given"),
        F.sum("cbd_congestion_fee").cast(M.SUM_DECIMAL).alias("congestion"),
        F.count("cbd_congestion_fee").alias("congestion_given"))


# ------------------------------------------------------------ corrected loads

def _trips_per_month(spark, lay: Layout) -> DataFrame:
    """Trips per month in Cleaned, Fact and every mart, side by side."""
    cl = spark.read.parquet(lay.cleaned)
    tables = [cl.select(F.col("pickup_year").alias("year"), F.col("pickup_month").alias("month"),
                        F.lit("cleaned").alias("name"), F.lit(1).cast("long").alias("n")),
              spark.read.parquet(lay.fact).select("year", "month", F.lit("fact"), F.lit(1).cast("long"))]
    for name, (count, _, _) in MART_COLUMNS.items():
        tables.append(spark.read.parquet(lay.mart(name)).select("year", "month", F.lit(name), F.col(count)))
    both = tables[0]
    for t in tables[1:]:
        both = both.union(t)
    names = ["cleaned", "fact", *MART_COLUMNS]
    return both.groupBy("year", "month").agg(*[F.sum(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])


@register("layered_rerun_corrected", Q.with_clauses(Q.TO, CL_TO) + f"""
, rc AS (SELECT DISTINCT year(pickup_datetime) * 12 + month(pickup_datetime) AS k FROM tor)
, prev AS (SELECT k FROM rc ORDER BY k DESC LIMIT 1 OFFSET 1)
SELECT pickup_year AS year, pickup_month AS month, {', '.join(f'count(*) AS {n}' for n in ("cleaned", "fact", *MART_COLUMNS))}
FROM cl WHERE pickup_year * 12 + pickup_month <> (SELECT k FROM prev) GROUP BY 1, 2""")
def layered_rerun_corrected(spark, sf_dir):
    """O4 (G3, G4): the last load first carries stray rows of the month before;
    it is loaded again without them, and the month before is emptied."""
    root = scratch(spark, "corrected")
    year, month = _pickup()
    raw = staged(spark, yellow(spark, sf_dir).withColumn("_k", year * 12 + month), "corrected-trips", "_k")
    # The last two source months: two rows, they choose the loads to correct.
    last, prev = [r["k"] for r in raw.select(F.col("_k").alias("k")).distinct().orderBy(F.desc("k")).limit(2).collect()]

    def ym(k: int) -> tuple[int, int]:
        return (k - 1) // 12, (k - 1) % 12 + 1

    stray = raw.where((F.col("_k") == prev) & (F.col("payment_type") == 1))
    write_sources(raw.drop("_k"), f"{root}/source", year, month)
    write_sources(stray.drop("_k"), f"{root}/source", F.lit(ym(last)[0]), F.lit(ym(last)[1]))
    lay, z = Layout(root), zone(spark, sf_dir)
    backfill(spark, lay, f"{root}/source", z, MODE, ORDERS_MAX_MINUTES)
    raw.where(F.col("_k") == last).drop("_k").write.parquet(f"{root}/fixed")
    raw.where(F.lit(False)).drop("_k").write.parquet(f"{root}/emptied")
    run_month(spark, lay, f"{root}/fixed", *ym(last), z, MODE, ORDERS_MAX_MINUTES)
    run_month(spark, lay, f"{root}/emptied", *ym(prev), z, MODE, ORDERS_MAX_MINUTES, allow_empty=True)
    return _trips_per_month(spark, lay)


# ------------------------------------------------------------ range runs

@register("layered_range_run", _cumulative_query_sql("pickup_location_id", "zone"))
@bounded_writes
def layered_range_run(spark, sf_dir):
    """O1 + S9: yearly loads come in three ranges, one after the other; the
    running totals are those of one full build."""
    root = scratch(spark, "ranges")
    year, _ = _pickup()
    raw = FX.as_variant_raw(by_pickup(trips(spark, sf_dir, "orders"), "year"), "yellow")
    src = write_sources(raw, f"{root}/source", year, F.lit(12))
    lay, z = Layout(root), zone(spark, sf_dir)
    for start, end in ((None, "1996-12"), ("1997-01", "1999-12"), ("2000-01", None)):
        run_range(spark, lay, src, z, start, end, money_mode=MODE, max_minutes=ORDERS_MAX_MINUTES)
    return spark.read.parquet(lay.mart("zone_cumulative")).drop("created_at", "updated_at")


# ------------------------------------------------------------ variants

@register("layered_two_variants", Q.with_clauses(Q.TO, CL_TO) + """
SELECT pickup_year AS year, pickup_month AS month, count(*) AS yellow,
       nullif(count(*) FILTER (WHERE payment_type <= 2), 0) AS green, count(*) AS fact
FROM cl GROUP BY 1, 2""")
@bounded_writes
def layered_two_variants(spark, sf_dir):
    """O2: yellow and green under one root; Fact stays the yellow one."""
    root = scratch(spark, "variants")
    z = zone(spark, sf_dir)
    # Joined once and staged by month: a task that writes sources holds few folders.
    at = {"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")}
    both = staged(spark, trips(spark, sf_dir, "orders").withColumns(at), "variant-trips", "year", "month")
    frames = {"yellow": FX.as_variant_raw(both, "yellow"),
              "green": FX.as_variant_raw(both.where("payment_type <= 2"), "green")}
    counts = []
    for variant, raw in frames.items():
        src = write_sources(raw, f"{root}/source/{variant}", *_pickup("tpep" if variant == "yellow" else "lpep"))
        lay = Layout(root, variant)
        backfill(spark, lay, src, z, MODE, ORDERS_MAX_MINUTES)
        counts.append(spark.read.parquet(lay.cleaned).select(
            F.col("pickup_year").alias("year"), F.col("pickup_month").alias("month"), F.lit(variant).alias("name")))
    rows = counts[0].union(counts[1]).union(spark.read.parquet(lay.fact).select("year", "month", F.lit("fact")))
    return rows.groupBy("year", "month").agg(
        *[F.nullif(F.count_if(F.col("name") == n), F.lit(0)).alias(n) for n in ("yellow", "green", "fact")])


# ------------------------------------------------------------ validation, partial table

_MART_ROWS = {
    "cleaned": "count(*)", "zone_hour": "count(DISTINCT (pickup_year, pickup_month, pickup_hour, pickup_location_id))",
    "vendor_hour": "count(DISTINCT (pickup_year, pickup_month, pickup_hour, vendor_id))",
    "zone_cumulative": "count(DISTINCT (pickup_year, pickup_month, pickup_location_id))",
    "vendor_cumulative": "count(DISTINCT (pickup_year, pickup_month, vendor_id))"}


@register("validate_all_marts", Q.with_clauses(Q.TO, CL_TO) + "\nUNION ALL ".join(f"""
SELECT '{name}' AS name, count(*) AS fact_rows, {rows} AS rows, count(*) AS trips, CAST(0 AS BIGINT) AS violations,
       {Q.sum_dec('total_amount')} AS amount, true AS passed FROM cl""" for name, rows in _MART_ROWS.items()))
def validate_all_marts(spark, sf_dir):
    """V1 + V2 + O3: Cleaned and the four written marts against the Fact."""
    lay, _ = run_backfill(spark, sf_dir)
    r = validation_report(spark, lay)
    return r.select("name", "fact_rows", "rows", "trips", "violations",
                    F.col("amount").cast(M.SUM_DECIMAL).alias("amount"), "passed")


@register("partial_rerun_day", "SELECT * EXCLUDE (p50_duration_min, p90_duration_min) FROM (" +
          _zone_hour_sql(W_TE) + ") m")
def partial_rerun_day(spark, sf_dir):
    """A16 + A17: the Fact first misses its last day; when it is there, only
    that day's partials are rebuilt and the merged mart is the full one
    (percentiles of sketches: see ``partial_percentiles``)."""
    lay = Layout(scratch(spark, "partials"))
    f = fact(spark, sf_dir, "events").withColumns({"year": F.col("pickup_year"), "month": F.col("pickup_month")})
    last = f.agg(F.max("pickup_date")).first()[0]  # one date: the day to rerun
    write_partitioned(f.where(F.col("pickup_date") < F.lit(last)), lay.fact)
    build_daily_partials(spark, lay, money_mode=MODE)
    write_partitioned(f, lay.fact)
    build_daily_partials(spark, lay, day=last.isoformat(), money_mode=MODE)
    mart = mart_from_partials(spark.read.parquet(lay.partial_zone).drop("year", "month", "day"),
                              zone(spark, sf_dir), MODE)
    return mart.drop("p50_duration_min", "p90_duration_min")


# ------------------------------------------------------------ small operators

@register("csv_source_clean", Q.with_clauses(Q.TO, CL_TO) + f"""
SELECT pickup_year, pickup_month, count(*) AS rows, {Q.sum_dec('total_amount')} AS amount FROM cl GROUP BY 1, 2""")
def csv_source_clean(spark, sf_dir):
    """S1 (CSV branch): the trips as headed CSV, read with their schema and
    cleaned."""
    from meterwise.operators.clean import clean
    path = scratch(spark, "csv_source")
    raw = yellow(spark, sf_dir)
    raw.write.option("header", "true").option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    back = read_source(spark, path, raw.schema)
    return clean(back, "yellow", MODE, ORDERS_MAX_MINUTES, load_ts=False).groupBy("pickup_year", "pickup_month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_amount").cast(M.SUM_DECIMAL).alias("amount"))


@register("preview_monthly_zone", _monthly_query_sql("pickup_location_id", "zone") + """
ORDER BY year, month, pickup_location_id LIMIT 20""")
def preview_monthly_zone(spark, sf_dir):
    """K1 + K5: the first 20 rows of the monthly zone mart, sorted."""
    mart = M.build_metric_mart(fact(spark, sf_dir, "orders"), M.ZONE_MONTH, zone(spark, sf_dir), money_mode=MODE,
                               load_ts=False)
    return M.preview(mart, 20, ["year", "month", "pickup_location_id"])


@register("hot_keys", W_TO + """
SELECT vendor_id, count(*) AS rows, CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM cl) AS DOUBLE) AS share
FROM cl GROUP BY 1 HAVING CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM cl) AS DOUBLE) >= 0.05""")
def hot_keys(spark, sf_dir):
    """Vendors holding at least a twentieth of all trips."""
    return hot(fact(spark, sf_dir, "orders"), "vendor_id", 0.05)
