"""Queries of the operators for skew, exact merging and corrections:
skewed joins (J7), exact percentiles of daily partials (A17), corrections as
signed deltas (N4), one pass for all marts (O5), compaction by file size (W9),
equivalence by digests (V8), quarantine and replay (F8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterwise.operators import ledger as L
from meterwise.operators import marts as M
from meterwise.operators.digests import equivalence_by_digests as by_digests, partition_digests
from meterwise.operators.histogram import build_daily_histogram, duration_percentiles
from meterwise.operators.quarantine import replay, split_rows, write_split
from meterwise.operators.skewjoin import skew_join
from meterwise.plans import sqlparts as Q
from meterwise.plans.queries import (CL_TE, CL_TO, MODE, ORDERS_MAX_MINUTES, _cumulative_query_sql, fact, register,
                                     scratch, staged, zone)
from meterwise.plans.runner_queries import yellow
from meterwise.plans.fixtures import table
from meterwise.sources.compaction import compact_small
from meterwise.sources.readers import month_filter
from meterwise.sources.writers import write_partitioned

# ------------------------------------------------------------ skewed joins

# A third of the trips, and of the suppliers, share key 0.
HOT_SLICE = 2_000


def _hot_sides(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_suppkey") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("l_suppkey")).alias("k"),
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_suppkey") % 3 == 0, F.lit(0).cast("long")).when(F.col("s_suppkey") % 10 == 1, None)
        .otherwise(F.col("s_suppkey")).alias("k"), "s_suppkey", "s_nationkey")
    return items, suppliers


def _amount():
    """The prices of all pairs: a joined row stands for ``n`` of them."""
    return F.sum(F.col("price") * F.col("n").cast("decimal(18,0)")).cast(M.SUM_DECIMAL).alias("amount")


_HOT_SQL = """WITH items AS (SELECT CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_suppkey END AS k,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem),
suppliers AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 0 WHEN s_suppkey % 10 = 1 THEN NULL ELSE s_suppkey END AS k,
         s_suppkey, s_nationkey FROM supplier)
"""


@register("skewed_join", _HOT_SQL + f"""
SELECT k, s_nationkey, count(*) AS pairs, CAST(sum(price) AS {Q.SUMDEC}) AS amount
FROM items JOIN suppliers USING (k) GROUP BY 1, 2""")
def skewed_join(spark, sf_dir):
    """Inner join with one key that holds a third of both sides."""
    items, suppliers = _hot_sides(spark, sf_dir)
    joined = skew_join(items, suppliers.drop("s_suppkey"), ["k"], slice_rows=HOT_SLICE,
                       slice_left=["l_orderkey", "l_linenumber"], copies="n")
    return joined.groupBy("k", "s_nationkey").agg(F.sum("n").alias("pairs"), _amount())


@register("skewed_left_join", _HOT_SQL + f"""
SELECT k, s_nationkey IS NULL AS unmatched, count(*) AS pairs, CAST(sum(price) AS {Q.SUMDEC}) AS amount
FROM items LEFT JOIN suppliers USING (k) GROUP BY 1, 2""")
def skewed_left_join(spark, sf_dir):
    """The left outer form, with unmatched keys and null keys."""
    items, suppliers = _hot_sides(spark, sf_dir)
    joined = skew_join(items, suppliers.drop("s_suppkey"), ["k"], "left", slice_rows=HOT_SLICE,
                       slice_left=["l_orderkey", "l_linenumber"], copies="n")
    return joined.groupBy("k", F.col("s_nationkey").isNull().alias("unmatched")).agg(
        F.sum("n").alias("pairs"), _amount())


# ------------------------------------------------------------ exact percentiles

@register("partial_exact_percentiles", Q.with_clauses(Q.TE, CL_TE) + """
SELECT year_month, pickup_year, pickup_month, pickup_hour, pickup_location_id, count(*) AS trips,
       quantile_disc(trip_duration_sec, 0.5) AS p50_duration_sec,
       quantile_disc(trip_duration_sec, 0.9) AS p90_duration_sec,
       quantile_disc(trip_duration_min, 0.5) AS p50_duration_min,
       quantile_disc(trip_duration_min, 0.9) AS p90_duration_min
FROM cl GROUP BY 1, 2, 3, 4, 5""")
def partial_exact_percentiles(spark, sf_dir):
    """A8 + A17: daily histograms as a table, one day of them written again,
    merged into exact monthly percentiles."""
    path = scratch(spark, "histograms")
    f = fact(spark, sf_dir, "events")
    daily = build_daily_histogram(f).withColumn("day", F.col("pickup_date").cast("string"))
    write_partitioned(daily, path, ("day",), mode="static")
    last = f.agg(F.max("pickup_date")).first()[0]  # one date: the day to rerun
    write_partitioned(daily.where(F.col("pickup_date") == F.lit(last)), path, ("day",), mode="dynamic")
    return duration_percentiles(spark.read.parquet(path).drop("day"))


# ------------------------------------------------------------ corrections as deltas

def _versions(spark, sf_dir):
    """The trips, and a faulty first version of them: in two months, zones below
    5 were missing, zones above 20 came twice and zone 7 went to zone 30."""
    good = staged(spark, fact(spark, sf_dir, "orders"), "versions", "year", "month")
    hit = month_filter([(1996, 3), (1997, 10)])  # folders
    zone_of = F.col("pickup_location_id")
    bad = good.where(~hit | (zone_of >= 5)).withColumn(
        "pickup_location_id", F.when(hit & (zone_of == 7), F.lit(30).cast("long")).otherwise(zone_of))
    bad = bad.unionByName(good.where(hit & (zone_of > 20)))
    return good, bad, hit


@register("cumulative_ledger", _cumulative_query_sql("pickup_location_id", "zone"))
def cumulative_ledger(spark, sf_dir):
    """Running totals of a faulty base and two corrections equal a full
    rebuild.  Only the corrected months' trips are read for a correction; the first
    one is folded into the base, the second still stands in the ledger."""
    root = scratch(spark, "ledger")
    good, bad, hit = _versions(spark, sf_dir)
    spec, base, book = M.ZONE_MONTH, f"{root}/base", f"{root}/ledger"
    L.monthly_base(bad, spec).write.parquet(base)
    first, second = F.col("year") < 1997, F.col("year") >= 1997
    L.append_correction(spark, book, L.correction_deltas(bad.where(hit & first), good.where(hit & first), spec), "1996")
    folded = L.fold_ledger(spark, base, book, f"{root}/base-2", spec)
    L.drop_corrections(spark, book, folded)
    deltas = L.correction_deltas(bad.where(hit & second), good.where(hit & second), spec)
    for _ in range(2):  # a rerun replaces its own rows
        L.append_correction(spark, book, deltas, "1997")
    return L.ledger_running_totals(spark.read.parquet(f"{root}/base-2"), spark.read.parquet(book), spec,
                                   zone(spark, sf_dir), load_ts=False)


# ------------------------------------------------------------ one pass for all marts

@register("marts_in_one_pass", Q.with_clauses(Q.TO, CL_TO) + "\nUNION ALL ".join(f"""
SELECT '{spec.name}' AS mart, {', '.join(c if c in M.grain(spec) else f'NULL AS {c}' for c in M.grain(M.ZONE_HOUR) + ['vendor_id'])},
       {', '.join(n for n, _, _ in spec.metrics[:2])}, total_duration_min, p50_duration_min, p90_duration_min, total_amount
FROM (SELECT {', '.join(M.grain(spec))}, {Q.metric_list(Q.HOUR_METRICS)} FROM cl GROUP BY ALL) m"""
                                                                      for spec in (M.ZONE_HOUR, M.VENDOR_HOUR)))
def marts_in_one_pass(spark, sf_dir):
    """Both hourly marts' aggregates from one scan by grouping sets."""
    base = M.aggregate_all(fact(spark, sf_dir, "orders"), [M.ZONE_HOUR, M.VENDOR_HOUR], MODE)
    return base.select("mart", *M.grain(M.ZONE_HOUR), "vendor_id", "trip_count", "total_passenger_count",
                       "total_duration_min", "p50_duration_min", "p90_duration_min", "total_amount")


# ------------------------------------------------------------ compaction by file size

@register("compacted_by_size", Q.with_clauses(Q.TO, CL_TO) + f"""
SELECT pickup_year AS year, pickup_month AS month, count(*) AS rows, {Q.sum_dec('total_amount')} AS amount,
       CAST(1 AS BIGINT) AS files, pickup_month % 2 = 1 AND count(DISTINCT pickup_day % 2) > 1 AS rewritten
FROM cl GROUP BY pickup_year, pickup_month""")
def compacted_by_size(spark, sf_dir):
    """Odd months have two small files and become one; even months have one
    file, which is not touched."""
    path = scratch(spark, "sizes")
    f = fact(spark, sf_dir, "orders").withColumns({"year": F.col("pickup_year"), "month": F.col("pickup_month")})
    odd, late = F.col("month") % 2 == 1, F.col("pickup_day") % 2 == 1
    write_partitioned(f.where(~odd | late), path, mode="static", files_per_partition=1)
    write_partitioned(f.where(odd & ~late), path, mode="append", files_per_partition=1)
    compact_small(spark, path, target_bytes=64 << 20)
    back = spark.read.parquet(path).select("year", "month", "total_amount", F.col("_metadata.file_name").alias("file"))
    return back.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_amount").cast(M.SUM_DECIMAL).alias("amount"),
        F.count_distinct("file").alias("files"), F.bool_or(F.col("file").startswith("compacted-")).alias("rewritten"))


# ------------------------------------------------------------ equivalence by digests

@register("equivalence_by_digests", Q.with_clauses(Q.TE, CL_TE) + """
, first AS (SELECT * FROM cl WHERE pickup_date = (SELECT min(pickup_date) FROM cl))
, gone AS (SELECT count(*) AS n FROM first WHERE pickup_datetime = (SELECT min(pickup_datetime) FROM first))
SELECT (SELECT count(DISTINCT pickup_date) FROM cl) AS partitions, CAST(1 AS BIGINT) AS differing,
       (SELECT count(*) FROM first) AS compared_a, (SELECT count(*) FROM first) - n AS compared_b,
       n AS left_only, CAST(0 AS BIGINT) AS right_only
FROM gone""")
def equivalence_by_digests(spark, sf_dir):
    """V8: two written tables of trips by day, one without its earliest
    trip; only the day that differs is compared by rows."""
    paths = [scratch(spark, "digest-a"), scratch(spark, "digest-b")]
    f = fact(spark, sf_dir, "events")
    first = f.agg(F.min("pickup_datetime")).first()[0]  # one value: the trip to leave out
    for path, df in zip(paths, (f, f.where(F.col("pickup_datetime") > F.lit(first)))):
        write_partitioned(df.withColumn("day", F.col("pickup_date")), path, ("day",), mode="static")
    a, b = (spark.read.parquet(p) for p in paths)
    return by_digests(a, b, ["day"], partition_digests(a, ["day"]), partition_digests(b, ["day"]))


# ------------------------------------------------------------ quarantine and replay

@register("quarantine_replay", Q.with_clauses(Q.TO, CL_TO) + f"""
, raw AS (SELECT CAST(year(pickup_datetime) AS BIGINT) AS src_year, CAST(month(pickup_datetime) AS BIGINT) AS src_month,
                 count(*) AS raw_rows FROM tor GROUP BY 1, 2)
, kept AS (SELECT pickup_year AS src_year, pickup_month AS src_month, count(*) AS n,
                  count(*) FILTER (WHERE trip_duration_min <= 43200) AS at_once, {Q.sum_dec('total_amount')} AS amount
           FROM cl GROUP BY 1, 2)
SELECT src_year, src_month, raw_rows, coalesce(at_once, 0) AS kept_at_once, coalesce(n, 0) - coalesce(at_once, 0) AS replayed,
       raw_rows - coalesce(n, 0) AS rejected, amount
FROM raw LEFT JOIN kept USING (src_year, src_month)""")
def quarantine_replay(spark, sf_dir):
    """F8 + V4: trips over 30 days are quarantined first; with the cap raised, only the
    quarantine is replayed.  Kept, replayed and rejected rows are the Raw rows of
    each load, and what is kept is what a full rerun keeps."""
    at = F.col("tpep_pickup_datetime")
    raw = yellow(spark, sf_dir).withColumns({"src_year": F.year(at), "src_month": F.month(at)})
    first, again = scratch(spark, "split"), scratch(spark, "replayed")
    write_split(split_rows(raw, "yellow", MODE, 43_200.0), first)
    replay(spark, first, again, "yellow", MODE, ORDERS_MAX_MINUTES)
    old, new = spark.read.parquet(first), spark.read.parquet(again)
    rows = [old.select("src_year", "src_month", F.col("status").alias("s"), F.col("cleaned.total_amount").alias("amount"),
                       F.lit(True).alias("old")),
            new.select("src_year", "src_month", F.col("status"), F.col("cleaned.total_amount"), F.lit(False))]
    kept = F.col("s") == "kept"
    return rows[0].union(rows[1]).groupBy("src_year", "src_month").agg(
        F.count_if("old").alias("raw_rows"), F.count_if(F.col("old") & kept).alias("kept_at_once"),
        F.count_if(~F.col("old") & kept).alias("replayed"), F.count_if(~F.col("old") & ~kept).alias("rejected"),
        F.sum(F.when(kept, F.col("amount"))).cast(M.SUM_DECIMAL).alias("amount"))
