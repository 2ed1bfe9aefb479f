"""Skewed joins (J7), exact merged percentiles (A17) and the correction ledger."""

import datetime
import math
import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from meterwise.operators import histogram as H
from meterwise.operators import ledger as L
from meterwise.operators import marts as M
from meterwise.operators import skewjoin as S


# ---- J7

def sides(spark, n=900, m=90):
    r = random.Random(1)
    left = [(0 if i % 3 == 0 else None if i % 11 == 0 else r.randint(1, 40), "x" if i % 2 else "y", i)
            for i in range(n)]
    right = [(0 if i % 3 == 0 else None if i % 10 == 0 else r.randint(1, 60), "x" if i % 2 else "y", -i)
             for i in range(m)]
    right += [(50, "x", 7)] * 3  # repeated rows
    return left, right, spark.createDataFrame(left, "k int, t string, l int"), spark.createDataFrame(
        right, "k int, t string, r int")


@pytest.mark.parametrize("how", S.HOWS)
@pytest.mark.parametrize("on", [["k"], ["k", "t"]])
def test_skew_join_equals_plain_join(spark, how, on):
    _, _, left, right = sides(spark)
    if len(on) == 1:
        right = right.drop("t")
    for slice_rows in (20, 10**6):
        got = S.skew_join(left, right, on, how, share=0.02, slice_rows=slice_rows)
        want = left.join(right, on, how)
        assert got.columns == want.columns
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_counts_equal_right_rows(spark, how):
    """a key hot on both sides; equal right rows, null values among them, meet once."""
    left = spark.range(600).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.range(300).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"),
                                    F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("v"))
    pairs = left.join(right, "k", how).groupBy("k", "id", "v").count()
    for slice_rows in (20, 10**6):
        got = S.skew_join(left, right, ["k"], how, slice_rows=slice_rows, copies="n")
        assert got.columns == ["k", "id", "v", "n"]
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, pairs.collect()))
    with pytest.raises(ValueError):
        S.skew_join(left, right, ["k"], "left_semi", copies="n")


def test_skew_join_without_rows(spark):
    _, _, left, right = sides(spark)
    for how in S.HOWS:
        for a, b in ((left.limit(0), right), (left, right.limit(0))):
            got = S.skew_join(a, b.drop("t"), ["k"], how, slice_rows=20).count()
            assert got == a.join(b.drop("t"), ["k"], how).count()


def test_hot_keys_are_few_and_cells_even(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1).alias("k"), "id")
    other = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1).alias("k"),
                                      F.col("id").alias("o"))
    hot = S.hot_join_keys(rows, other, ["k"], share=0.05, slice_rows=500).collect()
    assert [(r["k"], r["left_rows"], r["right_rows"], r["a"], r["b"]) for r in hot] == [(0, 10_000, 1_000, 20, 2)]
    hot_df = spark.createDataFrame(hot)
    cells = [S.grid_side(df.where("k = 0"), hot_df, ["k"], left) for df, left in ((rows, True), (other, False))]
    for side, times, n in zip(cells, (2, 20), (10_000, 1_000)):
        sizes = [r["count"] for r in side.groupBy("_i", "_j").count().collect()]
        assert sum(sizes) == times * n and len(sizes) == 40 and max(sizes) < 2 * median(sizes)
    joined = cells[0].join(cells[1], ["k", "_i", "_j"])
    assert joined.count() == joined.select("id", "o").distinct().count() == 10_000 * 1_000


def test_skew_join_tasks_are_even(spark):
    """One key with a third of both sides: no task of the join holds twice the
    median task's rows."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions",
                                           "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "6")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000 + 1).alias("k"), "id")
        other = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000 + 1).alias("k"),
                                          F.col("id").alias("o"))
        tasks = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        plain, even = tasks(rows.join(other, "k")), tasks(S.skew_join(rows, other, ["k"], slice_rows=250))
        even = [x for x in even if x > 100_000]  # those of the hot key
        assert max(plain) > 20 * median(plain) and len(even) == 6 and max(even) < 2 * median(even)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


# ---- A17

def test_exact_percentiles(spark):
    r = random.Random(2)
    trips = [(g, r.choice([r.randint(0, 50), r.randint(0, 90_000), 3_600, 7_199]))
             for g in ("a", "b", None) for _ in range(r.randint(200, 400))] + [("one", 5)]
    table = spark.createDataFrame(trips, "g string, value long").groupBy("g", "value", F.rand(1) > 0.5).agg(
        F.count(F.lit(1)).alias("trips"))
    asked = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    for bucket in (1, 100, 3_600, 10**6):
        got = {x["g"]: x for x in H.exact_percentiles(table, ["g"], asked, bucket).collect()}
        for g in ("a", "b", None, "one"):
            values = sorted(v for k, v in trips if k == g)
            assert got[g]["trips"] == len(values)
            for name, q in asked.items():
                assert got[g][name] == values[max(1, math.ceil(q * len(values))) - 1]
    assert H.exact_percentiles(table.limit(0), ["g"], asked).count() == 0


def test_daily_histograms_merge(spark):
    day = datetime.date(2024, 1, 1)
    rows = [(day + datetime.timedelta(i % 40), 2024, 1 if i % 40 < 31 else 2, (i % 40) % 31 + 1, i % 3, i % 4,
             (i * 37) % 500 if i % 13 else None) for i in range(3_000)]
    fact = spark.createDataFrame(rows, "pickup_date date, pickup_year int, pickup_month int, pickup_day int, "
                                       "pickup_hour int, pickup_location_id long, trip_duration_sec long")
    daily = H.build_daily_histogram(fact)
    assert daily.count() == daily.select(*daily.columns[:-1]).distinct().count()
    got = {(x["year_month"], x["pickup_hour"], x["pickup_location_id"]): x
           for x in H.duration_percentiles(daily).collect()}
    groups = {}
    for d, _, _, _, h, z, v in rows:
        if v is not None:
            groups.setdefault((f"{d:%Y-%m}", h, z), []).append(v)
    assert set(got) == set(groups)
    for key, values in groups.items():
        values.sort()
        for name, q in (("p50", 0.5), ("p90", 0.9)):
            want = values[math.ceil(q * len(values)) - 1]
            assert got[key][f"{name}_duration_sec"] == want
            assert got[key][f"{name}_duration_min"] == pytest.approx(want / 60, abs=0.006)


# ---- N4

def trips(spark, rows):
    data = [(f"{y:04d}-{m:02d}", y, m, zone, 1, float(d), float(a)) for y, m, zone, d, a in rows]
    df = spark.createDataFrame(data, "year_month string, pickup_year int, pickup_month int, pickup_location_id long, "
                                     "passenger_count long, trip_distance double, fare_amount double")
    return df.withColumns({"tip_amount": F.lit(0.5), "total_amount": F.col("fare_amount") + 0.5})


def test_ledger_equals_rebuild(spark, out):
    spec = M.ZONE_MONTH
    old = [(2023, m, z, 1, 10 * m + z) for m in range(1, 13) for z in range(4)]
    # March: zone 0 is gone, zone 1 has one trip more, zone 9 is new, zone 2 costs more.
    march = [(2023, 3, 1, 1, 31), (2023, 3, 1, 2, 8), (2023, 3, 2, 1, 99), (2023, 3, 3, 1, 33), (2023, 3, 9, 4, 4)]
    new = [r for r in old if r[1] != 3] + march
    zones = spark.createDataFrame([(i, f"b{i}", f"z{i}", "s") for i in range(10)],
                                  "location_id int, borough string, zone string, service_zone string")
    L.monthly_base(trips(spark, old), spec).write.parquet(f"{out}/base")
    deltas = L.correction_deltas(trips(spark, [r for r in old if r[1] == 3]), trips(spark, march), spec)
    assert {r["pickup_location_id"] for r in deltas.collect()} == {0, 1, 2, 9}  # zone 3 did not change
    for _ in range(2):
        L.append_correction(spark, f"{out}/ledger", deltas, "2023-03.a")
    base, book = spark.read.parquet(f"{out}/base"), spark.read.parquet(f"{out}/ledger")
    rows = lambda df: Counter(map(tuple, df.collect()))
    want = rows(L.ledger_running_totals(L.monthly_base(trips(spark, new), spec), None, spec, zones, False))
    assert rows(L.ledger_running_totals(base, book, spec, zones, False)) == want
    # A second correction takes the first one back; folding one leaves the other.
    names = L.fold_ledger(spark, f"{out}/base", f"{out}/ledger", f"{out}/base2", spec)
    back = L.correction_deltas(trips(spark, march), trips(spark, [r for r in old if r[1] == 3]), spec)
    L.append_correction(spark, f"{out}/ledger", back, "2023-03.b")
    L.drop_corrections(spark, f"{out}/ledger", names)
    folded = spark.read.parquet(f"{out}/base2")
    assert names == ["2023-03.a"] and rows(L.ledger_running_totals(folded, None, spec, zones, False)) == want
    undone = L.ledger_running_totals(folded, spark.read.parquet(f"{out}/ledger"), spec, zones, False)
    assert rows(undone) == rows(L.ledger_running_totals(L.monthly_base(trips(spark, old), spec), None, spec, zones, False))
    with pytest.raises(ValueError):
        L.append_correction(spark, f"{out}/ledger", back, "../x")
    with pytest.raises(ValueError):
        L.fold_ledger(spark, f"{out}/base", f"{out}/ledger", f"{out}/base", spec)
