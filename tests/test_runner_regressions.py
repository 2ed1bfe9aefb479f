"""Faults of the layer runner that uniform sources do not show."""
import os

import pytest
from pyspark.sql import functions as F

from meterwise.operators.cumulative import PAIRS, running_totals
from meterwise.plans.layers import (Layout, backfill, build_daily_partials, run_month, run_range, validate_written,
                                    validation_report)
from meterwise.sources.readers import read_loads
from tests.test_layers import SCHEMA, month_rows, zone_dim


def write(spark, root, y, m, rows, fee=None, cast=None):
    df = spark.createDataFrame(rows, SCHEMA)
    if fee is not None:
        df = df.withColumn("cbd_congestion_fee", F.lit(fee))
    if cast:
        df = df.withColumn("extra", F.col("extra").cast(cast))
    p = os.path.join(root, f"year={y}", f"month={m:02d}")
    df.write.mode("overwrite").parquet(p)
    return p


def per_month(spark, path):
    return {(r.year, r.month): r.n for r in spark.read.parquet(path).groupBy("year", "month")
            .agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize("whole", [False, True])
def test_each_load_keeps_its_own_columns_and_types(spark, out, whole):
    src, z = os.path.join(out, "src"), zone_dim(spark)
    paths = [write(spark, src, 2024, 11, month_rows(2024, 11, 6)),
             write(spark, src, 2024, 12, month_rows(2024, 12, 5), cast="int"),
             write(spark, src, 2025, 1, month_rows(2025, 1, 4), fee=0.75, cast="bigint")]
    lay = Layout(os.path.join(out, "lay"))
    if whole:
        backfill(spark, lay, src, z)
    else:
        for p, (y, m) in zip(paths, [(2024, 11), (2024, 12), (2025, 1)]):
            run_month(spark, lay, p, y, m, z)
    cleaned = read_loads(spark, lay.cleaned)
    got = {(r.src_year, r.src_month): (r.n, r.fee) for r in cleaned.groupBy("src_year", "src_month").agg(
        F.count("*").alias("n"), F.sum("cbd_congestion_fee").alias("fee")).collect()}
    assert got == {(2024, 11): (6, None), (2024, 12): (5, None), (2025, 1): (4, 3.0)}
    assert sum(per_month(spark, lay.fact).values()) == 15


def test_corrected_load_takes_its_rows_away(spark, out):
    src, z, lay = os.path.join(out, "src"), zone_dim(spark), Layout(os.path.join(out, "lay"))
    run_month(spark, lay, write(spark, src, 2024, 1, month_rows(2024, 1, 5)), 2024, 1, z)
    run_month(spark, lay, write(spark, src, 2024, 2, month_rows(2024, 2, 4, stray_from=(2024, 1))), 2024, 2, z)
    assert per_month(spark, lay.fact) == {(2024, 1): 6, (2024, 2): 4}
    run_month(spark, lay, write(spark, src, 2024, 2, month_rows(2024, 2, 4)), 2024, 2, z)
    assert per_month(spark, lay.fact) == {(2024, 1): 5, (2024, 2): 4}
    run_month(spark, lay, write(spark, src, 2024, 2, []), 2024, 2, z, allow_empty=True)
    assert per_month(spark, lay.fact) == {(2024, 1): 5}
    for mart in lay.marts:
        assert per_month(spark, lay.mart(mart)).keys() == {(2024, 1)}


def test_other_variants_do_not_touch_fact(spark, out):
    src, z, root = os.path.join(out, "src"), zone_dim(spark), os.path.join(out, "lay")
    run_month(spark, Layout(root), write(spark, src, 2024, 1, month_rows(2024, 1, 5)), 2024, 1, z)
    green = spark.read.parquet(os.path.join(src, "year=2024/month=01")).limit(3).withColumnsRenamed(
        {"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"}).withColumns(
        {"trip_type": F.lit(1.0), "ehail_fee": F.lit(0.0)})
    green.write.parquet(os.path.join(out, "green"))
    lay = Layout(root, variant="green")
    run_month(spark, lay, os.path.join(out, "green"), 2024, 1, z)
    assert spark.read.parquet(lay.cleaned).count() == 3
    assert per_month(spark, lay.fact) == {(2024, 1): 5}


def test_range_run_touches_only_its_months(spark, out):
    src, z = os.path.join(out, "src"), zone_dim(spark)
    for m, n in ((1, 5), (2, 4), (3, 3), (4, 2)):
        write(spark, src, 2024, m, month_rows(2024, m, n))
    lay, whole = Layout(os.path.join(out, "ranges")), Layout(os.path.join(out, "whole"))
    run_range(spark, lay, src, z, "2024-01", "2024-02")
    assert per_month(spark, lay.fact) == {(2024, 1): 5, (2024, 2): 4}
    run_range(spark, lay, src, z, "2024-03")
    backfill(spark, whole, src, z)
    for path in ("fact", *lay.marts):
        a, b = (spark.read.parquet(x.fact if path == "fact" else x.mart(path)).drop("created_at", "updated_at")
                for x in (lay, whole))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    with pytest.raises(ValueError):
        backfill(spark, whole, src, z, source_filter=F.col("month") == 1)
    with pytest.raises(ValueError):
        run_range(spark, lay, src, z, "2030-01")


def test_failed_validation_fails_the_run(spark, out, monkeypatch):
    from meterwise.plans import layers
    src, z, lay = os.path.join(out, "src"), zone_dim(spark), Layout(os.path.join(out, "lay"))
    p = write(spark, src, 2024, 1, month_rows(2024, 1, 5))
    monkeypatch.setattr(layers, "validate_written", lambda *a: {
        "fact_rows": 5, "mart_trip_sum": 4, "amount_diff": 1.0, "passed": False})
    with pytest.raises(ValueError, match="validation"):
        run_month(spark, lay, p, 2024, 1, z)
    assert spark.read.parquet(lay.run_log).where("layer = 'run' and status = 'failed'").count() == 1


@pytest.mark.parametrize("first", [None, 2.0])
def test_null_month_keeps_the_carried_total(spark, first):
    names = [m for m, _ in PAIRS]
    schema = "e int, pickup_year int, pickup_month int, " + ", ".join(f"{m} double" for m in names)
    month = spark.createDataFrame([(1, 2024, 3, *[None] * len(names))], schema)
    seed = spark.createDataFrame([(1, *[first] * len(names))], "e int, " + ", ".join(f"{c} double" for _, c in PAIRS))
    got = running_totals(month, "e", "double", seed).first()
    assert [got[c] for _, c in PAIRS] == [first] * len(PAIRS)


def test_every_mart_is_validated(spark, out):
    src, z, lay = os.path.join(out, "src"), zone_dim(spark), Layout(os.path.join(out, "lay"))
    run_month(spark, lay, write(spark, src, 2024, 1, month_rows(2024, 1, 5)), 2024, 1, z)
    report = {r["name"]: r for r in validation_report(spark, lay).collect()}
    assert set(report) == {"cleaned", *lay.marts} and all(r["passed"] for r in report.values())
    short = spark.read.parquet(lay.mart("vendor_hour")).limit(1).checkpoint()
    short.write.partitionBy("year", "month").mode("overwrite").parquet(lay.mart("vendor_hour"))
    assert validate_written(spark, lay, [(2024, 1)])["failed"] == ["vendor_hour"]


def test_dimensions_are_written(spark, out):
    src, z, lay = os.path.join(out, "src"), zone_dim(spark), Layout(os.path.join(out, "lay"))
    run_month(spark, lay, write(spark, src, 2024, 2, month_rows(2024, 2, 5)), 2024, 2, z)
    assert spark.read.parquet(lay.dim("date")).count() == 29
    assert spark.read.parquet(lay.dim("time")).count() == 24
    assert spark.read.parquet(lay.dim("zone")).count() == z.count()


def test_one_day_of_partials_is_rebuilt(spark, out):
    src, z, lay = os.path.join(out, "src"), zone_dim(spark), Layout(os.path.join(out, "lay"))
    run_month(spark, lay, write(spark, src, 2024, 1, month_rows(2024, 1, 5)), 2024, 1, z)
    build_daily_partials(spark, lay)
    day = os.path.join(lay.partial_zone, "year=2024", "month=1")
    before = {d: sorted(os.listdir(os.path.join(day, d))) for d in os.listdir(day)}
    run_month(spark, lay, write(spark, src, 2024, 1, month_rows(2024, 1, 2)), 2024, 1, z)
    build_daily_partials(spark, lay, day="2024-01-03")
    assert set(before) - set(os.listdir(day)) == {"day=3"}  # no trips any more
    build_daily_partials(spark, lay, day="2024-01-02")
    after = {d: sorted(os.listdir(os.path.join(day, d))) for d in os.listdir(day)}
    assert after["day=1"] == before["day=1"] and after["day=2"] != before["day=2"]


def test_double_totals_keep_untouched_months(spark, out):
    """A stray row of an early month reruns the totals without rereading the
    Fact of the months since."""
    src, z = os.path.join(out, "src"), zone_dim(spark)
    lay, whole = Layout(os.path.join(out, "runs")), Layout(os.path.join(out, "whole"))
    for m, stray in ((1, None), (2, None), (3, None), (4, (2024, 2))):
        run_month(spark, lay, write(spark, src, 2024, m, month_rows(2024, m, 4, stray_from=stray)), 2024, m, z)
    backfill(spark, whole, src, z)
    for mart in ("zone_cumulative", "vendor_cumulative"):
        a, b = (spark.read.parquet(x.mart(mart)).drop("created_at", "updated_at") for x in (lay, whole))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
