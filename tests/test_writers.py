"""Regression inputs 1-4 (FIXTURES.md section 4) as literal frames."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType, TimestampType

from meterwise.sources.readers import read_months_drift_safe, read_source
from meterwise.sources.writers import partition_counts, save_by_data_month, save_month, write_partitioned


def trips(spark, month, n, stray=0, fee_type="double"):
    rows = [(dt.datetime(2024, month, 5, 10, i), float(i)) for i in range(n)]
    rows += [(dt.datetime(2024, month - 1, 28, 9, i), float(i)) for i in range(stray)]
    df = spark.createDataFrame(rows, "pickup timestamp, fee double")
    return df.withColumn("fee", F.col("fee").cast(fee_type))


def test_dynamic_two_months_two_runs(spark, out):
    p = os.path.join(out, "t")
    save_by_data_month(trips(spark, 1, 3), p, "pickup", mode="dynamic")
    save_by_data_month(trips(spark, 2, 4), p, "pickup", mode="dynamic")
    got = {(r.year, r.month): r.rows for r in partition_counts(spark, p).collect()}
    assert got == {(2024, 1): 3, (2024, 2): 4}
    # static replaces the whole table: only the second month survives
    save_by_data_month(trips(spark, 2, 4), p, "pickup", mode="static")
    got = {(r.year, r.month): r.rows for r in partition_counts(spark, p).collect()}
    assert got == {(2024, 2): 4}


def test_stray_rows_do_not_wipe_previous_month(spark, out):
    """5 January rows, then a February file with 5 + 1 stray January row."""
    unsafe = os.path.join(out, "unsafe")
    save_by_data_month(trips(spark, 1, 5), unsafe, "pickup", mode="dynamic")
    save_by_data_month(trips(spark, 2, 5, stray=1), unsafe, "pickup", mode="dynamic")
    got = {(r.year, r.month): r.rows for r in partition_counts(spark, unsafe).collect()}
    assert got[(2024, 1)] == 1  # the reference's failure mode, reproduced

    safe = os.path.join(out, "safe")
    save_month(trips(spark, 1, 5), safe, 2024, 1)
    save_month(trips(spark, 2, 5, stray=1), safe, 2024, 2)
    save_month(trips(spark, 2, 5, stray=1), safe, 2024, 2)  # rerun: idempotent
    got = {(r.src_year, r.src_month): r.rows for r in
           partition_counts(spark, safe, "src_year", "src_month").collect()}
    assert got == {(2024, 1): 5, (2024, 2): 6}
    by_pickup = spark.read.parquet(safe).where(F.month("pickup") == 1).count()
    assert by_pickup == 6


def test_int32_and_double_files(spark, out):
    a, b = os.path.join(out, "m1"), os.path.join(out, "m2")
    trips(spark, 1, 3, fee_type="int").write.parquet(a)
    trips(spark, 2, 3, fee_type="double").write.parquet(b)
    schema = StructType([StructField("pickup", TimestampType()), StructField("fee", DoubleType())])
    # explicit widened schema over INT32 + DOUBLE files
    assert read_source(spark, [a, b], schema=schema).count() == 6
    # general path: per-month read, cast, union by name
    df = read_months_drift_safe(spark, {(2024, 1): a, (2024, 2): b}, schema)
    assert dict(df.dtypes)["fee"] == "double" and df.count() == 6


def test_four_months_alternating(spark, out):
    paths = {}
    for m in (1, 2, 3, 4):
        p = os.path.join(out, f"alt{m}")
        trips(spark, m + 1, 2, fee_type="int" if m % 2 else "double").write.parquet(p)
        paths[(2024, m)] = p
    schema = StructType([StructField("pickup", TimestampType()), StructField("fee", DoubleType())])
    df = read_months_drift_safe(spark, paths, schema)
    assert df.count() == 8
    assert sorted(r.src_month for r in df.select("src_month").distinct().collect()) == [1, 2, 3, 4]


def test_csv_fallback(spark, out):
    p = os.path.join(out, "csv")
    trips(spark, 1, 3).write.option("header", "true").csv(p)
    df = read_source(spark, p)
    assert df.count() == 3
    with pytest.raises(ValueError):
        empty = os.path.join(out, "empty")
        trips(spark, 1, 0).write.parquet(empty)
        read_source(spark, empty, require_rows=True)


def test_files_per_partition(spark, out):
    p = os.path.join(out, "fpp")
    df = spark.range(1000).withColumns({"year": F.lit(2024), "month": (F.col("id") % 2 + 1).cast("int")})
    write_partitioned(df, p, ("year", "month"), mode="static", files_per_partition=3)
    files = [f for f in os.listdir(os.path.join(p, "year=2024", "month=1")) if f.endswith(".parquet")]
    assert 1 <= len(files) <= 3
    assert spark.read.parquet(p).count() == 1000


def test_empty_rerun_clears_the_load(spark, out):
    p = os.path.join(out, "loads")
    save_month(trips(spark, 1, 3), p, 2024, 1)
    save_month(trips(spark, 2, 4), p, 2024, 2)
    save_month(trips(spark, 2, 0), p, 2024, 2)  # February rerun produced nothing
    got = {(r.src_year, r.src_month): r.rows for r in
           partition_counts(spark, p, "src_year", "src_month").collect()}
    assert got == {(2024, 1): 3}
