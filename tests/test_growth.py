"""Work of the layered queries that grew faster than their input (files per folder, repeated joins)."""
import os
import re

import pytest
from pyspark.sql import functions as F

from meterwise.plans import fixtures as FX
from meterwise.plans import layers, queries, runner_queries
from tests.test_plans import plan



def trips_in(spark, years, months, parts=8):
    """A trip view of ``parts`` partitions, each holding every month."""
    keys = spark.createDataFrame([(y, m) for y in years for m in months], "y int, m int")
    t = spark.range(0, parts * 4, 1, parts).crossJoin(F.broadcast(keys))
    at = F.make_timestamp("y", "m", F.lit(3), F.lit(8), F.lit(0), F.lit(0))
    money = {c: F.lit(2).cast(FX.DEC) for c in ("trip_distance", "fare_amount", "tip_amount", "tolls_amount",
                                                "total_amount")}
    codes = {c: (F.col("id") % 3 + 1) for c in ("vendor_id", "pickup_location_id", "dropoff_location_id", "ratecode_id",
                                                "payment_type", "passenger_count")}
    return t.withColumns({"pickup_datetime": at, "dropoff_datetime": at + F.expr("interval 9 minutes"),
                          "store_and_fwd_flag": F.lit("N"), **money, **codes}).drop("id", "y", "m")


def files_per_folder(root):
    root = root.removeprefix("file:")
    return {os.path.relpath(at, root): len([f for f in files if f.endswith(".parquet")])
            for at, _, files in os.walk(root) if any(f.endswith(".parquet") for f in files)}


def test_range_sources_do_not_hold_a_file_per_task_and_year(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(runner_queries, "trips", lambda *a: trips_in(spark, (1995, 1996, 1997), (1, 2)))
    monkeypatch.setattr(runner_queries, "zone", lambda *a: None)
    monkeypatch.setattr(runner_queries, "run_range", lambda s, lay, src, *a, **k: (seen.append(src), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        queries.QUERIES["layered_range_run"](spark, "")
    files = files_per_folder(seen[0])
    assert set(files) == {f"year={y}/month=12" for y in (1995, 1996, 1997)} and set(files.values()) == {1}
    assert spark.read.parquet(seen[0]).count() == 8 * 4 * 6


def test_two_variants_join_the_trips_once_and_write_few_files(spark, monkeypatch):
    asked, sources = [], {}

    def view(*a):
        asked.append(a)
        return trips_in(spark, (1995,), (1, 2, 3))

    def stub(s, lay, src, *a):
        sources[lay.variant] = src
        row = s.createDataFrame([(1995, 1)], "year int, month int")
        row.select(F.col("year").alias("pickup_year"), F.col("month").alias("pickup_month")).write.parquet(lay.cleaned)
        row.write.mode("overwrite").parquet(lay.fact)

    monkeypatch.setattr(runner_queries, "trips", view)
    monkeypatch.setattr(runner_queries, "zone", lambda *a: None)
    monkeypatch.setattr(runner_queries, "backfill", stub)
    queries.QUERIES["layered_two_variants"](spark, "")
    assert len(asked) == 1
    rows = {}
    for variant, src in sources.items():
        assert set(files_per_folder(src).values()) == {1}
        rows[variant] = spark.read.parquet(src).count()
    few = trips_in(spark, (1995,), (1, 2, 3)).where("payment_type <= 2").count()
    assert rows == {"yellow": 8 * 4 * 3, "green": few} and 0 < few < 8 * 4 * 3


def test_sources_are_clustered_before_constant_columns_are_added(spark, monkeypatch):
    written = []
    monkeypatch.setattr(queries, "trips", lambda *a: trips_in(spark, (1995,), (1, 2)))
    as_raw = FX.as_variant_raw
    monkeypatch.setattr(queries.FX, "as_variant_raw", lambda t, v: written.append(as_raw(t, v)) or written[0])
    root = queries.scratch(spark, "growth")
    src = queries.write_monthly_sources(spark, "", root)
    moved = re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: (.*)", plan(written[0]))
    assert moved and not any(c in line for line in moved for c in ("Airport_fee", "mta_tax", "congestion_surcharge"))
    assert spark.read.parquet(src).count() == 8 * 4 * 2


def test_bounded_writes_keep_files_open_and_lose_no_row(spark, out):
    from meterwise.session import WRITE_CONF, bounded_writes
    from meterwise.sources.writers import write_partitioned
    assert int(WRITE_CONF["spark.sql.maxConcurrentOutputFileWriters"]) > 1
    df = spark.range(0, 900, 1, 2).select((F.col("id") % 45).alias("month"), "id", F.lit(1).alias("year"))
    bounded_writes(lambda s: write_partitioned(df, out + "/t", mode="static", cluster=False))(spark)
    back = spark.read.parquet(out + "/t")
    assert back.groupBy("month").count().where("count <> 20").count() == 0 and back.select("id").distinct().count() == 900


def test_a_monthly_run_asks_the_load_months_a_few_times(spark, out, monkeypatch):
    source, asked = os.path.join(out, "src"), []
    FX.as_variant_raw(trips_in(spark, (1995,), (1,)), "yellow").write.parquet(source)
    zones = spark.createDataFrame([(i, "b", "z", "s") for i in (1, 2, 3)],
                                  "location_id long, borough string, zone string, service_zone string")
    read = layers.Layout.read
    monkeypatch.setattr(layers.Layout, "read",
                        lambda self, s, path: (asked.append(path), read(self, s, path))[1])
    lay = layers.Layout(os.path.join(out, "wh"))
    layers.run_month(spark, lay, source, 1995, 1, zones, "decimal")
    assert sum(p == lay.load_months for p in asked) <= 4
    assert spark.read.parquet(lay.fact).count() == 8 * 4
