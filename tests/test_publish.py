"""A run is published after success; a failed one leaves every layer as it was."""

import os
from collections import Counter

import pytest

from meterwise.plans import layers
from meterwise.plans.layers import Layout, backfill, run_month
from meterwise.sources import publish as P
from tests.test_runner_regressions import month_rows, write, zone_dim


def state(spark, lay):
    """Rows of every layer, but for load times and the run log."""
    paths = {"raw": lay.raw, "cleaned": lay.cleaned, "fact": lay.fact, "load_months": lay.load_months,
             "dim_vendor": lay.dim_vendor, **{f"dim_{n}": lay.dim(n) for n in ("zone", "date", "time")},
             **{m: lay.mart(m) for m in lay.marts}}
    out = {}
    for name, path in paths.items():
        df = spark.read.parquet(path)
        keep = [c for c in df.columns if c not in ("created_at", "updated_at", "load_ts")]
        out[name] = Counter(map(str, df.select(*sorted(keep)).collect()))
    return out


@pytest.fixture
def loaded(spark, out):
    src, z, lay = os.path.join(out, "src"), zone_dim(spark), Layout(os.path.join(out, "lay"))
    first = write(spark, src, 2024, 1, month_rows(2024, 1, 5))
    second = write(spark, src, 2024, 2, month_rows(2024, 2, 4))
    run_month(spark, lay, first, 2024, 1, z)
    return lay, z, second


def test_failed_run_leaves_all_layers(spark, loaded, monkeypatch):
    lay, z, second = loaded
    before = state(spark, lay)
    with monkeypatch.context() as m:
        m.setattr(layers, "validate_written", lambda *a: {
            "fact_rows": 4, "mart_trip_sum": 3, "amount_diff": 1.0, "passed": False})
        with pytest.raises(ValueError, match="validation"):
            run_month(spark, lay, second, 2024, 2, z)
        # An emptied first month that fails must not take anything away either.
        empty = spark.read.parquet(second).limit(0)
        path = os.path.join(lay.root, "..", "empty")
        empty.write.parquet(path)
    with monkeypatch.context() as m:
        m.setattr(layers, "build_marts", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_month(spark, lay, path, 2024, 1, z, allow_empty=True)
        with pytest.raises(ZeroDivisionError):
            run_month(spark, lay, second, 2024, 2, z)
    assert state(spark, lay) == before
    assert not P.partitions(spark, f"{lay.root}/_staging") and not os.listdir(f"{lay.root}/_staging")
    run_month(spark, lay, second, 2024, 2, z)
    assert len(spark.read.parquet(lay.fact).select("month").distinct().collect()) == 2


def test_run_that_dies_while_publishing_is_finished(spark, loaded, out, monkeypatch):
    lay, z, second = loaded
    move, done = P.move, []

    def dies(spark, source, target):
        if len(done) == 3:
            raise KeyboardInterrupt
        done.append(source)
        move(spark, source, target)

    with monkeypatch.context() as m:
        m.setattr(P, "move", dies)
        with pytest.raises(KeyboardInterrupt):
            run_month(spark, lay, second, 2024, 2, z)
    assert len(P.recover(spark, lay.root)) == 1 and P.recover(spark, lay.root) == []
    other = Layout(os.path.join(out, "other"))
    for month in (1, 2):
        run_month(spark, other, os.path.join(out, "src", "year=2024", f"month={month:02d}"), 2024, month, z)
    assert state(spark, lay) == state(spark, other)


def test_failed_rebuild_leaves_all_layers(spark, loaded, out, monkeypatch):
    lay, z, _ = loaded
    before = state(spark, lay)
    with monkeypatch.context() as m:
        m.setattr(layers, "validate_written", lambda *a: {
            "fact_rows": 4, "mart_trip_sum": 3, "amount_diff": 1.0, "passed": False})
        with pytest.raises(ValueError, match="validation"):
            backfill(spark, lay, os.path.join(out, "src"), z)
    assert state(spark, lay) == before
    backfill(spark, lay, os.path.join(out, "src"), z)
    assert spark.read.parquet(lay.fact).count() == 9


def test_folders(spark, out):
    spark.range(6).selectExpr("id", "id % 2 as a", "id % 3 as b").write.partitionBy("a", "b").parquet(f"{out}/t")
    assert P.partitions(spark, f"{out}/t") == sorted(f"a={i % 2}/b={i % 3}" for i in range(6))
    spark.range(1).write.parquet(f"{out}/u")
    os.makedirs(f"{out}/none")
    assert P.partitions(spark, f"{out}/u") == [""] and P.has_data(spark, f"{out}/u")
    assert P.partitions(spark, f"{out}/none") == P.partitions(spark, f"{out}/absent") == []


def test_switch_partition(spark, out):
    from meterwise.sources.catalog import add_month_partition, register_table, switch_partition
    for name, n in (("old", 3), ("new", 5)):
        spark.range(n).write.parquet(f"{out}/{name}/year=2024/month=1")
    register_table(spark, "switched", f"{out}/old", "id BIGINT, year INT, month INT")
    add_month_partition(spark, "switched", f"{out}/old", 2024, 1)
    assert spark.table("switched").count() == 3
    switch_partition(spark, "switched", 2024, 1, f"{out}/new/year=2024/month=1")
    spark.catalog.refreshTable("switched")
    assert spark.table("switched").count() == 5
    spark.sql("DROP TABLE switched")
