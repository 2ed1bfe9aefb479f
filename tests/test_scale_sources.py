"""Compaction by file size (W9), scans per schema (S12), digests (V8), quarantine
(F8) and event-log figures (M1)."""

import os
import re
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterwise.operators import digests as D
from meterwise.operators import quarantine as K
from meterwise.operators.clean import clean
from meterwise.sources import compaction as W
from meterwise.sources import publish as P
from meterwise.sources.readers import read_loads, schema_groups
from tests.test_layers import SCHEMA, month_rows

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.path.getsize(os.path.join(d, f))
            for d, _, names in os.walk(path) for f in names
            if f.endswith(".parquet") and f[0] not in "._" and "_compaction" not in os.path.relpath(d, path)}


# ---- W9

@pytest.fixture
def table(spark, out):
    path = f"{out}/t"
    noise = F.sha2(F.col("id").cast("string"), 512)  # about 130 bytes a row
    rows = spark.range(4_000).select("id", noise.alias("x"))
    for part, sizes in (("a=1", [3_000, 100, 150, 200]), ("a=2", [50, 60]), ("a=3", [70]), ("a=4/b=x", [80, 90, 100])):
        at = 0
        for n in sizes:
            rows.where(F.col("id").between(at, at + n - 1)).coalesce(1).write.mode("append").parquet(f"{path}/{part}")
            at += n
    # A later file has a column more.
    rows.where("id < 40").withColumn("late", F.lit(1)).coalesce(1).write.mode("append").parquet(f"{path}/a=2")
    return path


def content(spark, path):
    df = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(path)
    return Counter(map(str, df.select("id", "x", "late").collect()))


def test_compaction_rewrites_small_files_only(spark, table):
    before, rows = files(table), content(spark, table)
    large = {f: n for f, n in before.items() if n > 100_000}
    got = W.compact_small(spark, table, target_bytes=200_000)
    after = files(table)
    alone = {f for f in before if f.startswith("a=3")}
    assert len(large) == 1 and large.items() <= after.items() and alone <= set(after)
    gone = set(before) - set(after)
    assert gone == set(before) - set(large) - alone
    assert got == {"files_read": len(gone), "bytes_read": sum(before[f] for f in gone), "files_written": 3}
    assert content(spark, table) == rows and len(after) == 5
    assert not os.path.exists(f"{table}/_compaction")
    # A second run finds nothing to do.
    assert W.compact_small(spark, table, target_bytes=200_000)["files_read"] == 0 and files(table) == after


def test_packs_stay_near_the_target(spark):
    sizes = spark.createDataFrame([(f"f/{i:03d}", "f", 10 + i % 7) for i in range(200)], "file string, folder string, bytes long")
    packs = Counter()
    for r in W.compaction_plan(sizes, 100, 50).collect():
        packs[r["pack"]] += r["bytes"]
    assert sum(packs.values()) == sum(10 + i % 7 for i in range(200)) and max(packs.values()) < 100 + 17


@pytest.mark.parametrize("after_moves", [0, 2, 6])
def test_compaction_that_dies(spark, table, monkeypatch, after_moves):
    rows, before, done, move = content(spark, table), files(table), [], P.move

    def dies(spark, a, b):
        if len(done) == after_moves:
            raise KeyboardInterrupt
        done.append(a)
        move(spark, a, b)

    with monkeypatch.context() as m:
        m.setattr(W, "move", dies)
        with pytest.raises(KeyboardInterrupt):
            W.compact_small(spark, table, target_bytes=200_000)
    if after_moves < 3:  # before the journal
        assert files(table) == before
    assert W.finish_compaction(spark, table) == (after_moves > 3)
    assert content(spark, table) == rows and not os.path.exists(f"{table}/_compaction")
    W.compact_small(spark, table, target_bytes=200_000)
    assert content(spark, table) == rows and len(files(table)) == 5
    hidden = [f for _, _, names in os.walk(table) for f in names if f.startswith("_compacted")]
    assert not hidden


# ---- S12

def test_one_scan_per_schema(spark, out):
    kinds = ["double", "int", "bigint"]
    loads = [(2000 + i // 12, i % 12 + 1) for i in range(24)]
    for n, (y, m) in enumerate(loads):
        df = spark.range(2).select(F.col("id").alias("k"), F.lit(n).cast(kinds[n % 3]).alias("v"))
        df.coalesce(1).write.parquet(f"{out}/src_year={y}/src_month={m}")
    paths = [f"{out}/src_year={y}/src_month={m}" for y, m in loads]
    groups = schema_groups(spark, paths)
    assert [len(g) for _, g in groups] == [8, 8, 8] and sorted(p for _, g in groups for p in g) == sorted(paths)
    for asked in (None, loads):
        df = read_loads(spark, out, asked)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 3 and dict(df.dtypes)["v"] == "double"
        assert {(r["src_year"], r["src_month"]): r["v"] for r in df.collect()} == {
            k: float(n) for n, k in enumerate(loads)}


# ---- V8

def test_digests(spark, out):
    rows = [(d, i, None if i % 7 == 0 else f"s{i}", float(i)) for d in (1, 2, 3, None) for i in range(50)]
    a = spark.createDataFrame(rows, "d int, i int, s string, x double")
    digests = D.partition_digests(a, ["d"])
    same = D.partition_digests(a.repartition(5).orderBy(F.rand(3)), ["d"])
    assert D.differing_partitions(digests, same, ["d"]).count() == 0
    changed = a.withColumn("x", F.when((F.col("d") == 2) & (F.col("i") == 9), 1e9).otherwise(F.col("x")))
    got = D.equivalence_by_digests(a, changed, ["d"]).first().asDict()
    assert got == {"partitions": 4, "differing": 1, "compared_a": 50, "compared_b": 50, "left_only": 1, "right_only": 1}
    for other, n in ((a.unionByName(a.where("d = 3 and i < 2")), 2), (a.where("d is not null"), 50)):
        for listed in (1_000, 0):
            got = D.equivalence_by_digests(a, other, ["d"], most_listed=listed).first()
            assert got["differing"] == 1 and got["left_only"] + got["right_only"] == n
    # A value that moves to its neighbour column is a change.
    b = spark.createDataFrame([(1, "u", None)], "d int, s string, t string")
    c = spark.createDataFrame([(1, None, "u")], "d int, s string, t string")
    assert D.equivalence_by_digests(b, c, ["d"]).first()["differing"] == 1
    D.save_digests(spark, f"{out}/digests", "run-1", "fact", digests)
    D.save_digests(spark, f"{out}/digests", "run-1", "fact", digests)
    kept = spark.read.parquet(f"{out}/digests").where("run_id = 'run-1' and layer = 'fact'")
    assert kept.count() == 4 and D.differing_partitions(kept, same, ["d"]).count() == 0


def test_digests_read_differing_folders_only(spark, out):
    a = spark.range(90).select((F.col("id") % 9).cast("int").alias("d"), "id")
    a.write.partitionBy("d").parquet(f"{out}/a")
    a.where("id <> 13").write.partitionBy("d").parquet(f"{out}/b")
    left, right = spark.read.parquet(f"{out}/a"), spark.read.parquet(f"{out}/b")
    da, db = (D.partition_digests(x, ["d"]) for x in (left, right))
    got = D.equivalence_by_digests(left, right, ["d"], da, db)
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[(.*?)\]", plan)
    assert len(filters) == 2 and all(re.search(r"d#\d+ = 4", f) for f in filters) and got.first()["left_only"] == 1


# ---- F8

def test_quarantine_and_replay(spark, out):
    raw = spark.createDataFrame(month_rows(2024, 1, 6) + month_rows(2024, 2, 5), SCHEMA)
    raw = raw.withColumns({"src_year": F.lit(2024), "src_month": F.month(F.col("tpep_pickup_datetime"))})
    bad = raw.withColumn("fare_amount", F.lit(-1.0)).unionByName(raw.withColumn("passenger_count", F.lit(None).cast("double")))
    every = raw.unionByName(bad.select(*raw.columns))
    minutes = clean(raw, "yellow", load_ts=False).agg(F.max("trip_duration_min"), F.min("trip_duration_min")).first()
    strict = (minutes[0] + minutes[1]) / 2 if minutes[0] > minutes[1] else minutes[0] - 0.01
    K.write_split(K.split_rows(every, max_minutes=strict), f"{out}/one")
    K.replay(spark, f"{out}/one", f"{out}/two")
    rows = lambda df: Counter(map(str, df.select(*sorted(df.columns)).collect()))
    first, rest = K.kept_rows(spark, f"{out}/one"), K.rejected_rows(spark, f"{out}/one")
    assert first.count() + rest.count() == every.count()
    keep = ("src_year", "src_month")
    assert rows(first) == rows(clean(every, "yellow", max_minutes=strict, load_ts=False, keep=keep))
    both = first.unionByName(K.kept_rows(spark, f"{out}/two"))
    assert rows(both) == rows(clean(every, "yellow", load_ts=False, keep=keep)) and both.count() == raw.count()
    left = K.rejected_rows(spark, f"{out}/two")
    named = Counter(r for x in left.collect() for r in x["failed"])
    assert named["fare_amount_positive"] == 11 and named["passenger_count_positive"] == 11 and left.count() == 22
    assert rows(left.drop("failed")) == rows(bad.select(*raw.columns))


# ---- M1, A19

SKEWED = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + sys.argv[1])
         .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
         .config("spark.sql.adaptive.enabled", "false").config("spark.sql.shuffle.partitions", "8").getOrCreate())
key = F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 500)
spark.range(0, 600000, 1, 4).select(key.alias("k"), "id").repartition(8, "k").sortWithinPartitions("id").write.format(
    "noop").mode("overwrite").save()
spark.stop()
"""


def test_event_log_figures(spark, out):
    from meterwise.sources import eventlog as E
    os.makedirs(f"{out}/log")
    subprocess.run([sys.executable, "-c", SKEWED, f"{out}/log"], check=True, timeout=300, capture_output=True, cwd=ROOT)
    events = E.read_events(spark, f"{out}/log")
    stages = {r["tasks"]: r for r in E.stage_figures(events).collect()}
    assert set(stages) == {4, 8}
    wide, skewed = stages[4], stages[8]
    assert wide["shuffle_written"] > 0 and skewed["rows_read"] == 600_000
    assert skewed["row_skew"] > 5 and skewed["max_rows"] > 400_000 and skewed["max_run_ms"] >= skewed["median_run_ms"]
    total = E.run_figures(events).first()
    assert (total["stages"], total["tasks"], total["failed_tasks"]) == (2, 12, 0)
    assert total["worst_row_skew"] == skewed["row_skew"] and total["disk_spilled"] == 0
    # The same skew as counted by keys: what the largest partition holds.
    from meterwise.operators.skew import partition_sizes
    key = F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 500)
    sizes = partition_sizes(spark.range(0, 600_000, 1, 4).select(key.alias("k")).repartition(8, "k"))
    assert sizes.agg(F.max("rows")).first()[0] == skewed["max_rows"]
