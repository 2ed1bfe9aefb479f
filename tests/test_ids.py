import datetime as dt

from pyspark.sql import functions as F

from meterwise.functions.ids import ORDINAL_BITS, assign_row_ids, content_ids


def frame(spark, n_dup=5, chunk_rows=0):
    rows = []
    for i in range(20):
        rows.append((2024, 1 + i % 2, i, float(i) * 1.5))
    rows += [(2024, 1, 999, 9.99)] * n_dup
    rows += [(2024, 2, 777, 7.77)] * chunk_rows
    return spark.createDataFrame(rows, "pickup_year int, pickup_month int, k long, v double")


def _ids(df, chunk=100_000):
    out = assign_row_ids(df, ["k", "v"], ("pickup_year", "pickup_month"), buckets=8, chunk=chunk)
    return out


def test_unique_dense_and_multiplicity(spark):
    df = frame(spark)
    out = _ids(df)
    assert out.count() == df.count()
    assert out.select("trip_id").distinct().count() == df.count()
    per = {(r.pickup_month): (r.n, r.span) for r in out.groupBy("pickup_month").agg(
        F.count(F.lit(1)).alias("n"), (F.max("trip_id") - F.min("trip_id") + 1).alias("span")).collect()}
    assert all(n == span for n, span in per.values())
    # month scoping: high bits carry the month
    months = {r.trip_id >> ORDINAL_BITS for r in out.collect()}
    assert months == {2024 * 12, 2024 * 12 + 1}
    assert out.where("k = 999").count() == 5


def test_repeatable_across_layouts(spark):
    df = frame(spark)
    a = _ids(df.repartition(3)).collect()
    b = _ids(df.repartition(7).sortWithinPartitions(F.rand(1))).collect()
    key = lambda r: (r.pickup_month, r.k, r.v, r.trip_id)
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_hot_group_is_chunked(spark):
    df = frame(spark, n_dup=2, chunk_rows=35)
    out = _ids(df, chunk=10)
    assert out.count() == df.count()
    assert out.select("trip_id").distinct().count() == df.count()
    assert out.where("k = 777").count() == 35


def test_content_ids_do_not_change_with_later_rows(spark):
    cols = ["pickup_year", "pickup_month", "k", "v"]
    first = frame(spark, n_dup=3, chunk_rows=25)
    late = spark.createDataFrame([(2024, 1, 3, 99.0), (2024, 1, None, 9.99), (2024, 2, 777, 7.77)], first.schema)
    a = {r.trip_id for r in content_ids(first, cols, chunk=10).collect()}
    b = [r.trip_id for r in content_ids(first.unionByName(late).repartition(5), cols, chunk=10).collect()]
    assert len(a) == first.count() and a <= set(b)
    assert len(b) == len(set(b)) == first.count() + 3


def test_content_ids_tell_null_places_apart(spark):
    df = spark.createDataFrame([(1, None, 2), (1, 2, None), (None, 1, 2)], "a int, b int, c int")
    assert content_ids(df, ["a", "b", "c"]).select("trip_id").distinct().count() == 3


def test_content_ids_shuffle_wide_rows_once(spark):
    plan = content_ids(frame(spark), ["pickup_year", "pickup_month", "k", "v"])._jdf.queryExecution().executedPlan()
    # the grouping appears once per branch (reused when it runs) and the chunk
    # rows of very frequent rows move once more
    assert plan.toString().count("Exchange hashpartitioning") <= 3
