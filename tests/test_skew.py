from pyspark.sql import functions as F

from meterwise.operators.skew import hot_keys, key_distribution, partition_sizes, salted_aggregate, skew_summary


def test_hot_key_is_found_and_salted_sums_are_exact(spark):
    # key 0 holds a third of the rows
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1)
                                  .alias("k"), F.col("id").alias("v"))
    hot = [r.k for r in hot_keys(df, "k", 0.2).collect()]
    assert hot == [0]
    dist = {r.k: r.share for r in key_distribution(df, "k").collect()}
    assert abs(dist[0] - 1 / 3) < 1e-12
    s = skew_summary(df, "k").first()
    assert s.keys == 51 and s.max_rows == 1000 and s.max_share > 0.3
    salted = {r.k: (r.rows, r.sum_v) for r in salted_aggregate(df, ["k"], ["v"], salt_buckets=8).collect()}
    plain = {r.k: (r.rows, r.sum_v) for r in
             df.groupBy("k").agg(F.count("*").alias("rows"), F.sum("v").alias("sum_v")).collect()}
    assert salted == plain
    assert sum(r.rows for r in partition_sizes(df.repartition(4)).collect()) == 3000
