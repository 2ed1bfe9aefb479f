"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm.common import discard, scratch, written


def components(spark: SparkSession, edges: DataFrame, name: str = "cc") -> DataFrame:
    """vertex, label (the smallest vertex reachable) of every vertex of
    ``edges`` (a, b: long).

    Each round lets every vertex and its present label take the smallest label
    among the vertex's neighbours, then replaces labels by their own labels,
    so labels travel along paths at doubling speed.  Each round is written to
    the shared folder, where it replaces the round before; the loop ends when no
    label changes.
    """
    with scratch(spark) as keep:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        both = written(spark, both.where("a <> b").distinct(), f"{name}-edges")
        labels = written(spark, both.groupBy(F.col("a").alias("v")).agg(
            F.least(F.col("a"), F.min("b")).alias("c")), f"{name}-0")
        round_no = 0
        while True:
            round_no += 1
            near = both.join(labels.select(F.col("v").alias("b"), "c"), "b").groupBy(F.col("a").alias("v")).agg(
                F.min("c").alias("m"))
            seen = labels.select("v", "c").join(near, "v")
            offers = seen.select("v", F.least("c", "m").alias("n")).unionByName(
                seen.select(F.col("c").alias("v"), F.col("m").alias("n")))
            hooked = offers.groupBy("v").agg(F.min("n").alias("n"))
            jumped = hooked.join(hooked.select(F.col("v").alias("n"), F.col("n").alias("nn")), "n", "left")
            new = jumped.select("v", F.least("n", F.coalesce("nn", "n")).alias("c"))
            compared = written(spark, new.join(labels.select("v", F.col("c").alias("old")), "v"), f"{name}-{round_no}")
            discard(spark, labels)
            labels = compared
            if not compared.where("c <> old").limit(1).count():
                return keep(labels).select(F.col("v").alias("vertex"), F.col("c").alias("label"))
