"""Operator 10: mix sources to target weights by capped water-filling.

``source_targets`` gives every source its share of the budget, never above
``max_epochs`` times its size; what a capped source cannot take is reshared by
weight among the others.  ``mix`` then takes every document a whole number of
times plus, for the fractional part, a seeded choice of documents, the last of
them in part.

Defined cases: a null text has size 0 and is taken 0 words; a null source is a
source of its own, last in order; a repeated row is a document of its own (the
copy number enters its random key); a source of size 0 has target 0; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterwise.llm.common import as_written, n_words, read_table, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
# A source is cut into this many slices of its random order; only the slice in
# which the target falls is ordered row by row.
SLICES = 1024
KEY_BITS = 60


def random_key(*parts: Column) -> Column:
    """60 seeded bits of an md5, the same on every run and engine."""
    text = F.concat_ws(":", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and the random key of every row."""
    narrow = as_written(docs, "doc_id", "source", "text").select(
        "doc_id", "source", n_words(F.col("text")).alias("size"))
    copies = Window.partitionBy("doc_id").orderBy("source", "size")
    return (narrow.withColumn("copy", F.row_number().over(copies))
            .withColumn("key", random_key(F.col("doc_id"), F.col("copy"))))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target from rows (source, size).

    With the sources ordered by cap / weight, the fill level after capping the
    first i of them is (budget - their caps) / (weight of the rest); a source
    is capped when its cap / weight lies at or below the level at its turn.
    The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), nth.cast("int") + 1)
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    ranked = (per.withColumn("weight", weight).withColumn("cap", cap)
              .withColumn("ratio", F.col("cap") / F.col("weight")))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    zero = F.lit(0.0)
    level = ((F.lit(float(share)) * F.sum("source_size").over(everything)
              - F.coalesce(F.sum("cap").over(before), zero))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)))
    filled = ranked.withColumn("level", level)
    # The level only rises while sources are capped, so the first source that
    # is not capped sees the final one.
    final = F.min(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything)
    target = F.when(F.col("ratio") <= F.col("level"), F.col("cap")).otherwise(
        F.col("weight") * F.col("final"))
    return filled.withColumn("final", final).select("source", "source_size", target.alias("target"))


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, source, size, copy, source_size, target, repeats, part, taken.

    The fractional part of a source is a run of its seeded order: documents
    are taken while their running size fits, and the next one in part, so that
    the source comes within a word of its target.
    """
    sized = written(spark, sized_documents(docs), "mix-sized")
    targets = written(spark, source_targets(sized, weights, share, max_epochs), "mix-targets")
    want = targets.select(
        F.col("source").alias("s_source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("long").alias("whole"))
    want = want.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))

    slice_no = F.shiftright(F.col("key"), KEY_BITS - (SLICES.bit_length() - 1))
    rows = sized.withColumn("slice", slice_no)
    ahead = Window.partitionBy("b_source").orderBy("b_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (rows.groupBy(F.col("source").alias("b_source"), F.col("slice").alias("b_slice"))
              .agg(F.sum("size").alias("b_size"))
              .withColumn("b_before", F.coalesce(F.sum("b_size").over(ahead), F.lit(0))))
    slices = (slices.join(want, F.col("b_source").eqNullSafe(F.col("s_source")))
              .withColumn("place", F.when(F.col("b_before") + F.col("b_size") <= F.col("rest"), "in")
                          .when(F.col("b_before") > F.col("rest"), "out").otherwise("edge")))
    rows = rows.join(slices.drop("s_source"), F.col("source").eqNullSafe(F.col("b_source"))
                     & (F.col("slice") == F.col("b_slice")))
    upto = (Window.partitionBy("source").orderBy("key", "doc_id", "copy")
            .rowsBetween(Window.unboundedPreceding, 0))
    keep = ["doc_id", "source", "size", "copy", "key", "source_size", "target", "whole", "rest"]
    edge = (rows.where("place = 'edge'")
            .withColumn("chosen", F.col("b_before") + F.sum("size").over(upto) <= F.col("rest")))
    plain = rows.where("place <> 'edge'").withColumn("chosen", F.col("place") == "in")
    picked = written(spark, plain.select(*keep, "chosen").unionByName(edge.select(*keep, "chosen")),
                     "mix-picked")

    edges = picked.groupBy(F.col("source").alias("e_source")).agg(
        F.floor(F.first("rest") - F.sum(F.when(F.col("chosen"), F.col("size")).otherwise(0))).alias("gap"),
        F.min(F.when(~F.col("chosen") & (F.col("size") > 0), F.struct("key", "doc_id", "copy"))).alias("e"))
    joined = picked.join(edges, F.col("source").eqNullSafe(F.col("e_source")))
    is_edge = (F.col("e").isNotNull() & (F.col("key") == F.col("e.key"))
               & F.col("doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("copy") == F.col("e.copy")))
    joined = (joined.withColumn("repeats", F.col("whole") + F.when(F.col("chosen"), 1).otherwise(0))
              .withColumn("part", F.when(is_edge, F.col("gap")).otherwise(0).cast("long")))
    return joined.select(
        "doc_id", "source", "size", "copy", "source_size", "target", "repeats", "part",
        (F.col("size") * F.col("repeats") + F.col("part")).alias("taken"))


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix repeats it; of a
    document taken in part, the first words follow as one more row (joined by
    single spaces).  Rows without words have nothing to take and stay once."""
    numbered = docs.withColumn("mix_size", n_words(F.col("text"))).withColumn(
        "mix_copy", F.row_number().over(Window.partitionBy("doc_id").orderBy("source", "mix_size")))
    plan = mix(spark, docs, **options).select(
        F.col("doc_id").alias("mix_doc"), F.col("copy").alias("mix_nth"),
        F.when(F.col("size") == 0, 1).otherwise(F.col("repeats")).cast("int").alias("mix_repeats"),
        F.col("part").cast("int").alias("mix_part"))
    joined = numbered.join(plan.where("mix_repeats > 0 or mix_part > 0"),
                           F.col("doc_id").eqNullSafe(F.col("mix_doc"))
                           & (F.col("mix_copy") == F.col("mix_nth")))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    texts = F.array_repeat(F.col("text"), F.col("mix_repeats"))
    texts = F.when(F.col("mix_part") > 0, F.concat(texts, F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("mix_part")), " ")))).otherwise(texts)
    return (joined.withColumn("mix_text", F.explode(texts)).drop("text")
            .withColumnRenamed("mix_text", "text").select(*docs.columns))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "repeats", "part")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents),
keyed AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY source, size) AS copy FROM sized),
k AS (
  SELECT *, ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy::VARCHAR), 1, 15))::BIGINT AS key
  FROM keyed),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM per),
c AS (SELECT *, 2.0::DOUBLE * source_size AS cap FROM w),
l AS (
  SELECT *, cap / weight AS ratio,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM c WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
    CASE WHEN ratio <= level THEN cap
         ELSE weight * min(CASE WHEN ratio > level THEN level END) OVER () END AS target FROM l),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
run AS (
  SELECT k.*, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS rest,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.copy ROWS UNBOUNDED PRECEDING)
      <= r.target - r.whole * r.source_size AS chosen
  FROM k JOIN r ON k.source IS NOT DISTINCT FROM r.source),
g AS (
  SELECT *, floor(rest - sum(CASE WHEN chosen THEN size ELSE 0 END) OVER (PARTITION BY source))::BIGINT AS gap,
    NOT chosen AND size > 0 AS may FROM run),
e AS (
  SELECT *, may AND row_number() OVER (PARTITION BY source ORDER BY may DESC, key, doc_id, copy) = 1 AS edge FROM g)
SELECT doc_id, size, source_size, target,
  size * (whole + CASE WHEN chosen THEN 1 ELSE 0 END) + CASE WHEN edge THEN gap ELSE 0 END AS taken,
  source, whole + CASE WHEN chosen THEN 1 ELSE 0 END AS repeats, CASE WHEN edge THEN gap ELSE 0 END AS part
FROM e
"""
