"""Operator 6: sharding over fixed virtual slots (native).

Records hash into thousands of slots; bytes are summed per slot; a versioned
map sends slots to shards and is edited, not rebuilt, when rebalancing.  The
law kept is ``bytes``: shard sizes are near equal.  The query stores two versions of
the map, the second edited from the first for one shard more, and places
records by the first; ``next_shard`` is where the second has them.

Defined cases: a null text has size 1 and the checksum of the empty text; a
null doc_id hashes like any value; equal records are counted together and hashed in
chunks of ``COPIES``, so that a row repeated very often spreads over slots and tasks,
and take consecutive places within a chunk; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterwise.llm.common import as_written, read_table, work_path, written

SLOTS = 4096
SHARDS = 16
# Equal records that share a slot.
COPIES = 256


def records(docs: DataFrame, slots: int = SLOTS, copies: int = COPIES) -> DataFrame:
    """doc_id, size, text_crc32, chunk, copies and virtual_slot: one row for
    up to ``copies`` equal records.  The checksum and the chunk enter the hash, so rows
    sharing one doc_id, and equal rows, still spread out."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = as_written(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"))
    equal = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    chunks = equal.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / copies))))
    key = F.xxhash64("doc_id", "text_crc32", "size", "chunk")
    return chunks.select("doc_id", "size", "text_crc32", "chunk",
                         F.least(F.lit(copies).cast("long"), F.col("n") - F.col("chunk") * copies).alias("copies"),
                         F.pmod(key, F.lit(slots)).cast("int").alias("virtual_slot"))


def slot_loads(rows: DataFrame) -> DataFrame:
    """Rows and bytes of each slot in use: at most as many rows as slots."""
    return rows.groupBy("virtual_slot").agg(
        F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"))


def _lightest(loads):
    return F.array_position(loads, F.array_min(loads)).cast("int")


def first_map(loads: DataFrame, shards: int = SHARDS, version: int = 1) -> DataFrame:
    """Version 1 of the slot map: slots in falling size, each to the shard
    that is lightest at its turn (one array of at most ``SLOTS`` entries)."""
    slots = F.array_sort(F.collect_list(F.struct(
        (-F.col("bytes")).alias("minus"), F.col("virtual_slot").alias("slot"), F.col("rows").alias("n"))))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("load"),
                     F.array().cast("array<int>").alias("to"))

    def place(state, x):
        at = _lightest(state["load"])
        load = F.transform(state["load"], lambda v, i: F.when(i == at - 1, v - x["minus"]).otherwise(v))
        return F.struct(load.alias("load"), F.concat(state["to"], F.array(at - 1)).alias("to"))

    packed = (loads.agg(slots.alias("slots"))
              .withColumn("to", F.aggregate("slots", start, place, lambda s: s["to"])))
    out = packed.select(F.explode(F.arrays_zip("slots", "to")).alias("z"))
    return out.select(
        F.lit(version).alias("version"), F.col("z.slots.slot").alias("virtual_slot"),
        F.col("z.to").alias("shard"), (-F.col("z.slots.minus")).alias("bytes"),
        F.col("z.slots.n").alias("rows"))


def grown_map(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version of a map for one shard more: every shard gives the
    slots at the light end of its list until it is down to the new mean; all
    moves go into the new shard, every other slot stays where it is."""
    mean = F.sum("bytes").over(Window.partitionBy()) / F.lit(shards + 1)
    order = Window.partitionBy("shard").orderBy(F.col("bytes").desc(), "virtual_slot").rowsBetween(
        Window.unboundedPreceding, 0)
    kept = F.sum("bytes").over(order) <= F.col("mean")
    return (slot_map.withColumn("mean", mean).withColumn("kept", kept)
            .select((F.col("version") + 1).alias("version"), "virtual_slot",
                    F.when(F.col("kept"), F.col("shard")).otherwise(shards).alias("shard"),
                    "bytes", "rows"))


def store_map(spark: SparkSession, slot_map: DataFrame, path: str) -> DataFrame:
    """Append one version to the stored map and read that version back."""
    slot_map.write.mode("append").partitionBy("version").parquet(path)
    return spark.read.parquet(path)


def place(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Shard and gapless place of each record: the records of a slot are
    numbered among themselves and slots follow each other within a shard, so
    no task ever orders a whole shard."""
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = slot_map.select("virtual_slot", "shard",
                             F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    numbered = rows.withColumn("nth", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return numbered.join(starts, "virtual_slot").withColumn("copy", each).withColumn(
        "slot", F.col("first") + F.col("nth") + F.col("copy"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(spark, records(read_table(spark, sf_dir, "documents")), "shard-records")
    path = work_path(spark, "slot-map")
    first = store_map(spark, first_map(slot_loads(rows)), path).where("version = 1")
    second = store_map(spark, grown_map(first, SHARDS), path).where("version = 2")
    grown = second.select("virtual_slot", F.col("shard").cast("int").alias("next_shard"))
    return place(rows, first).join(grown, "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "next_shard")
