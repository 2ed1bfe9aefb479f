"""Operator 12: SimHash near-duplicates through pigeonring filtering.

A text's fingerprint has a bit set where over half of its four-word shingles
(repeats included) have it set in their XXH64.  Fingerprints link when they differ in at
most four bits.

The 64 bits form a ring of seven segments.  If two fingerprints differ in at
most four bits, then for some segment *all* chains of consecutive segments that
start there stay within their share of the four: one segment has no difference,
the first two and the first three at most one, four and five at most two, six at most
three.  A fingerprint is indexed seven times by the 27 or 28 bits of three
consecutive segments; it asks for these bits and for the same with one bit of
the second and third segment flipped.  As one of two differing bits is
zero, only zero bits are flipped.  What meets in a bucket passes the longer chains and
then the full check.  Equal fingerprints count once throughout.

A bucket that indexes more than ``HOT`` fingerprints is not compared pair by
pair.  Its members are sent to every point within two bits of them in
the bits that the bucket leaves free (one bit for those that spent one on the
bucket): two fingerprints within four bits share such a point, and those that
share a point are within four bits.  A point has at most 2,081 members, which link as a
star.  So the rows made grow with the number of fingerprints, not of pairs.

Defined cases: null and empty texts and texts without words have fingerprint
zero, linked like any other; texts of fewer than four words have one shingle;
ties (a bit set in exactly half) are zero; repeated rows are each returned; a
null doc_id is returned and never the smallest of its class unless it is alone there
(component_id null); an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm.common import read_table, scratch, written
from meterwise.llm.components import components

WORDS = 4
SEED = 42
DISTANCE = 4
# Bits of the segments, from the lowest bit on, and segments of a bucket's key.
SEGMENTS = (9, 9, 9, 9, 9, 9, 10)
CHAIN = 3
# A bucket that indexes more fingerprints is searched by points.
HOT = 64

MARKED = "doc_id long, fp long"


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if len(words) > WORDS:
        ends, starts = ends[WORDS - 1:], starts[:1 - WORDS]
    else:
        ends, starts = ends[-1:], starts[:1]
    hashed = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())),
                         "<u8", len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashed), 65_536):
        part = hashed[at:at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashed), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every row."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                marks = np.array([fingerprint(t) for t in part.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(marks.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").alias("text"))
    return rows.mapInArrow(make, MARKED)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _starts() -> list[int]:
    return [sum(SEGMENTS[:i]) for i in range(len(SEGMENTS))]


def _bits(chain: int, length: int) -> int:
    """Bits of the first ``length`` segments of a chain."""
    return sum(SEGMENTS[(chain + j) % len(SEGMENTS)] for j in range(length))


def allowed(length: int) -> int:
    """Differences within a chain's share."""
    return DISTANCE * length // len(SEGMENTS)


def _turned(fp: str, start: str) -> Column:
    """A fingerprint turned so that a chain's first segment is lowest (a shift
    by 64 is one by 0, so the first chain's is as it was)."""
    return F.expr(f"shiftrightunsigned({fp}, {start}) | shiftleft({fp}, 64 - {start})")


def _asked(flips: bool) -> Column:
    """Constant rows (chain, start, mask of the key, bit to flip or 0)."""
    rows = []
    for chain, start in enumerate(_starts()):
        mask = (1 << _bits(chain, CHAIN)) - 1
        bits = range(_bits(chain, 1), _bits(chain, CHAIN)) if flips else ()
        rows += [(chain, start, mask, flip) for flip in [0, *(1 << b for b in bits)]]
    return F.array(*[F.struct(F.lit(c).alias("chain"), F.lit(s).alias("start"),
                              F.lit(m).cast("long").alias("mask"), F.lit(f).cast("long").alias("flip"))
                     for c, s, m, f in rows])


def bucket_rows(fps: DataFrame, flips: bool) -> DataFrame:
    """key, fp, flip, turned: the buckets that fingerprints (fp) are in, with
    ``flips`` also those one zero bit away.  The chain is in the key's high bits."""
    rows = fps.select("fp", F.explode(_asked(flips)).alias("at"))
    rows = rows.select("fp", "at.*").withColumn("turned", _turned("fp", "start"))
    rows = rows.where((F.col("flip") == 0) | (F.col("turned").bitwiseAND(F.col("flip")) == 0))
    key = F.expr("shiftleft(cast(chain as long), 32) | (turned & mask) | flip")
    return rows.select(key.alias("key"), "fp", "flip", "turned")


def _within(chain: Column, apart: Column) -> Column:
    """Whether all longer chains, and then all bits, are within their shares."""
    ok = None
    for length in range(CHAIN + 1, len(SEGMENTS) + 1):
        masks = F.array(*[F.lit(_signed((1 << _bits(c, length)) - 1)).cast("long") for c in range(len(SEGMENTS))])
        test = F.bit_count(apart.bitwiseAND(F.get(masks, chain))) <= allowed(length)
        ok = test if ok is None else ok & test
    return ok


def bucket_links(fps: DataFrame, hot: DataFrame | None) -> DataFrame:
    """a, b: linked fingerprints that meet in buckets that are not hot."""
    index = bucket_rows(fps, False).select("key", F.col("fp").alias("own"), F.col("turned").alias("own_turned"))
    if hot is not None:
        index = index.join(hot, "key", "left_anti")
    asked = bucket_rows(fps, True)
    met = asked.join(index, "key").where((F.col("flip") != 0) | (F.col("fp") < F.col("own")))
    chain = F.shiftright("key", 32).cast("int")
    met = met.where(_within(chain, F.col("turned").bitwiseXOR(F.col("own_turned"))))
    return met.select(F.least("fp", "own").alias("a"), F.greatest("fp", "own").alias("b")).distinct()


def _near(bits: int) -> Column:
    """Constant masks of at most ``bits`` bits among those that a key of three
    segments leaves free."""
    free = range(min(_bits(c, CHAIN) for c in range(len(SEGMENTS))), 64)
    masks = [0] + [sum(1 << b for b in chosen) for n in range(1, bits + 1) for chosen in combinations(free, n)]
    return F.array(*[F.lit(_signed(m)).cast("long") for m in masks])


def point_links(fps: DataFrame, hot: DataFrame) -> DataFrame:
    """a, b: links that span what is linked within hot buckets (key)."""
    held = bucket_rows(fps, True).join(hot, "key")
    half = DISTANCE // 2
    members = held.where("flip = 0").withColumn("move", F.explode(_near(half))).unionByName(
        held.where("flip <> 0").withColumn("move", F.explode(_near(half - 1))))
    masks = F.array(*[F.lit((1 << _bits(c, CHAIN)) - 1).cast("long") for c in range(len(SEGMENTS))])
    mask = F.get(masks, F.shiftright("key", 32).cast("int"))
    # A key of 28 bits leaves one free bit less.
    members = members.where(F.col("move").bitwiseAND(mask) == 0)
    point = F.col("turned").bitwiseAND(F.bitwise_not(mask)).bitwiseXOR(F.col("move"))
    stars = members.groupBy("key", point.alias("point")).agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    stars = stars.select(F.array_min("all").alias("a"), F.explode("all").alias("b"))
    return stars.where("a <> b").distinct()


def links(spark: SparkSession, fps: DataFrame, hot_size: int = HOT) -> DataFrame:
    """a, b: links between distinct fingerprints (fp) that span all classes.
    Outside hot buckets every linked pair is there."""
    sizes = bucket_rows(fps, False).groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    hot = written(spark, sizes.where(F.col("members") > hot_size).select("key"), "simhash-hot")
    if hot.isEmpty():
        return bucket_links(fps, None)
    return bucket_links(fps, hot).unionByName(point_links(fps, hot))


def simhash_classes(spark: SparkSession, docs: DataFrame, hot_size: int = HOT) -> DataFrame:
    """doc_id, fp, component_id of every row of ``docs``."""
    marks = written(spark, fingerprints(docs), "simhash-marks")
    with scratch(spark) as keep:
        ids = written(spark, marks.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "simhash-ids")
        found = written(spark, links(spark, ids.select("fp"), hot_size), "simhash-links")
        labels = components(spark, found, "simhash-classes")
        classed = ids.join(labels.withColumnRenamed("vertex", "fp"), "fp", "left").select(
            "fp", "smallest", F.coalesce("label", "fp").alias("class"))
        best = classed.groupBy("class").agg(F.min("smallest").alias("component_id"))
        named = keep(written(spark, classed.join(best, "class").select("fp", "component_id"), "simhash-named"))
    return marks.join(named, "fp").select("doc_id", "fp", "component_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_classes(spark, read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
