"""Operator 11: hard-negative mining through an inverted multi-index.

Vectors are compared by the integer inner product of their quantised
components.  Each half of the components has a codebook; a pair of half codes is
a cell.  A query's inner product with a row is at most, per half, that with the row's
codeword plus the query's length times the cell half's radius.  A heap over the
two sorted lists of half bounds visits cells in falling order of the summed
bound, so every row not yet seen scores at most the next bound.

What is asked for are windows: the first k rows with a score between two limits,
of the anchor's label or of other labels.  A window is certified, and asks for
no further cell, when the next bound is below its lower limit or below its k-th
row.  Positives are one window without limits; the negatives of a positive are
one window below its score.  So results are exact, whatever the codebooks.

Rows are dealt by hash into shards of about ``SHARD_ROWS`` rows, each an index
of its own with its own radii.  Anchors, in slices of about ``SLICE``, visit shards in
rounds of doubling numbers; the rows found so far are a floor for the next round, so an
anchor gets few rows per round.  A task holds one shard and streams a slice past
it.  The codebooks are fitted on ``SAMPLE`` rows chosen by hash; all rows are
indexed.

Defined cases: rows with a null id, label or vector, a null or non-finite
component, or a component of 65,536 or more in magnitude take no part; missing
components of shorter vectors are zero; rows repeated under one id count once
(smallest label, then vector); ties go to the smaller id; equal positives of an anchor each get
their negatives; a positive with a negative score has no window; empty tables
give empty results; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterwise.llm.common import read_table, scratch, written

ANCHOR_EVERY = 100
RELABEL_EVERY, LABELS = 7, 10
SCALE = 256
POSITIVES = NEGATIVES = 5
# A negative scores at least so many hundredths of its positive.
LEAST = 80
CODES = 16
SAMPLE = 4_096
SHARD_ROWS = 16_384
SLICE = 256
LARGEST = 1 << 24
FAR = 1 << 62

RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, "
          "positive_score long, negative_score long")
INDEX = "shard int, ids binary, labels binary, vectors binary, starts binary, radii binary"
FOUND = "anchor_id long, w int, score long, vec_id long"


def quantised(table: DataFrame) -> DataFrame:
    """vec_id, label, q (array of long) of the rows that take part."""
    rows = table.select(F.col("`vec_id`").cast("long").alias("vec_id"), F.col("`label`").cast("long").alias("label"),
                        F.col("`embedding`").cast("array<double>").alias("embedding"))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST / SCALE))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    q = F.transform("embedding", lambda x: F.floor(x * SCALE))
    one = rows.groupBy("vec_id").agg(F.min(F.struct(label.alias("label"), q.alias("q"))).alias("r"))
    return one.select("vec_id", "r.label", "r.q")


def padded(vectors: list, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def codebook(points: np.ndarray, codes: int = CODES, rounds: int = 12) -> np.ndarray:
    """Centres of k-means, started from evenly spaced rows."""
    centres = points[np.linspace(0, len(points) - 1, min(codes, len(points))).astype(int)].astype(float)
    for _ in range(rounds):
        own = nearest(points, centres)
        for c in np.unique(own).tolist():
            centres[c] = points[own == c].mean(0)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(1) - 2 * (points @ centres.T), 1)


def fit(rows: DataFrame, dims: int, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """The two codebooks, from the ``sample`` rows of smallest hash."""
    first = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("q").collect()
    points = padded([r["q"] for r in first], dims).astype(float)
    return codebook(points[:, :dims // 2]), codebook(points[:, dims // 2:])


def build(rows: DataFrame, books: tuple[np.ndarray, np.ndarray], dims: int, shards: int) -> DataFrame:
    """One row per shard: ids, labels and vectors in cell order, where each cell
    starts, and the radius of each half code."""
    table = rows.sparkSession.sparkContext.broadcast(books)

    def index(key, got: pd.DataFrame) -> pd.DataFrame:
        vectors = padded(got["q"].tolist(), dims)
        codes, radii = [], []
        for half, centres in zip((vectors[:, :dims // 2], vectors[:, dims // 2:]), table.value):
            own = nearest(half, centres)
            # A code without rows has a radius below any.
            far = np.full(len(centres), -np.inf)
            np.maximum.at(far, own, np.sqrt(((half - centres[own]) ** 2).sum(1)))
            codes.append(own)
            radii.append(far)
        width = len(table.value[1])
        cell = codes[0] * width + codes[1]
        order = np.lexsort((got["vec_id"].to_numpy(), cell))
        starts = np.searchsorted(cell[order], np.arange(len(table.value[0]) * width + 1))
        return pd.DataFrame({
            "shard": [key[0]], "ids": [got["vec_id"].to_numpy("<i8")[order].tobytes()],
            "labels": [got["label"].to_numpy("<i8")[order].tobytes()],
            "vectors": [vectors[order].astype("<i4").tobytes()], "starts": [starts.astype("<i4").tobytes()],
            "radii": [np.concatenate(radii).tobytes()]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(index, INDEX)


class Best:
    """The first rows of one window, by falling score, then id."""

    def __init__(self, k: int, low: int, high: int, floor: tuple[int, int] | None):
        self.k, self.low, self.high, self.floor = k, low, high, floor
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def open(self, bound: float) -> bool:
        """Whether a row scoring at most ``bound`` may still enter."""
        if bound < self.low or self.floor and bound < self.floor[0]:
            return False
        return len(self.ids) < self.k or bound >= self.scores[-1]

    def least(self) -> int:
        least = max(self.low, self.floor[0]) if self.floor else self.low
        return least if len(self.ids) < self.k else max(least, int(self.scores[-1]))

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        ok = (scores >= self.least()) & (scores <= self.high)
        if self.floor:
            ok &= (scores > self.floor[0]) | (ids < self.floor[1])
        if ok.any():
            scores, ids = np.r_[self.scores, scores[ok]], np.r_[self.ids, ids[ok]]
            order = np.lexsort((ids, -scores))[:self.k]
            self.scores, self.ids = scores[order], ids[order]


class Shard:
    """One shard's inverted multi-index."""

    def __init__(self, row, books: tuple[np.ndarray, np.ndarray], dims: int):
        self.books, self.dims = books, dims
        self.ids, self.labels = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.labels, "<i8")
        self.vectors = np.frombuffer(row.vectors, "<i4").reshape(-1, dims).astype(np.int64)
        self.starts = np.frombuffer(row.starts, "<i4")
        radii = np.frombuffer(row.radii, float)
        self.radii = radii[:len(books[0])], radii[len(books[0]):]
        self.largest = int(np.abs(self.vectors).max(initial=0))
        self.floats = self.vectors.astype(float)

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.dims * self.largest * int(np.abs(q).max(initial=0)) < 1 << 52:
            # All partial sums are whole numbers that doubles hold exactly.
            return (self.floats[at] @ q.astype(float)).astype(np.int64)
        return self.vectors[at] @ q

    def cells(self, q: np.ndarray) -> Iterator[tuple[float, int]]:
        """(bound, cell) in falling order of the bound."""
        half, sides = self.dims // 2, []
        for part, centres, radii in zip((q[:half], q[half:]), self.books, self.radii):
            bounds = centres @ part + np.sqrt(float((part * part).sum())) * np.maximum(radii, 0)
            # Above any rounding of what went into it.
            bounds += 1e-6 * (1 + np.abs(bounds))
            order = np.argsort(-bounds, kind="stable")
            order = order[radii[order] >= 0]
            sides.append((bounds[order].tolist(), order.tolist()))
        (one, code_one), (two, code_two) = sides
        width = len(self.books[1])
        heap = [(-(one[0] + two[0]), 0, 0)] if one and two else []
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j == 0 and i + 1 < len(one):
                heapq.heappush(heap, (-(one[i + 1] + two[0]), i + 1, 0))
            if j + 1 < len(two):
                heapq.heappush(heap, (-(one[i] + two[j + 1]), i, j + 1))
            yield -bound, code_one[i] * width + code_two[j]

    def search(self, anchor_id: int, label: int, q: np.ndarray, windows: list[Best], same: bool) -> None:
        """Fill the windows.  Cells are scored in lots that double, so a far search
        takes few steps; the certificate is asked for every cell."""
        lot, at = 1, []
        still = windows

        def score() -> None:
            rows = np.concatenate(at)
            rows = rows[((self.labels[rows] == label) == same) & (self.ids[rows] != anchor_id)]
            found = self.scores(rows, q)
            near = found >= min(w.least() for w in still)
            found, ids = found[near], self.ids[rows[near]]
            for w in still:
                w.add(found, ids)

        for bound, cell in self.cells(q):
            if len(at) >= lot or at and not all(w.open(bound) for w in still):
                # A window closes only when all cells above the bound are scored.
                score()
                lot, at = 2 * lot, []
            still = [w for w in still if w.open(bound)]
            if not still:
                return
            a, b = self.starts[cell], self.starts[cell + 1]
            if a < b:
                at.append(np.arange(a, b))
        if at:
            score()


def visit(index: DataFrame, asked: DataFrame, books: tuple[np.ndarray, np.ndarray], dims: int, k: int, same: bool,
          slices: int, units: int) -> DataFrame:
    """anchor_id, w, score, vec_id: the rows of the given shards (index) that
    enter the windows of the anchors asked of them (shard, slice, anchor_id,
    label, q, windows)."""
    table = index.sparkSession.sparkContext.broadcast(books)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.ids is not None:
                    shard = Shard(row, table.value, dims)
                    continue
                q = padded([row.q], dims)[0]
                windows = [Best(k, w["low"], w["high"], None if w["floor"] is None else (w["floor"], w["floor_id"]))
                           for w in row.windows]
                shard.search(row.anchor_id, row.label, q, windows, same)
                out += [(row.anchor_id, w["w"], s, i) for w, best in zip(row.windows, windows)
                        for s, i in zip(best.scores.tolist(), best.ids.tolist())]
            yield pd.DataFrame(out, columns=["anchor_id", "w", "score", "vec_id"]).astype(
                {"anchor_id": "int64", "w": "int32", "score": "int64", "vec_id": "int64"})

    held = index.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    both = held.unionByName(asked, allowMissingColumns=True)
    # The index of a shard comes before its anchors.
    both = both.repartition(units, "shard", "slice").sortWithinPartitions("shard", "slice", F.col("ids").isNull())
    return both.mapInPandas(search, FOUND)


def first_rows(spark: SparkSession, index: DataFrame, shards: int, anchors: DataFrame, windows: DataFrame,
               books: tuple[np.ndarray, np.ndarray], dims: int, k: int, same: bool, slices: int) -> DataFrame:
    """anchor_id, w, score, vec_id, place: the first k rows of every window
    (anchor_id, w, low, high), by falling score, then id."""
    best = None
    place = F.row_number().over(Window.partitionBy("anchor_id", "w").orderBy(F.desc("score"), "vec_id"))
    low = 0
    while low < shards:
        high = min(shards, max(1, 2 * low))
        asked = windows
        if best is None:
            asked = asked.withColumns({"floor": F.lit(None).cast("long"), "floor_id": F.lit(None).cast("long")})
        else:
            last = best.where(F.col("place") == k).select(
                "anchor_id", "w", F.col("score").alias("floor"), F.col("vec_id").alias("floor_id"))
            asked = asked.join(last, ["anchor_id", "w"], "left")
        asked = asked.groupBy("anchor_id").agg(
            F.sort_array(F.collect_list(F.struct("w", "low", "high", "floor", "floor_id"))).alias("windows"))
        # A stated query set against all rows, in slices and shards.
        asked = anchors.join(asked, "anchor_id").withColumn(
            "shard", F.explode(F.sequence(F.lit(low), F.lit(high - 1))))
        units = min(10_000, (high - low) * slices)
        found = visit(index.where(F.col("shard").between(low, high - 1)), asked, books, dims, k, same, slices, units)
        if best is not None:
            found = found.unionByName(best.drop("place"))
        best = written(spark, found.withColumn("place", place).where(F.col("place") <= k), "negatives-best")
        low = high
    return best


def hard_negatives(spark: SparkSession, table: DataFrame, every: int = ANCHOR_EVERY, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, least: int = LEAST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The first ``negatives`` rows of other labels that score between ``least``
    hundredths of a positive's score and that score, for the first ``positives``
    rows of the label of every anchor (a row whose id is divisible by ``every``)."""
    with scratch(spark) as keep:
        rows = written(spark, quantised(table), "negatives-rows")
        n, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
        if not n:
            return spark.createDataFrame([], RESULT)
        dims = max(2, dims)
        books = fit(rows, dims)
        shards = -(-n // shard_rows)
        index = written(spark, build(rows, books, dims, shards), "negatives-index")
        anchors = rows.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "anchor_id")
        slices = max(1, -(-anchors.count() // SLICE))
        anchors = anchors.withColumn("slice", F.pmod(F.xxhash64("anchor_id", F.lit(12)), F.lit(slices)).cast("int"))
        anchors = written(spark, anchors, "negatives-anchors")

        def first(windows: DataFrame, k: int, same: bool) -> DataFrame:
            return first_rows(spark, index, shards, anchors, windows, books, dims, k, same, slices)

        every_row = anchors.select("anchor_id", F.lit(0).alias("w"), F.lit(-FAR).alias("low"), F.lit(FAR).alias("high"))
        own = first(every_row, positives, True).where("score >= 0").select(
            "anchor_id", F.col("place").alias("w"), F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"))
        low = F.expr(f"(positive_score * {least} + 99) div 100")
        other = first(own.select("anchor_id", "w", low.alias("low"), F.col("positive_score").alias("high")),
                      negatives, False)
        out = own.join(other, ["anchor_id", "w"]).select(
            "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"))
        return keep(written(spark, out, "negatives"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(spark, read_table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""
