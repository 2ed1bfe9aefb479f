"""Operator 5: n-gram Jaccard join through count-vector R-trees.

A text's set holds its distinct five-word shingles.  Shingles hash into
groups; the counts per group are the text's point.  The overlap of two sets is
at most the sum of the smaller coordinates, so an R-tree over points, which
bounds that sum for whole boxes, finds every pair that can reach the wanted
similarity; surviving pairs are verified on the sets.

Points of unrelated texts lie too close together in many dimensions for one
tree over everything, so texts first meet by shared prefix shingles: two sets
of similarity 3/4 share one among the first quarter of either in any common
order (all rarer shingles come first, so a passage that many texts share does
not bring them together).  Trees over the texts of one shingle link those that
may match (texts of a frequent shingle are all linked, as a star); texts linked
that way form a candidate class, and within a class trees with verification
find the true links.  A class too large for one task is cut into blocks; once
links within blocks and between one member of each are known, only pairs of
blocks that hold different known classes are tasks.  Members of a known class
are passed over, so a large group of near copies yields a spanning set of
links, never all its pairs.

Sets are identified and compared by 64-bit hashes of their shingles.  They are made
from the texts where they are needed (once to count shingles, once for prefixes and
points, once more for the texts of candidate classes) and never all kept: eight bytes
a shingle are more than the texts.

Defined cases: null texts and texts without words have an empty set, linked
with nothing; texts of fewer than five words have one shingle; texts with
equal sets share a class; repeated rows too; an empty table gives an empty
result; extra columns are ignored (``one_of_each`` carries them along).  A
null doc_id counts as the largest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm.common import as_written, discard, read_table, scratch, small_batches, written
from meterwise.llm.components import components

WORDS = 5
# Similarity 3/4, as whole numbers.
NUM, DEN = 75, 100
# Groups of a point: a power of two that keeps about four shingles a group,
# so that unrelated long texts lie apart as well as short ones.
GROUPS = 128
PER_GROUP = 4
LEAF = 32
# Vertices of a class that one task takes; a larger class is cut in blocks.
BLOCK = 4_000
# A shingle that the sketch gives so many sets or more is frequent.
RUN = 4_000
# Slots of a sketch (one byte each) for each thing it tells of, at least and at
# most, and of one piece of it.
PER_ENTRY = 16
LEAST_SLOTS, MOST_SLOTS = 1 << 20, 1 << 28
SKETCH_PIECE = 1 << 16
MIN_FREQUENT = 8
# Shingles that a task counts at once.
COUNTED = 8_000_000

SET = ("doc_id long, text_hash long, n_shingles long, vertex long, prefix binary, frequent int, "
       "counts binary")
FULL = "place long, shingles binary"


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, "<u8")
    if len(words) < WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], "<u8")
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), "<u8", len(words))
    n = len(h) - WORDS + 1
    s = h[:n].copy()
    for j in range(1, WORDS):
        s *= np.uint64(0x9E3779B97F4A7C15)
        s ^= s >> np.uint64(29)
        s += h[j:n + j]
    s *= np.uint64(0xBF58476D1CE4E5B9)
    s ^= s >> np.uint64(32)
    return np.unique(s)


def n_groups(n: int) -> int:
    return max(GROUPS, 1 << max(0, (n - 1) // PER_GROUP).bit_length())


def group_counts(s: np.ndarray) -> np.ndarray:
    """Shingles per group; folding halves of a point gives the point with half
    as many groups."""
    g = n_groups(len(s))
    return np.bincount((s >> np.uint64(32)).astype(np.int64) % g, minlength=g).astype("<u2")


def least_overlap(a, b):
    """Smallest common count with which sets of a and b shingles link."""
    return -(-NUM * (a + b) // (DEN + NUM))


def vertex_of(s: np.ndarray) -> int | None:
    """Identity of a set."""
    return xxhash.xxh64_intdigest(s.tobytes(), 7) >> 1 if len(s) else None


def texts_of(docs: DataFrame) -> DataFrame:
    return as_written(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))


def sketch_slots(entries: int) -> int:
    """Slots for so many entries: a power of two, bounded."""
    return min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (PER_ENTRY * entries - 1).bit_length()))


def collected_sketch(marked: DataFrame, slots: int) -> np.ndarray:
    """The bytes (slot, level: one row a slot) of a sketch, put together piece by
    piece, so that the driver gets ``slots`` bytes whatever the input."""
    def piece(key, got: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(min(slots, SKETCH_PIECE), np.uint8)
        out[got["slot"].to_numpy()] = got["level"].to_numpy()
        return pd.DataFrame({"piece": [key[0]], "levels": [zlib.compress(out.tobytes(), 1)]})

    pieces = marked.select(F.floor(F.col("slot") / SKETCH_PIECE).cast("int").alias("piece"),
                           (F.col("slot") % SKETCH_PIECE).alias("slot"), "level")
    sketch = np.zeros(slots, np.uint8)
    with small_batches(marked.sparkSession):
        for r in pieces.groupBy("piece").applyInPandas(piece, "piece int, levels binary").collect():
            sketch[r["piece"] * SKETCH_PIECE:(r["piece"] + 1) * SKETCH_PIECE] = np.frombuffer(
                zlib.decompress(r["levels"]), np.uint8)
    return sketch


def frequency_levels(docs: DataFrame) -> np.ndarray:
    """One byte per hash slot, growing with the number of sets that hold the
    slot's most frequent shingle.  A task reports, of every ``COUNTED`` shingles, those
    it meets twice or more, each set counted once.  The sketch only orders
    shingles: no result depends on it."""
    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = set(), [], 0

        def counts() -> pa.RecordBatch:
            found, times = np.unique(np.concatenate(held), return_counts=True)
            keep = times > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(found[keep].view("<i8")), pa.array(times[keep])], ["shingle", "n"])

        for batch in batches:
            for text in batch.column("text"):
                s = shingles(text.as_py())
                v = vertex_of(s)
                if v is not None and v not in seen:
                    seen.add(v)
                    held.append(s)
                    size += len(s)
                    if size > COUNTED:
                        yield counts()
                        held, size = [], 0
        if held:
            yield counts()

    counted = as_written(docs, "text").mapInArrow(repeated, "shingle long, n long")
    counted = written(docs.sparkSession, counted.groupBy("shingle").agg(F.sum("n").alias("n")).where(
        F.col("n") >= MIN_FREQUENT), "join-frequent")
    slots = sketch_slots(counted.count())
    level = F.least(F.floor(F.log2("n") * 4), F.lit(255)).cast("int")
    sketch = collected_sketch(counted.groupBy(F.col("shingle").bitwiseAND(slots - 1).alias("slot")).agg(
        F.max(level).alias("level")), slots)
    discard(docs.sparkSession, counted)
    return sketch


def least_level(run: int) -> int:
    """The level from which a shingle is frequent."""
    return int(np.log2(run) * 4)


def shingle_sets(spark: SparkSession, docs: DataFrame, levels: np.ndarray, run: int = RUN) -> DataFrame:
    """Vertex (identity of the set), prefix and group counts of every row.  The
    prefix has the rarest shingles first; the last ``frequent`` ones of it are
    frequent.  The sketch misses at most one set a count, so a run of shingles that
    are not frequent has fewer than ``run`` texts and one a count, up to the
    rounding of a level."""
    table = spark.sparkContext.broadcast(levels)
    least = least_level(run)

    def prefix(s: np.ndarray) -> tuple[bytes, int]:
        own = table.value[(s & np.uint64(len(table.value) - 1)).astype(np.int64)]
        order = np.argsort(own, kind="stable")[:len(s) - -(-NUM * len(s) // DEN) + 1]
        return s[order].tobytes(), int((own[order] >= least).sum())

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingles(t) for t in part.column("text").to_pylist()]
                prefixes = [prefix(s) if len(s) else (None, 0) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array([vertex_of(s) for s in sets], pa.int64()),
                    pa.array([p for p, _ in prefixes], pa.binary()), pa.array([n for _, n in prefixes], pa.int32()),
                    pa.array([group_counts(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ], ["doc_id", "text_hash", "n_shingles", "vertex", "prefix", "frequent", "counts"])

    return texts_of(docs).mapInArrow(make, SET)


def full_sets(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """vertex, n_shingles, shingles, counts of the wanted vertices, each once.

    One row stands for all with its set.  The rows to make sets of are found
    without moving texts: a sketch of their places lets few others pass, and a
    join on the places drops these."""
    place = F.xxhash64("doc_id", "text_hash")
    chosen = (sets.where("n_shingles > 0").join(wanted.select("vertex").distinct().hint("merge"), "vertex", "left_semi")
              .groupBy("vertex").agg(F.min(F.struct("text_hash", "doc_id")).alias("row"),
                                     F.first("n_shingles").alias("n_shingles"), F.first("counts").alias("counts")))
    chosen = written(docs.sparkSession, chosen.select(
        "vertex", "n_shingles", "counts", F.xxhash64("row.doc_id", "row.text_hash").alias("place")), "join-chosen-rows")
    slots = sketch_slots(chosen.count())
    marks = collected_sketch(chosen.select(F.col("place").bitwiseAND(slots - 1).alias("slot")).distinct().withColumn(
        "level", F.lit(1)), slots)
    table = docs.sparkSession.sparkContext.broadcast(np.packbits(marks, bitorder="little"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("place").to_numpy(zero_copy_only=False).astype(np.int64)
            slot = places & (slots - 1)
            hit = table.value[slot >> 3] >> (slot & 7).astype(np.uint8) & 1
            part = batch.filter(pa.array(hit.astype(bool)))
            for at in range(0, part.num_rows, 500):
                some = part.slice(at, 500)
                yield pa.RecordBatch.from_arrays(
                    [some.column("place"),
                     pa.array([shingles(t).tobytes() for t in some.column("text").to_pylist()], pa.binary())],
                    ["place", "shingles"])

    made = texts_of(docs).select(place.alias("place"), "text").mapInArrow(make, FULL)
    # Copies of a row have one place.
    made = made.join(chosen.hint("merge"), "place").groupBy("vertex").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("shingles").alias("shingles"),
        F.first("counts").alias("counts"))
    return made


def prefix_rows(sets: DataFrame) -> DataFrame:
    """token, vertex, n, frequent for the prefix shingles of every set."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            tokens, owners, sizes, often = [], [], [], []
            for v, n, raw, frequent in zip(batch["vertex"], batch["n_shingles"], batch["prefix"], batch["frequent"]):
                if v in seen:
                    continue
                seen.add(v)
                p = np.frombuffer(raw, "<i8")
                often.append(np.arange(len(p)) >= len(p) - frequent)
                tokens.append(p)
                owners.append(np.full(len(p), v, np.int64))
                sizes.append(np.full(len(p), n, np.int32))
            if tokens:
                yield pd.DataFrame({"token": np.concatenate(tokens), "vertex": np.concatenate(owners),
                                    "n": np.concatenate(sizes), "frequent": np.concatenate(often)})

    return sets.where("n_shingles > 0").select("vertex", "n_shingles", "prefix", "frequent").mapInPandas(
        cut, "token long, vertex long, n int, frequent boolean")


def star_links(rows: DataFrame) -> DataFrame:
    """a, b: every text of a frequent shingle linked with the shingle's
    smallest vertex, without bringing the texts together.  Candidate classes may
    be too large but never too small."""
    held = rows.where("frequent").select("token", "vertex")
    hubs = held.groupBy("token").agg(F.min("vertex").alias("a"))
    return held.join(hubs, "token").where("a <> vertex").select("a", F.col("vertex").alias("b")).distinct()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shared_runs(rows: DataFrame) -> DataFrame:
    """run, vertex: the texts that meet at a prefix shingle, one run for all
    shingles with the same texts.  Runs are cut where the sizes jump by more
    than a quarter (nothing links across) and single texts are dropped."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [(b["token"].to_numpy(), b["vertex"].to_numpy(), b["n"].to_numpy()) for b in batches if len(b)]
        if not held:
            return
        token, vertex, n = (np.concatenate(c) for c in zip(*held))
        del held
        order = np.argsort(token, kind="stable")
        t = token[order]
        same = t[1:] == t[:-1]
        order = order[np.r_[False, same] | np.r_[same, False]]
        order = order[np.lexsort((vertex[order], n[order], token[order]))]
        t, v, k = token[order], vertex[order], n[order].astype(np.int64)
        if not len(t):
            return
        new = np.r_[True, (t[1:] != t[:-1]) | (v[1:] != v[:-1])]
        t, v, k = t[new], v[new], k[new]
        first = np.r_[True, (t[1:] != t[:-1]) | (NUM * k[1:] > DEN * k[:-1])]
        starts = np.flatnonzero(first)
        length = np.diff(np.r_[starts, len(t)])
        u = v.view(np.uint64)
        one = np.add.reduceat(_mix(u), starts)
        two = np.add.reduceat(_mix(u ^ np.uint64(0x5851F42D4C957F2D)), starts)
        keep = np.flatnonzero(length > 1)
        if not len(keep):
            return
        _, unique = np.unique(np.stack([one[keep], two[keep]], 1), axis=0, return_index=True)
        keep = keep[unique]
        at = np.repeat(starts[keep] - np.r_[0, np.cumsum(length[keep])[:-1]], length[keep]) + np.arange(length[keep].sum())
        run = np.repeat(_mix(one[keep] ^ _mix(two[keep])), length[keep])
        yield pd.DataFrame({"run": run.view("<i8"), "vertex": v[at]})

    parted = rows.where("not frequent").select("token", "vertex", "n").repartition("token")
    return parted.mapInPandas(find, "run long, vertex long").dropDuplicates(["run", "vertex"])


class CountTree:
    """R-tree over count vectors: points sorted by set size and packed into
    leaves by their own coordinates within slabs, then boxes of boxes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        m = len(sizes)
        order = np.argsort(sizes, kind="stable")
        slab = max(LEAF, int(np.ceil(np.sqrt(m / LEAF))) * LEAF)
        if m > LEAF:
            axis = int(np.argmax(points.astype(float).var(0)))
            order = np.concatenate([o[np.argsort(points[o, axis], kind="stable")]
                                    for o in (order[i:i + slab] for i in range(0, m, slab))])
        self.order, self.points, self.sizes = order, points[order], sizes[order]
        self.levels = []
        top, least = self.points, self.sizes
        while len(top) > LEAF:
            cuts = np.arange(0, len(top), LEAF)
            top, least = np.maximum.reduceat(top, cuts), np.minimum.reduceat(least, cuts)
            self.levels.append((top, least))

    def reach(self, point: np.ndarray, size: int) -> np.ndarray:
        """Positions (in tree order) whose overlap bound allows a link."""
        at = None
        for top, least in [*self.levels[::-1], (self.points, self.sizes)]:
            if at is None:
                at = np.arange(len(top))
            else:
                at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                at = at[at < len(top)]
            bound = np.minimum(top[at], point).sum(1, dtype=np.uint32).astype(np.int64)
            at = at[bound >= least_overlap(size, least[at])]
            if not len(at):
                break
        return at


def tree_links(points: list[np.ndarray], sizes: np.ndarray, sets: list | None = None,
               side: np.ndarray | None = None, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that span the classes formed by all linking pairs: with ``sets``
    pairs are verified, without them every pair within the bound links.  With
    ``side``, only pairs of different sides count; members of one ``known``
    class are linked already.

    One tree for each number of groups.  Sizes of linking sets differ by a
    third at most and the number of groups doubles with the size, so a point
    meets its own tree and the next, whose points are folded to its groups.
    """
    root = np.arange(len(sizes)) if known is None else np.unique(known, return_inverse=True)[1]
    links: list[tuple[int, int]] = []

    def join(own: int, others: np.ndarray) -> None:
        while True:
            # Members of one class are passed over together.
            apart = root[others] != root[own]
            if side is not None:
                apart &= side[others] != side[own]
            others = others[apart]
            for at, other in enumerate(others.tolist()):
                if sets is not None:
                    x, y = sets[own], sets[other]
                    if len(x) > len(y):
                        x, y = y, x
                    p = np.searchsorted(y, x)
                    p[p == len(y)] = 0
                    if int((y[p] == x).sum()) < least_overlap(len(x), len(y)):
                        continue
                root[root == root[other]] = root[own]
                links.append((int(own), int(other)))
                others = others[at + 1:]
                break
            else:
                return

    dims = np.array([len(p) for p in points])
    for g in np.unique(dims).tolist():
        own = np.flatnonzero(dims == g)
        tree = CountTree(np.stack([points[i] for i in own]), sizes[own])
        for i in range(len(own)):
            near = tree.reach(tree.points[i], int(tree.sizes[i]))
            join(own[tree.order[i]], own[tree.order[near[near > i]]])
        above = np.flatnonzero(dims == 2 * g)
        if len(above):
            folded = np.stack([points[i].reshape(2, g).sum(0, dtype=np.uint16) for i in above])
            tree = CountTree(folded, sizes[above])
            for i in own.tolist():
                near = tree.reach(points[i], int(sizes[i]))
                join(i, above[tree.order[near]])
    return links


def grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Consecutive rows of one key, from batches sorted by the keys."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        k = batch[keys].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
        ends = [0, *cuts.tolist(), len(batch)]
        for a, b in zip(ends, ends[1:]):
            part = batch.iloc[a:b]
            if held and (held[-1][keys].to_numpy()[-1] != k[a]).any():
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def _points(raw: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2") for x in raw]


def candidate_links(runs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: links spanning the candidate classes of each run."""
    points = sets.where("n_shingles > 0").select("vertex", "n_shingles", "counts").dropDuplicates(["vertex"])

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple[int, int]] = []
        for g in grouped(batches, ["run"]):
            v = g["vertex"].to_numpy()
            out += [(int(v[i]), int(v[j])) for i, j in tree_links(_points(g["counts"]), g["n_shingles"].to_numpy())]
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=["a", "b"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["a", "b"])

    # Merge joins: the same shuffle at every size, and none of these sides is bounded.
    held = runs.join(points.hint("merge"), "vertex")
    return held.repartition("run").sortWithinPartitions("run").mapInPandas(link, "a long, b long")


def _verify(cut: DataFrame, needed: DataFrame) -> DataFrame:
    """a, b: true links that ``cut`` (vertex, label, known, own, low, high) asks
    for: within a block (low = high) or between two, not within a known class."""
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple[int, int]] = []
        for g in grouped(batches, ["label", "low", "high"]):
            v = g["vertex"].to_numpy()
            held = [np.frombuffer(x, "<u8") for x in g["shingles"]]
            apart = g["low"].iloc[0] != g["high"].iloc[0]
            found = tree_links(_points(g["counts"]), g["n_shingles"].to_numpy(), held,
                               g["own"].to_numpy() if apart else None, g["known"].to_numpy())
            out += [(int(v[i]), int(v[j])) for i, j in found]
        if out:
            yield pd.DataFrame(out, columns=["a", "b"])

    keys = ["label", "low", "high"]
    rows = cut.select("vertex", "label", "known", "own", "low", "high").join(needed.hint("merge"), "vertex")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(verify, "a long, b long")


def _within(classes: DataFrame, block: int) -> DataFrame:
    """The cut of classes (vertex, label) into blocks, each on its own."""
    sizes = classes.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    own = F.pmod(F.xxhash64("vertex"), F.col("blocks"))
    return classes.join(sizes, "label").select(
        "vertex", "label", F.col("vertex").alias("known"), own.alias("own"), own.alias("low"), own.alias("high"))


def _across(known: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """The cut that is left of large classes (vertex, label, known): blocks hold
    one known class, or several small ones, and pairs of blocks are left out
    that hold one known class together or whose sizes are too far apart."""
    per = known.groupBy("label", "known").agg(F.count(F.lit(1)).alias("members"))
    large = F.col("members") >= block
    small = per.groupBy("label").agg(F.sum(F.when(~large, F.col("members")).otherwise(0)).alias("rest"))
    own = F.when(large, F.xxhash64("known", F.pmod(F.xxhash64("vertex"), F.ceil(F.col("members") / block)))).otherwise(
        F.pmod(F.xxhash64("known"), F.greatest(F.lit(1), F.ceil(F.col("rest") / block))))
    placed = (known.join(per, ["label", "known"]).join(small, "label").join(sizes, "vertex")
              .select("vertex", "label", "known", "n", own.alias("own")))
    seen = placed.groupBy("label", "own").agg(
        F.min("known").alias("first"), F.max("known").alias("last"), F.min("n").alias("least"), F.max("n").alias("most"))
    other = seen.select("label", *[F.col(c).alias(f"{c}_2") for c in ("own", "first", "last", "least", "most")])
    pairs = seen.join(other, "label").where(
        (F.col("own") <= F.col("own_2"))
        & (F.least("first", "first_2") < F.greatest("last", "last_2"))
        & (NUM * F.greatest("least", "least_2") <= DEN * F.least("most", "most_2")))
    pairs = pairs.select("label", F.col("own").alias("low"), F.col("own_2").alias("high"))
    ends = pairs.select("*", F.col("low").alias("own")).unionByName(pairs.select("*", F.col("high").alias("own"))).distinct()
    return placed.join(ends, ["label", "own"])


def verified_links(docs: DataFrame, classes: DataFrame, sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """a, b: true links spanning the true classes within each candidate class
    (vertex, label).

    A class of more than ``block`` vertices is cut in blocks.  Links within
    blocks give known classes; one vertex of each meets those of other blocks,
    as long as that halves their number; then pairs of blocks are searched for
    links between known classes only."""
    spark = sets.sparkSession

    def needed(of: DataFrame) -> DataFrame:
        return full_sets(docs, sets, of)

    links = _verify(_within(classes, block), needed(classes))
    over = classes.groupBy("label").count().where(F.col("count") > block).select("label")
    if not over.limit(1).count():
        return links
    links = written(spark, links, "join-within")
    big = written(spark, classes.join(over, "label", "left_semi").select("vertex", "label"), "join-large")
    before = big.count()
    while True:
        merged = components(spark, links.join(big.select(F.col("vertex").alias("a")), "a", "left_semi"), "join-known")
        known = written(spark, big.join(merged.withColumnRenamed("label", "known"), "vertex", "left").select(
            "vertex", "label", F.coalesce("known", "vertex").alias("known")), "join-known-classes")
        chosen = known.groupBy("label", "known").agg(F.min("vertex").alias("vertex")).select("vertex", "label")
        n = chosen.count()
        if 2 * n > before:
            break
        before = n
        links = links.unionByName(written(spark, _verify(_within(chosen, block), needed(chosen)), "join-chosen"))
    sizes = sets.where("n_shingles > 0").groupBy("vertex").agg(F.first("n_shingles").alias("n"))
    # Only sets of blocks that are left move.
    cut = written(spark, _across(known, sizes, block), "join-across")
    return links.unionByName(_verify(cut, needed(cut)))


def jaccard_classes(spark: SparkSession, docs: DataFrame, run: int = RUN, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    with scratch(spark) as keep:
        levels = frequency_levels(docs)
        sets = written(spark, shingle_sets(spark, docs, levels, run), "join-sets")
        prefixes = prefix_rows(sets)
        runs = written(spark, shared_runs(prefixes), "join-runs")
        maybe = candidate_links(runs, sets)
        if levels.max() >= least_level(run):
            # Prefixes are made again, which takes less disk than keeping them.
            maybe = maybe.unionByName(star_links(prefixes))
        maybe = written(spark, maybe, "join-maybe")
        discard(spark, runs)
        classes = components(spark, maybe, "join-candidates")
        links = written(spark, verified_links(docs, classes, sets, block), "join-links")
        labels = components(spark, links, "join-classes")
        rows = sets.select("doc_id", "text_hash", "n_shingles", "vertex").join(labels, "vertex", "left")
        rows = keep(written(spark, rows.withColumn("class", F.coalesce("label", "vertex")), "join-rows"))
    smallest = rows.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("smallest"))
    return rows.join(smallest, "class", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"),
        "class", "text_hash")


def one_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group does:
    the one with the smallest doc_id.  Rows with an empty set stay, repeated
    ones once."""
    found = jaccard_classes(spark, docs)
    first = found.where("class is not null").groupBy("class").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("s"))
    stays = first.select("s.doc_id", "s.text_hash").unionByName(
        found.where("class is null").select("doc_id", "text_hash"))
    stays = stays.select(F.coalesce("doc_id", F.lit(0)).alias("join_id"), F.col("doc_id").isNull().alias("join_null"),
                         F.col("text_hash").alias("join_hash"))
    keys = ["join_id", "join_null", "join_hash"]
    rows = (docs.withColumn("join_id", F.coalesce("doc_id", F.lit(0)))
            .withColumn("join_null", F.col("doc_id").isNull()).withColumn("join_hash", F.xxhash64("text")))
    return rows.join(stays, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(spark, read_table(spark, sf_dir, "documents")).drop("class", "text_hash")
