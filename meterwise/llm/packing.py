"""Operator 9: best-fit packing with certified bounds and repacking.

Documents become token pieces of at most ``capacity`` ids.  Pieces are dealt
over tasks by hash; each task packs its pieces by best-fit decreasing and
certifies its number of sequences with dual-feasible-function lower bounds.
Groups (tasks at first) whose count exceeds their bound release their emptiest sequences, and
every group those with room to spare, up to ``RELEASED`` pieces a group and round; the
released pieces of neighbouring groups meet and are packed again.  What a group with a
gap has not released stays for later rounds.  Rounds go on until one group is left,
and then as long as they save sequences.

Defined cases: a null text is empty and has the end id only; repeated rows
are documents of their own; a null doc_id is kept as null; an empty table
gives an empty result; extra columns are ignored.  Text of any length is cut
only where it exceeds ``capacity``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterwise.llm.common import as_written, read_table, written
from meterwise.llm.tokens import chunks, encoder

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CAPACITY = 4096
# Pieces packed by one task; pieces one group releases in a round at most (with a
# gap, the others have their turn in later rounds); groups that meet in one round.
TASK_PIECES = 50_000
RELEASED = 20_000
FAN = 8
# Certified tasks release sequences filled below this share.
SPARE = 0.95
# part = round * ROUND + group; sequence_id = part * BINS + bin, doubled.
ROUND, BINS = 1 << 20, 1 << 24

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECE + ", part long, bin long, offset long, gap long, fill long, grp long"


def document_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                    capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every row of ``docs``."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        end = np.array([end_id], "<u2").tobytes()
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["text"]]
            doc_ids = [None if pd.isna(d) else int(d) for d in batch["doc_id"]]
            rows = []
            for a, b in chunks(texts):
                for d, x in zip(doc_ids[a:b], encode(texts[a:b])):
                    ids = np.frombuffer(x + end, "<u2").astype("<u4")
                    for k in range(0, len(ids), capacity):
                        part = ids[k:k + capacity]
                        rows.append((d, k // capacity, k, len(part), zlib.crc32(part.tobytes())))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return as_written(docs, "doc_id", "text").mapInPandas(cut, PIECE)


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing of lengths given in falling order: bin and offset
    of each, and the number of bins."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has exactly r free
    bins, offsets, n = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, x in enumerate(lengths.tolist()):
        fits = rooms >> x
        if fits:
            room = x + (fits & -fits).bit_length() - 1
            held = open_bins[room]
            b = held.pop()
            if not held:
                rooms &= ~(1 << room)
        else:
            room, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - room
        if room > x:
            open_bins[room - x].append(b)
            rooms |= 1 << (room - x)
    return bins, offsets, n


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing has fewer bins: the best of two families of dual feasible
    functions, u(k) that rounds sizes to multiples of 1/k, and f(e) that lets
    sizes above 1 - e fill a bin and those under e vanish."""
    x, n = np.unique(lengths, return_counts=True)
    best = -(-int((x * n).sum()) // capacity)
    for k in range(1, 33):
        whole = (k + 1) * x % capacity == 0
        value = np.where(whole, x * k, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((value * n).sum()) // (k * capacity)))
    for e in np.unique(np.minimum(x, capacity - x)):
        if 0 < 2 * e <= capacity:
            value = np.where(x > capacity - e, capacity, np.where(x < e, 0, x))
            best = max(best, -(-int((value * n).sum()) // capacity))
    return best


def _pack_task(capacity: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        part = TaskContext.get().partitionId()
        yield _packed(pd.concat(held, ignore_index=True), part, capacity).assign(grp=part)
    return pack


def _packed(rows: pd.DataFrame, part: int, capacity: int) -> pd.DataFrame:
    rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"],
                            ascending=[False, True, True, True], ignore_index=True)
    lengths = rows["length"].to_numpy()
    bins, offsets, n = best_fit(lengths, capacity)
    fill = np.bincount(bins, lengths, n).astype(np.int64)
    return rows.assign(part=part, bin=bins, offset=offsets, fill=fill[bins],
                       gap=n - lower_bound(lengths, capacity))


def _released(rows: DataFrame, capacity: int, released: int) -> DataFrame:
    """Marks the pieces of the emptiest sequences of each group: all that are not full
    of a part with a gap, and those with room to spare of a certified part (its
    bound holds for its own pieces only)."""
    spare = int(capacity * SPARE)
    per_bin = rows.where(f"fill < {spare} or (gap > 0 and fill < {capacity})").groupBy(
        "grp", "part", "bin", "fill").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("grp").orderBy("fill", "part", "bin").rowsBetween(Window.unboundedPreceding, 0)
    free = per_bin.withColumn("upto", F.sum("n").over(upto)).where(f"upto <= {released}")
    free = free.select(F.col("part").alias("r_part"), F.col("bin").alias("r_bin"))
    return rows.join(free, (F.col("part") == F.col("r_part")) & (F.col("bin") == F.col("r_bin")), "left") \
        .withColumn("free", F.col("r_bin").isNotNull()).drop("r_part", "r_bin")


def repack(rows: DataFrame, round_no: int, capacity: int) -> DataFrame:
    """Best-fit decreasing over each group of released pieces.  A group keeps
    its old sequences if the new ones are not fewer.  Pools are bounded
    by ``FAN`` groups releasing ``RELEASED`` pieces each."""
    def again(key, got: pd.DataFrame) -> pd.DataFrame:
        group = int(key[0])
        old = got.drop(columns="pool").assign(grp=group)
        new = _packed(old.drop(columns=["part", "bin", "offset", "gap", "fill", "grp"]),
                      round_no * ROUND + group, capacity).assign(grp=group)
        return new if new["bin"].nunique() < len(got[["part", "bin"]].drop_duplicates()) else old

    return rows.groupBy("pool").applyInPandas(again, PACKED)


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str = TOKENIZER,
                   end_id: int = END_ID, capacity: int = CAPACITY, task_pieces: int = TASK_PIECES,
                   released: int = RELEASED, fan: int = FAN) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    pieces = written(spark, document_pieces(docs, tokenizer, end_id, capacity), "pack-pieces")
    full = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)
    n = rest.count()
    first = (rest.repartition(max(1, -(-n // task_pieces)), F.xxhash64("doc_id", "piece", "ids_crc32"))
             .mapInPandas(_pack_task(capacity), PACKED))
    packed = written(spark, first, "pack-0")
    settled, groups, round_no, saved = [], _parts(packed), 0, 0
    while groups > 1 or saved:
        round_no += 1
        groups = -(-groups // fan)
        marked = written(spark, _released(packed, capacity, released), f"pack-marked-{round_no}")
        later = F.expr(f"not free and gap > 0 and fill < {capacity}")
        settled.append(marked.where(~later & ~F.col("free")).drop("free"))
        pool = F.floor(F.col("grp") / fan).cast("long")
        free = marked.where("free").drop("free").withColumn("pool", pool)
        again = written(spark, repack(free, round_no, capacity), f"pack-{round_no}")
        saved = _sequences(free) - _sequences(again)
        packed = again.unionByName(marked.where(later).drop("free").withColumn("grp", pool))
        if groups <= 1 and marked.where(later).isEmpty():
            break
    for more in settled:
        packed = packed.unionByName(more)
    out = packed.select("doc_id", "piece", "start", "length", "ids_crc32",
                        (2 * (F.col("part") * BINS + F.col("bin"))).alias("sequence_id"), "offset")
    alone = full.select("doc_id", "piece", "start", "length", "ids_crc32",
                        (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"),
                        F.lit(0).cast("long").alias("offset"))
    return out.unionByName(alone)


def _sequences(rows: DataFrame) -> int:
    return rows.select("part", "bin").distinct().count()


def _parts(packed: DataFrame) -> int:
    top = packed.agg(F.max("part")).first()[0]
    return 0 if top is None else int(top) + 1


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, read_table(spark, sf_dir, "documents"))
