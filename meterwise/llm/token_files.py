"""Operator 4: token ids in bit-packed files.

Every id takes the fewest bits that hold the vocabulary.  Documents are range
partitioned by doc_id and each task writes its range as files of its own; a
file has a header, a document table, block offsets and the packed blocks, so a
reader unpacks any block alone.  Files are written under a temporary name and
renamed, and a retried task writes the same names and bytes again.

Defined cases: a null text is empty and has the end id only; equal doc_ids
keep one row each, in text order; a null doc_id comes first and reads back as
null; an empty table gives no files and an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterwise.llm.common import as_written, read_table, work_path
from meterwise.llm.tokens import chunks, encoder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
MAGIC = b"TOKBITS1"
BLOCK_IDS = 65_536
FILE_IDS = 4_000_000


def id_bits(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits of each id, lowest bit first."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    lanes = (ids.astype("<u4")[:, None] >> np.arange(bits, dtype="<u4")) & 1
    return np.packbits(lanes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of a packed block as unsigned 32-bit integers."""
    if bits == 16:
        return np.frombuffer(data, "<u2", n).astype("<u4")
    lanes = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little")
    return (lanes.reshape(n, bits).astype("<u4") << np.arange(bits, dtype="<u4")).sum(1, dtype="<u4")


def file_bytes(doc_ids: list, counts: list[int], ids: np.ndarray, bits: int,
               block_ids: int = BLOCK_IDS) -> bytes:
    """One file: magic, lengths, then doc ids, null marks, id counts, block
    offsets and blocks."""
    blocks = [pack(ids[i:i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    offsets = np.cumsum([0] + [len(b) for b in blocks]).astype("<u8")
    docs = np.array([0 if d is None else d for d in doc_ids], "<i8")
    null = np.array([d is None for d in doc_ids], "u1")
    head = struct.pack("<8sIIQQ", MAGIC, bits, block_ids, len(docs), len(ids))
    return b"".join([head, docs.tobytes(), null.tobytes(), np.array(counts, "<u8").tobytes(),
                     offsets.tobytes(), *blocks])


class TokenFile:
    """Reads one file's bytes; any run of ids comes from its blocks alone."""

    def __init__(self, data: bytes):
        magic, self.bits, self.block_ids, n_docs, self.n_ids = struct.unpack_from("<8sIIQQ", data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = struct.calcsize("<8sIIQQ")
        self.docs = np.frombuffer(data, "<i8", n_docs, at)
        self.null = np.frombuffer(data, "u1", n_docs, at + 8 * n_docs)
        self.counts = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
        n_blocks = -(-self.n_ids // self.block_ids)
        self.offsets = np.frombuffer(data, "<u8", n_blocks + 1, at + 17 * n_docs).astype(np.int64)
        self.base = at + 17 * n_docs + 8 * (n_blocks + 1)
        self.data = data

    def block(self, k: int) -> np.ndarray:
        n = min(self.block_ids, self.n_ids - k * self.block_ids)
        return unpack(self.data[self.base + self.offsets[k]:self.base + self.offsets[k + 1]], n, self.bits)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        run = np.concatenate([self.block(k) for k in range(first, last + 1)])
        return run[start - first * self.block_ids:stop - first * self.block_ids]


def put(folder: str, name: str, data: bytes) -> str:
    """Write one file into a shared folder, whole or not at all."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    store.create_dir(root, recursive=True)
    hidden = f"{root}/_{name}.{uuid.uuid4().hex[:8]}"
    with store.open_output_stream(hidden) as out:
        out.write(data)
    store.move(hidden, f"{root}/{name}")
    return name


def write_token_files(spark: SparkSession, docs: DataFrame, folder: str,
                      tokenizer: str = TOKENIZER, end_id: int = END_ID,
                      file_ids: int = FILE_IDS) -> DataFrame:
    """Write the files and return one row per file: file, n_docs, n_ids.
    File names sort like the doc_ids inside."""
    rows = as_written(docs, "doc_id", "text")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        bits = id_bits(encode.vocabulary)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u2").tobytes()
        done, ids, counts, held, total = [], [], [], [], 0

        def flush():
            name = f"tokens-{part:06d}-{len(done):06d}.bin"
            data = file_bytes(held, counts, np.frombuffer(b"".join(ids), "<u2"), bits)
            done.append((put(folder, name, data), len(held), total))

        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["text"]]
            doc_ids = [None if pd.isna(d) else int(d) for d in batch["doc_id"]]
            for a, b in chunks(texts):
                for d, x in zip(doc_ids[a:b], encode(texts[a:b])):
                    held.append(d)
                    ids.append(x + end)
                    counts.append(len(x) // 2 + 1)
                    total += counts[-1]
                if total >= file_ids:
                    flush()
                    ids, counts, held, total = [], [], [], 0
        if held:
            flush()
        yield pd.DataFrame(done, columns=["file", "n_docs", "n_ids"])

    return ordered.mapInPandas(write, "file string, n_docs long, n_ids long")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """file, place (of the document in its file), doc_id, file_start, n_tokens
    and ids_crc32 of every document, from the files alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "tokens-*.bin").load(folder)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                held = TokenFile(bytes(content))
                starts = np.concatenate([[0], np.cumsum(held.counts)[:-1]]).astype(np.int64)
                ids = held.ids(0, held.n_ids)
                crc = [zlib.crc32(ids[s:s + n].tobytes()) for s, n in zip(starts, held.counts)]
                yield pd.DataFrame({
                    "file": path.rsplit("/", 1)[1], "place": np.arange(len(starts)),
                    "doc_id": pd.array(np.where(held.null == 1, None, held.docs), "Int64"),
                    "file_start": starts, "n_tokens": held.counts, "ids_crc32": np.array(crc, np.int64)})

    return files.select("path", "content").mapInPandas(
        read, "file string, place long, doc_id long, file_start long, n_tokens long, ids_crc32 long")


def document_starts(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """The documents of all files with their place in the whole stream.  The
    window runs over one row per file."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    docs = read_token_files(spark, folder)
    return docs.join(starts, "file").withColumn("start", F.col("base") + F.col("file_start"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "token-files")
    index = work_path(spark, "token-index")
    write_token_files(spark, read_table(spark, sf_dir, "documents"), folder).write.parquet(index)
    files = spark.read.parquet(index)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return document_starts(spark, folder, files).select("doc_id", "start", "n_tokens", "ids_crc32")


