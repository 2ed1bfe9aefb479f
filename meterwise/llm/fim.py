"""Operator 13: fill-in-the-middle transformation, units selected by SWAR words.

A text's units are runs of words with the white space before them (and the
white space at its end).  A text is viewed as little-endian 64-bit words;
word-wide arithmetic marks the byte that ends each unit, ``bitwise_count``
counts the marks of a word, a search in the running counts finds the word that
holds the k-th end, and a byte-wise prefix sum of its marks selects the byte.  So
a text is never cut into its units, only at the two places that are wanted.

``fill_in_middle`` gives the outputs, ``restored`` rebuilds the text from an
output and its form alone: a text that holds a sentinel stays plain, and no
sentinel can arise where a part and a sentinel meet, as each starts with ``<``
and ends with ``>``.

Defined cases: a null text counts as empty; an empty text has no units and
stays plain; a text of white space is one unit; prefix, middle or suffix may be
empty; a null doc_id is hashed as an empty string; repeated rows give equal
results; an empty table gives an empty result; extra columns are ignored.  One
text at a time is held, of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm.common import read_table

SEED = 42
# Texts transformed, and of these in the order suffix-prefix-middle, in percent.
RATE = 50
SPM_RATE = 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

FORMED = "doc_id long, n long, form string, output string, prefix_chars long, middle_chars long"


def _each(byte: int) -> np.uint64:
    """A 64-bit word with ``byte`` in each of its bytes."""
    return np.uint64(byte * 0x0101010101010101)


HIGH, LOW7, ONES = _each(0x80), _each(0x7F), _each(0x01)
SPACE = _each(0x20)
# Added to seven bits, these reach the high bit from 0x09 and from 0x0E on.
FROM_TAB, PAST_RETURN = _each(0x80 - 0x09), _each(0x80 - 0x0E)


def unit_ends(raw: bytes) -> np.ndarray:
    """64-bit words over ``raw`` with the high bit of every byte that ends a
    unit: a byte of a word before white space or the end, and a last byte that
    is white space."""
    # At least one space follows, so the end is like white space.
    x = np.frombuffer(raw.ljust(len(raw) // 8 * 8 + 8, b" "), "<u8")
    seven = x & LOW7
    blank = (seven + FROM_TAB) & ~(seven + PAST_RETURN)
    blank |= ~((seven ^ SPACE) + LOW7)
    blank &= ~x & HIGH
    # The mark of each byte's follower, across words.
    after = blank >> np.uint64(8)
    after[:-1] |= blank[1:] << np.uint64(56)
    after[-1] |= np.uint64(0x80 << 56)
    ends = ~blank & after & HIGH
    if raw:
        last = len(raw) - 1
        ends[last // 8] |= blank[last // 8] & np.uint64(0x80 << 8 * (last % 8))
    return ends


def select_end(ends: np.ndarray, running: np.ndarray, k: int) -> int:
    """Offset after the k-th unit (0: the start)."""
    if k == 0:
        return 0
    word = int(np.searchsorted(running, k))
    within = k - (int(running[word - 1]) if word else 0)
    # Byte j of the product counts the marks in bytes 0 to j; those that have
    # reached ``within`` get their high bit from the sum.
    counts = int(ends[word] >> np.uint64(7)) * int(ONES) & 0xFFFFFFFFFFFFFFFF
    reached = counts + (0x80 - within) * int(ONES) & int(HIGH)
    return 8 * word + 9 - reached.bit_count()


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """h1 to h4 of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4)]


def transform(doc_id: int | None, text: str | None, seed: int = SEED, rate: int = RATE,
              spm_rate: int = SPM_RATE) -> tuple:
    """n, form, output, prefix_chars, middle_chars of one text."""
    raw = (text or "").encode("utf-8")
    ends = unit_ends(raw)
    running = np.cumsum(np.bitwise_count(ends), dtype=np.int64)
    n = int(running[-1])
    h = draws(doc_id, seed)
    if not raw or h[2] % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", text or "", None, None
    a, b = sorted(select_end(ends, running, x % (n + 1)) for x in h[:2])
    prefix, middle, suffix = (part.decode("utf-8") for part in (raw[:a], raw[a:b], raw[b:]))
    if h[3] % 100 < spm_rate:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, output, len(prefix), len(middle)


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n, form, output, prefix_chars, middle_chars of every row."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [transform(d, t, seed, rate, spm_rate)
                        for d, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())]
                n, form, output, prefix, middle = zip(*made)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(output, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())],
                    ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"])

    rows = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").alias("text"))
    return rows.mapInArrow(make, FORMED)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (F.when(form == "psm", F.concat(first, middle, second))
            .when(form == "spm", F.concat(second, middle, first)).otherwise(output))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(read_table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS digest,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
         ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
         ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4
  FROM cut),
formed AS (
  SELECT doc_id, text, units, n,
         least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT doc_id, text, n, form,
         coalesce(array_to_string(list_slice(units, 1, a), ''), '') AS prefix,
         coalesce(array_to_string(list_slice(units, a + 1, b), ''), '') AS middle,
         coalesce(array_to_string(list_slice(units, b + 1, n), ''), '') AS suffix
  FROM formed)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
