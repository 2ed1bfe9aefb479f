"""Operator 2: line-first quality rules (native).

Each line of a text is held against punctuation, navigation, boilerplate and
repetition rules; failing lines go, and a document that loses too large a
share of its text is rejected.  Base counts of the whole text are made in the
same pass.  Everything is DataFrame expressions within one row: no shuffle.

Defined cases: a null or empty text has all counts 0 and fails the base rule;
repeated rows are judged each on its own; lines without a word are neither
judged nor counted; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm.common import as_written, let, n_words, read_table

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
# Fixed values of the line rules, in percent of a line's characters or words.
MAX_SYMBOL_PCT = 10
MAX_UPPER_PCT = 50
MAX_SHOUT_PCT = 5
MIN_DISTINCT_PCT = 30
MIN_LINE_WORDS = 10
MIN_KEPT_PCT = 60
SEPARATORS = "|»›•·"
MAX_SEPARATORS = 2
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "enable javascript", "lorem ipsum", "licensed under", "permission is hereby granted",
    "subscribe to our", "click here", "powered by")


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def solid_chars(text: Column) -> Column:
    """Code points that are not ASCII white space."""
    return F.length(text) - count(text, r"[\x20\x09-\x0D]")


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def n_repeat_words(text: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash of their words.  Sorted by (hash,
    place), equal windows are neighbours; a repeated window starting at p
    covers p, p+1 and p+2, and with the starts in order each adds the words
    up to the next start, three at most.
    """
    def windows(w):
        return F.when(F.size(w) >= 3, F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
                               i.alias("i")))).otherwise(
            F.array().cast("array<struct<h:bigint,i:int>>"))

    def repeated(s):
        return F.array_sort(F.filter(
            F.transform(s, lambda x, j: F.when(
                (F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)))
                | (F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))), x["i"])),
            lambda p: p.isNotNull()))

    def covered(p):
        return F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
            F.lit(0).cast("long"), lambda a, v: a + v)

    return let(split_words(text), lambda w: let(F.array_sort(windows(w)),
                                    lambda s: let(repeated(s), covered)))


def base_counts(text: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n"), has_word)
    return {
        "n_words": n_words(text),
        "word_chars": solid_chars(text).cast("long"),
        "n_symbols": count(text, f"[{SYMBOLS}]").cast("long"),
        "n_dup_lines": let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"),
        "n_repeat_words": n_repeat_words(text),
    }


def line_passes(line: Column) -> Column:
    """The verdict on one line that has a word."""
    def judged(chars):
        punctuation = ((100 * count(line, f"[{SYMBOLS}]") <= MAX_SYMBOL_PCT * chars)
                       & (100 * count(line, "!") <= MAX_SHOUT_PCT * chars))
        shouting = (chars >= 20) & (100 * count(line, r"\p{Lu}") > MAX_UPPER_PCT * chars)
        navigation = count(line, f"[{SEPARATORS}]") > MAX_SEPARATORS
        boilerplate = let(F.lower(line), lambda x: reduce(
            or_, [F.contains(x, F.lit(p)) for p in BOILERPLATE]))
        repetitive = let(split_words(line), lambda w: (F.size(w) >= MIN_LINE_WORDS) & (
            100 * F.size(F.array_distinct(w)) < MIN_DISTINCT_PCT * F.size(w)))
        return punctuation & ~shouting & ~navigation & ~boilerplate & ~repetitive

    return let(solid_chars(line), judged)


def clean_lines(text: Column) -> Column:
    """The text without its failing lines (lines without words stay)."""
    return F.array_join(F.filter(F.split(text, "\n"),
                                 lambda x: ~has_word(x) | line_passes(x)), "\n")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, kept_chars, clean_text."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = as_written(docs, "doc_id", "text").select("doc_id", body.alias("body"))
    rows = rows.select("doc_id", *[c.alias(n) for n, c in base_counts(F.col("body")).items()],
                       clean_lines(F.col("body")).alias("clean_text"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    rows = (rows.withColumn("base_failed", failed)
            .withColumn("kept_chars", solid_chars(F.col("clean_text")).cast("long")))
    return rows.withColumn("kept", ~F.col("base_failed") & (
        100 * F.col("kept_chars") >= MIN_KEPT_PCT * F.col("word_chars")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "kept_chars")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (
  SELECT r, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS g
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM w)),
dup AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
cov AS (
  SELECT r, count(DISTINCT i + k)::BIGINT AS c FROM dup, (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
ln AS (
  SELECT r, x, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS chars,
    length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS sym,
    length(regexp_replace(x, '[^!]', '', 'g')) AS shout,
    length(regexp_replace(x, '[^\p{Lu}]', '', 'g')) AS capitals,
    regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS lw
  FROM (SELECT r, unnest(ls) AS x FROM w)),
good AS (
  SELECT r, sum(chars)::BIGINT AS kept_chars FROM ln
  WHERE 100 * sym <= 10 * chars AND 100 * shout <= 5 * chars
    AND NOT (100 * capitals > 50 * chars AND chars >= 20)
    AND length(regexp_replace(x, '[^|»›•·]', '', 'g')) <= 2
    AND NOT regexp_matches(lower(x), 'all rights reserved|terms of use|terms of service|privacy policy|cookie policy|enable javascript|lorem ipsum|licensed under|permission is hereby granted|subscribe to our|click here|powered by')
    AND NOT (len(lw) >= 10 AND 100 * len(list_distinct(lw)) < 30 * len(lw))
  GROUP BY r),
f AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(c, 0)::BIGINT AS n_repeat_words, coalesce(kept_chars, 0)::BIGINT AS kept_chars
  FROM w LEFT JOIN cov USING (r) LEFT JOIN good USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * kept_chars >= 60 * word_chars AS kept,
  kept_chars
FROM f
"""
