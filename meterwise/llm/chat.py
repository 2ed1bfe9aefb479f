"""Operator 7: chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent
turns of one role become one message whose turns stay separable; the pieces
are concatenated.  Control strings inside texts and roles are escaped by one
more backslash after their first character, which is undone exactly.

Template: ``<|im_start|>ROLE<|text|>TEXT(<|turn|>TEXT)*<|im_end|>\\n``.

Defined cases: a null text is an empty text and a null role an empty role;
turns sort by (turn, role, text), nulls first, so ties and repeated rows have
one order and are all kept; a null conv_id is a conversation of its own; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm.common import as_written, let, read_table

START, TEXT, TURN, END = "<|im_start|>", "<|text|>", "<|turn|>", "<|im_end|>\n"
# Control strings of this template and of other common ones.
CONTROL = r"(\||s>|/s>|/?INST\])"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, r"$1$2$3")


def _messages(turns: Column) -> Column:
    """Runs of one role as array of struct(role, texts)."""
    def cut(t):
        starts = F.filter(F.sequence(F.lit(0), F.size(t) - 1),
                          lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"]))
        return let(starts, lambda s: F.transform(s, lambda a, k: F.struct(
            F.get(t, a)["role"].alias("role"),
            F.transform(F.slice(t, a + 1, F.coalesce(F.get(s, k + 1), F.size(t)) - a),
                        lambda x: x["text"]).alias("texts"))))
    return let(turns, cut)


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, segments.

    ``segments`` is the formatted text cut where the loss mask changes:
    array of struct(text, loss); their concatenation is ``formatted``.
    """
    rows = as_written(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id", F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    chats = chats.select("conv_id", _messages(F.col("turns")).alias("messages"))

    def piece(text, loss):
        return F.struct(text.alias("text"), loss.alias("loss"))

    def message(m):
        loss = m["role"] == LOSS_ROLE
        head = piece(F.concat(F.lit(START), escape(m["role"]), F.lit(TEXT)), F.lit(False))
        texts = F.flatten(F.transform(m["texts"], lambda x, i: F.array(
            piece(F.when(i > 0, F.lit(TURN)).otherwise(F.lit("")), F.lit(False)),
            piece(escape(x), loss))))
        return F.concat(F.array(head), texts, F.array(piece(F.lit(END), F.lit(False))))

    segments = F.filter(F.flatten(F.transform("messages", message)), lambda x: x["text"] != "")
    out = chats.select("conv_id", segments.alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda x: x["text"]), ""))


def read_turns(formatted: Column) -> Column:
    """Array of struct(role, text) read back from a formatted conversation."""
    def message(m):
        return let(F.split(m, r"<\|text\|>", 2), lambda p: F.transform(
            F.split(F.get(p, 1), r"<\|turn\|>"),
            lambda x: F.struct(unescape(F.regexp_replace(F.get(p, 0), r"^<\|im_start\|>", "")).alias("role"),
                               unescape(x).alias("text"))))
    return F.flatten(F.transform(
        F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda m: m != ""), message))


def digests(chats: DataFrame) -> DataFrame:
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")
    rows = chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                        loss.alias("loss"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = as_written(read_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    return digests(format_chats(table.unionByName(extra)))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(\||s>|/s>|/?INST\])', '\1\\\2\3', 'g')) AS te,
    length(regexp_replace(role, '([<\[])(\\*)(\||s>|/s>|/?INST\])', '\1\\\2\3', 'g')) AS re,
    coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) <> role, true) AS head
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(te + CASE WHEN head THEN 12 + re + 8 + 11 ELSE 8 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
