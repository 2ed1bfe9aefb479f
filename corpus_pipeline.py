"""The corpus pipeline: five of the training-data operators in a row.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written as
Parquet and read back as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``:

1. toxic documents go (fitted on the documents and ``labels`` at hand);
2. of every group of near copies one document stays;
3. secrets in the texts are masked;
4. sources are mixed to their weights: rows repeat as often as the mix says;
5. the rows are packed into sequences (one row per piece).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterwise.llm import jaccard_join, mixing, packing, secrets, toxicity
from meterwise.llm.common import read_table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(spark, docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(spark, docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(spark, docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _, forest = secrets.fit(spark, docs)
    return secrets.redacted(spark, docs, forest)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack),
]

# Scores, tokenizers and shingle classes have no SQL form; tests/llm holds the
# result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
