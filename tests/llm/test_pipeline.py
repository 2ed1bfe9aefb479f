"""The pipeline's stages hold their promises and run() equals them in order."""

from collections import Counter

import corpus_pipeline
from meterwise.llm import queries


def test_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(queries.ORACLE) <= set(names)


def test_stages(spark, docs, tmp_path):
    sf = str(tmp_path)
    table = docs.select("doc_id", "text", "source", "lang")
    table.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(20 * i, i % 2) for i in range(1, 40)], "doc_id long, toxic int").write.parquet(
        f"{sf}/labels.parquet")
    held = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, held, sf)
        assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in held.schema], name
        path = f"{sf}/{name}"
        made.write.parquet(path)
        held = spark.read.parquet(path)
    last = corpus_pipeline.STAGES[-1][1](spark, held, sf)
    whole = corpus_pipeline.run(spark, sf)
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert Counter(map(key, last.collect())) == Counter(map(key, whole.collect())) and whole.count() > 0
