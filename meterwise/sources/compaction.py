"""Compaction by file size (W9): only undersized files are rewritten.

The plan comes from a listing of the table's files (paths and lengths; no data is
read).  Within a partition, undersized files are packed into outputs of about
the target size; files that are large enough, and a single small file with
nothing to join, stay as they are.  New files are written beside the table and
moved into its folders under hidden names; a journal is committed; then, folder by
folder, the old files are hidden and the new ones shown.  A job that fails before the
journal changes nothing, one that dies after it is finished by
:func:`finish_compaction`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterwise.sources.publish import _fs, _listing, delete, exists, move

TARGET_BYTES = 256 << 20
JOURNAL = "folder string, name string, kind string"


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """file, folder, bytes of every data file of a table (listing only: the
    content column is pruned)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(path)
    return files.select(F.col("path").alias("file"), F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"),
                        F.col("length").alias("bytes"))


def compaction_plan(files: DataFrame, target_bytes: int = TARGET_BYTES, small_bytes: int | None = None) -> DataFrame:
    """file, folder, bytes, pack of the files to rewrite.

    A file below ``small_bytes`` (half the target) is undersized.  A folder's undersized files,
    by name, go to packs by the running sum of their sizes; packs of one file are left out."""
    small = files.where(F.col("bytes") < (small_bytes or target_bytes // 2))
    # Rows here are files of one folder, not data.
    before = Window.partitionBy("folder").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    packed = small.withColumn("pack", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes))
    together = packed.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("folder", "pack")))
    return together.where(F.col("_n") > 1).drop("_n")


def compact_small(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES,
                  small_bytes: int | None = None) -> dict:
    """Rewrite the undersized files of a Parquet table in place; returns the
    files and bytes read and the files written."""
    path = path.rstrip("/")
    finish_compaction(spark, path)
    # One row per undersized file: what the driver lists for any read of them.
    plan = compaction_plan(file_sizes(spark, path), target_bytes, small_bytes).collect()
    if not plan:
        return {"files_read": 0, "bytes_read": 0, "files_written": 0}
    packs = {key: n for n, key in enumerate(sorted({(r["folder"], r["pack"]) for r in plan}))}
    named = spark.createDataFrame([(r["file"], packs[r["folder"], r["pack"]]) for r in plan], "_file string, _pack int")
    columns = [f.name for f in spark.read.parquet(plan[0]["file"]).schema.fields]
    # Files are read as they are, without the columns of their folders.
    rows = spark.read.option("mergeSchema", "true").parquet(*[r["file"] for r in plan])
    columns += [c for c in rows.columns if c not in columns]
    rows = rows.select(*columns, F.col("_metadata.file_path").alias("_file"))
    staging = f"{path}/_compaction/{uuid.uuid4().hex[:12]}"
    # A pack is one task and one file.
    out = rows.join(F.broadcast(named), "_file").drop("_file").repartitionById(len(packs), F.col("_pack"))
    out.write.partitionBy("_pack").parquet(f"{staging}/new")
    steps = [(r["folder"], r["file"].rsplit("/", 1)[1], "old") for r in plan]
    for (folder, _), n in packs.items():
        pack = f"{staging}/new/_pack={n}"
        for k, name in enumerate(_data_files(spark, pack)):
            shown = f"compacted-{staging.rsplit('/', 1)[1]}-{n:05d}-{k}.parquet"
            move(spark, f"{pack}/{name}", f"{folder}/_{shown}")
            steps.append((folder, shown, "new"))
    spark.createDataFrame(sorted(steps), JOURNAL).coalesce(1).write.json(f"{staging}/_journal")
    finish_compaction(spark, path)
    return {"files_read": len(plan), "bytes_read": sum(r["bytes"] for r in plan),
            "files_written": sum(kind == "new" for _, _, kind in steps)}


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().endswith(".parquet"))


def finish_compaction(spark: SparkSession, path: str) -> int:
    """Finish compactions whose journal is committed and clear the rest.
    Returns how many were finished."""
    base = f"{path.rstrip('/')}/_compaction"
    if not exists(spark, base):
        return 0
    fs, p = _fs(spark, base)
    done = 0
    for s in fs.listStatus(p):
        staging = f"{base}/{s.getPath().getName()}"
        if exists(spark, f"{staging}/_journal/_SUCCESS"):
            rows = spark.read.schema(JOURNAL).json(f"{staging}/_journal").collect()  # one row per file moved
            for r in sorted(rows, key=lambda r: (r["folder"], r["kind"] == "new")):
                shown, hidden = f"{r['folder']}/{r['name']}", f"{r['folder']}/_{r['name']}"
                if r["kind"] == "old" and exists(spark, shown):
                    move(spark, shown, hidden)
                elif r["kind"] == "new" and exists(spark, hidden):
                    move(spark, hidden, shown)
            for r in rows:
                if r["kind"] == "old":
                    delete(spark, f"{r['folder']}/_{r['name']}")
            done += 1
        else:
            _clear_hidden(spark, path, s.getPath().getName())
        delete(spark, staging)
    delete(spark, base)
    return done


def _clear_hidden(spark: SparkSession, folder: str, run: str) -> None:
    """Remove files that a compaction without a journal has put under hidden names."""
    fs, p = _fs(spark, folder)
    for s in fs.listStatus(p):
        if s.getPath().getName().startswith(f"_compacted-{run}-"):
            fs.delete(s.getPath(), False)
    for name in _listing(spark, folder)[0]:
        _clear_hidden(spark, f"{folder.rstrip('/')}/{name}", run)
