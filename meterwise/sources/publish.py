"""Publish after success (W8): a run writes beside the layers, is validated
there, and only then takes their place.

While a run works, its partitions stand under ``<root>/_staging/<run>``.  Reads of
the run see the layers with its own partitions in place of the old ones; all
other readers see the layers as they were.  Publishing writes a journal of what
is to move (one small committed table) and then renames folders: the old partition
aside, the new one into its place.  A run that fails before the journal leaves
every layer untouched; one that dies after it is finished by the next run
(:func:`recover`), which repeats only what is missing.

Renames cost no data on a file system that has them (HDFS, local disks).  On
an object store register the layers as catalog tables and switch the
partition's location instead (:func:`meterwise.sources.catalog.switch_partition`).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOURNAL = "part string, live string, staged string, old string"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, a = _fs(spark, source)
    _, b = _fs(spark, target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def _listing(spark: SparkSession, path: str) -> tuple[list[str], bool]:
    """Partition folders of a folder, and whether it holds data files."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return [], False
    found = [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(p)]
    return (sorted(n for n, folder in found if folder and "=" in n),
            any(not folder and n[0] not in "_." for n, folder in found))


def has_data(spark: SparkSession, path: str) -> bool:
    folders, files = _listing(spark, path)
    return bool(folders) or files


def partitions(spark: SparkSession, path: str) -> list[str]:
    """Relative folders (``a=1/b=2``) of a partitioned table, [""] of another, [] of
    none or of one without files.  Folder listing only: one call per folder."""
    folders, files = _listing(spark, path)
    if files:
        return [""]
    return [f"{n}/{rest}".rstrip("/") for n in folders for rest in partitions(spark, f"{path.rstrip('/')}/{n}")]


@dataclass
class Stage:
    """What one run has written and not yet published."""
    root: str
    run: str
    # Whole layers are replaced (a full rebuild), not partitions of them.
    whole: bool = False
    gone: set = field(default_factory=set)  # (layer path, partition) to remove
    touched: list = field(default_factory=list)  # layer paths written, in order

    @property
    def folder(self) -> str:
        return f"{self.root.rstrip('/')}/_staging/{self.run}"

    def path(self, live: str) -> str:
        """Where the run writes what is to stand at ``live``."""
        rel = live[len(self.root.rstrip("/")) + 1:]
        return f"{self.folder}/{rel}"

    def to(self, live: str) -> str:
        if live not in self.touched:
            self.touched.append(live)
        return self.path(live)

    def drop(self, live: str, part: str) -> None:
        self.gone.add((live, part))

    def exists(self, spark: SparkSession, live: str) -> bool:
        return exists(spark, self.path(live)) or (exists(spark, live) and not self.whole)

    def read(self, spark: SparkSession, live: str) -> DataFrame:
        """A layer as it will be: its partitions, the run's own ones instead where it has any."""
        staged = self.path(live)
        own = partitions(spark, staged)
        if own == [""] or (self.whole and own):
            return spark.read.parquet(staged)
        hidden = set(own) | {p for at, p in self.gone if at == live}
        kept = spark.read.parquet(live) if has_data(spark, live) else None
        if kept is not None and hidden:
            kept = kept.where(~_within(hidden))
        if not own:
            return kept if kept is not None else spark.read.parquet(live)
        new = spark.read.parquet(staged)
        return new if kept is None else new.unionByName(kept, allowMissingColumns=True)


def _within(parts) -> F.Column:
    """Whether a row is in one of the partitions (a predicate on partition
    columns only, so that folders are pruned)."""
    any_of = F.lit(False)
    for part in sorted(parts):
        every = F.lit(True)
        for pair in part.split("/"):
            name, _, value = pair.partition("=")
            every &= F.col(name).cast("string") == F.lit(value)
        any_of |= every
    return any_of


def publish(spark: SparkSession, stage: Stage) -> None:
    """Switch the layers to what the run has staged."""
    moves = []
    for live in stage.touched:
        staged, old = stage.path(live), f"{stage.folder}/_old/{live[len(stage.root.rstrip('/')) + 1:]}"
        for part in [""] if stage.whole and has_data(spark, staged) else partitions(spark, staged):
            end = f"/{part}" if part else ""
            moves.append((part, live + end, staged + end, old + end))
    for live, part in sorted(stage.gone):
        moves.append((part, f"{live}/{part}", None, f"{stage.folder}/_old/{live[len(stage.root.rstrip('/')) + 1:]}/{part}"))
    journal = f"{stage.folder}/_journal"
    # From the commit of this table on, the run is published.
    spark.createDataFrame(moves, JOURNAL).coalesce(1).write.mode("overwrite").json(journal)
    _finish(spark, stage.folder)


def _finish(spark: SparkSession, folder: str) -> None:
    """Do the moves of a journal that are not done yet, then clear the run's folder."""
    for m in spark.read.schema(JOURNAL).json(f"{folder}/_journal").collect():  # one row per partition of a run
        if m["staged"] is None:
            if exists(spark, m["live"]) and not exists(spark, m["old"]):
                move(spark, m["live"], m["old"])
        elif exists(spark, m["staged"]):
            if exists(spark, m["live"]):
                if exists(spark, m["old"]):
                    raise OSError(f"{m['live']} was written by another run while {folder} was published")
                move(spark, m["live"], m["old"])
            move(spark, m["staged"], m["live"])
    delete(spark, folder)


def recover(spark: SparkSession, root: str) -> list[str]:
    """Finish runs that died while publishing and clear what failed runs have
    left.  Returns the names of the runs that were finished.  Layers have one
    writer at a time, so no other run is at work."""
    base = f"{root.rstrip('/')}/_staging"
    fs, p = _fs(spark, base)
    finished = []
    if not fs.exists(p):
        return finished
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if exists(spark, f"{base}/{name}/_journal/_SUCCESS"):
            _finish(spark, f"{base}/{name}")
            finished.append(name)
        else:
            delete(spark, f"{base}/{name}")
    return finished
