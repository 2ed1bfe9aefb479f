"""Readers for every layer.

One reader serves Source, Raw, Cleaned, Fact, Dim and Mart: Parquet unless
the input is CSV.  The format is decided from the file names (a directory
is probed for its first data file), not by catching a failed Parquet read:
a corrupt Parquet file must fail loudly, never be re-read as CSV.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DoubleType, StringType, StructField, StructType,
                               TimestampType)


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


_CSV_SUFFIXES = (".csv", ".csv.gz", ".csv.bz2", ".csv.zst")


def detect_format(spark: SparkSession, path: str, depth: int = 4) -> str:
    """``"csv"`` or ``"parquet"`` from the first data file under ``path``
    (driver-side listing of a few directory entries, no data read)."""
    low = path.lower()
    if low.endswith(_CSV_SUFFIXES):
        return "csv"
    if low.endswith(".parquet"):
        return "parquet"
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    frontier = [root]
    for _ in range(depth):
        nxt = []
        for d in frontier:
            if not fs.exists(d):
                continue
            for st in fs.listStatus(d):
                name = st.getPath().getName()
                if name.startswith(("_", ".")):
                    continue
                if st.isDirectory():
                    nxt.append(st.getPath())
                elif name.lower().endswith(_CSV_SUFFIXES):
                    return "csv"
                else:
                    return "parquet"
        frontier = nxt
    return "parquet"


def read_source(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None,
                require_rows: bool = False, base_path: str | None = None,
                fmt: str | None = None) -> DataFrame:
    """Read one or many paths.

    ``schema`` enforces an explicit (widened) schema on read; that is the
    fast path through INT32/DOUBLE drift (G10).  ``require_rows`` raises on an
    empty input with a limit-1 probe instead of a full count.
    """
    paths = _paths(path)
    fmt = fmt or detect_format(spark, paths[0])
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    if fmt == "csv":
        reader = reader.option("header", "true")
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
        df = reader.csv(paths)
    else:
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.parquet(*paths)
    if require_rows and df.isEmpty():
        raise ValueError(f"input is empty: {paths}")
    return df


def read_table(spark: SparkSession, path: str, months: Iterable[tuple[int, int]] | None = None,
               year_col: str = "year", month_col: str = "month") -> DataFrame:
    """Read a partitioned layer, optionally restricted to some months.

    The restriction is a filter on the partition columns, which Spark turns
    into ``PartitionFilters`` (directory pruning).  A predicate on a function
    of a timestamp column would not prune (S14).
    """
    df = spark.read.parquet(path)
    if months is not None:
        df = df.where(month_filter(months, year_col, month_col))
    return df


def month_filter(months: Iterable[tuple[int, int]], year_col: str = "year",
                 month_col: str = "month"):
    """``(year, month) IN (...)`` as a prunable predicate on partition ints."""
    months = sorted(set(months))
    if not months:
        return F.lit(False)
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(y, []).append(m)
    preds = [(F.col(year_col) == y) & F.col(month_col).isin(ms) for y, ms in by_year.items()]
    return reduce(lambda a, b: a | b, preds)


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with an explicit schema (no inference pass)."""
    schema = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"
    return (spark.read.option("header", "true").schema(schema).csv(path)
            .select(F.col("LocationID").alias("location_id"),
                    F.col("Borough").alias("borough"),
                    F.col("Zone").alias("zone"),
                    F.col("service_zone")))


def cast_to_schema(df: DataFrame, schema: StructType, allow_missing: bool = True) -> DataFrame:
    """Cast every column of ``schema`` present in ``df`` (case-insensitive),
    adding typed nulls for absent ones (P2).  Extra columns are kept."""
    lower = {c.lower(): c for c in df.columns}
    cols = []
    seen = set()
    for f in schema.fields:
        src = lower.get(f.name.lower())
        if src is not None:
            cols.append(F.col(src).cast(f.dataType).alias(f.name))
            seen.add(src)
        elif allow_missing:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"missing column {f.name}")
    cols += [F.col(c) for c in df.columns if c not in seen]
    return df.select(*cols)


def union_months(frames: Sequence[DataFrame], schema: StructType | None = None) -> DataFrame:
    """S12 + U1: each month is read on its own, cast to the target schema,
    then unioned by name.  Casting *before* the union is what makes files
    with INT32 and DOUBLE encodings of one column combinable."""
    if not frames:
        raise ValueError("no frames to union")
    if schema is not None:
        frames = [cast_to_schema(f, schema) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_months_drift_safe(spark: SparkSession, paths_by_month: dict[tuple[int, int], str | list[str]],
                           schema: StructType) -> DataFrame:
    """Per-month read -> cast -> unionByName (the general path: also
    handles INT64 under DOUBLE, which one widened read cannot)."""
    frames = []
    for (y, m), p in sorted(paths_by_month.items()):
        frames.append(read_source(spark, p).withColumns(
            {"src_year": F.lit(y).cast("int"), "src_month": F.lit(m).cast("int")}))
    return union_months(frames, schema)


_WHOLE = {"byte": 0, "short": 1, "integer": 2, "long": 3}


def widest(types: Sequence[DataType]) -> DataType:
    """The narrowest type that holds every one of ``types``: whole numbers
    widen to the longest, any mix with a fraction to double, anything else
    that differs to string."""
    names = {t.typeName() for t in types}
    if len({t.simpleString() for t in types}) == 1:
        return types[0]
    if names <= _WHOLE.keys():
        return max(types, key=lambda t: _WHOLE[t.typeName()])
    if names <= _WHOLE.keys() | {"float", "double", "decimal"}:
        return DoubleType()
    if names <= {"timestamp", "timestamp_ntz", "date"}:
        return TimestampType()
    return StringType()


def union_widened(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by (case-insensitive) name of frames whose schemas differ: typed
    nulls for absent columns, the widest type for differing ones."""
    types: dict[str, list[DataType]] = {}
    spelled: dict[str, str] = {}
    for f in frames:
        for c in f.schema.fields:
            types.setdefault(c.name.lower(), []).append(c.dataType)
            spelled.setdefault(c.name.lower(), c.name)
    target = StructType([StructField(spelled[k], widest(v)) for k, v in types.items()])
    return reduce(lambda a, b: a.unionByName(b), [cast_to_schema(f, target) for f in frames])


def read_loads(spark: SparkSession, root: str, loads: Sequence[tuple[int, int]] | None = None,
               year_col: str = "src_year", month_col: str = "src_month", padded: bool = False) -> DataFrame:
    """Every load with its own schema (S2, S12, P2): an optional column of
    some loads is kept, and differing encodings of a column are widened.

    All loads of a Parquet root are read in one pass with merged schemas
    (footers only); where encodings disagree, loads are grouped by schema and
    each group is one scan.
    """
    if loads is None:
        try:
            return spark.read.option("mergeSchema", "true").parquet(root)
        except (PySparkException, Py4JJavaError) as e:
            if "CANNOT_MERGE_" not in str(e):
                raise
        found = spark.read.parquet(root).select(year_col, month_col).distinct().collect()
        loads = [(r[year_col], r[month_col]) for r in found]
    month = "{m:02d}" if padded else "{m}"
    paths = [f"{root.rstrip('/')}/{year_col}={y}/" + f"{month_col}={month.format(m=m)}" for y, m in sorted(loads)]
    groups = schema_groups(spark, paths)
    return union_widened([spark.read.schema(schema).option("basePath", root).parquet(*group)
                          for schema, group in groups])


def schema_groups(spark: SparkSession, paths: Sequence[str], at_once: int = 16) -> list[tuple[StructType, list[str]]]:
    """Folders grouped by the schema of their files, in order of first
    appearance.  Reads footers only, of ``at_once`` folders at a time; all files of one
    folder count, as one load may have been written by several versions."""
    def fingerprint(path: str) -> StructType:
        return spark.read.option("mergeSchema", "true").parquet(path).schema

    with ThreadPoolExecutor(max_workers=min(at_once, max(1, len(paths)))) as pool:
        schemas = list(pool.map(fingerprint, paths))
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for path, schema in zip(paths, schemas):
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    return list(groups.values())
