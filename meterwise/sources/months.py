"""Month ranges, discovery and coverage (S8-S11, U3), as DataFrames.

The reference builds Python lists of (year, month) tuples on the driver.  We
keep the *decisions* (which months to read) on the driver because they choose
paths, but the reporting forms are DataFrames so they compose with joins:
``month_range`` enumerates with ``sequence``, ``available_months`` comes from
partition discovery, and ``month_coverage`` is one left join.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_YM = re.compile(r"^\s*(\d{4})-(\d{1,2})\s*$")


def parse_year_month(value: str) -> tuple[int, int]:
    """``YYYY-MM`` -> (year, month); raises on malformed input or month 13."""
    m = _YM.match(value or "")
    if not m:
        raise ValueError(f"invalid year-month {value!r}; expected YYYY-MM")
    y, mo = int(m.group(1)), int(m.group(2))
    if not 1 <= mo <= 12:
        raise ValueError(f"invalid month in {value!r}")
    return y, mo


def iter_months(start: tuple[int, int], end: tuple[int, int]) -> list[tuple[int, int]]:
    """Inclusive calendar months between two bounds (driver-side, tiny)."""
    if start > end:
        raise ValueError(f"range start {start} is after end {end}")
    a, b = start[0] * 12 + start[1] - 1, end[0] * 12 + end[1] - 1
    return [(k // 12, k % 12 + 1) for k in range(a, b + 1)]


def month_range(spark: SparkSession, start: tuple[int, int] | str, end: tuple[int, int] | str) -> DataFrame:
    """Months between two bounds as a DataFrame ``(year, month)``."""
    s = parse_year_month(start) if isinstance(start, str) else start
    e = parse_year_month(end) if isinstance(end, str) else end
    if s > e:
        raise ValueError(f"range start {s} is after end {e}")
    d = F.explode(F.sequence(F.make_date(F.lit(s[0]), F.lit(s[1]), F.lit(1)),
                             F.make_date(F.lit(e[0]), F.lit(e[1]), F.lit(1)),
                             F.expr("INTERVAL 1 MONTH"))).alias("d")
    return (spark.range(1).select(d)
            .select(F.year("d").alias("year"), F.month("d").alias("month")))


def months_of(df: DataFrame, year_col: str = "year", month_col: str = "month") -> DataFrame:
    """Distinct months present in a (partitioned) table.

    On a partitioned Parquet table only partition columns are read, and the
    aggregation is partial per task, so this is a metadata-sized job.
    """
    return (df.select(F.col(year_col).cast("int").alias("year"),
                      F.col(month_col).cast("int").alias("month"))
            .distinct())


def month_coverage(requested: DataFrame, available: DataFrame) -> DataFrame:
    """S9 + U3: every requested month with ``status`` matched / missing.

    Months available but not requested are not reported (they are simply not
    read).  An empty ``matched`` set is an error for the caller to raise.
    """
    a = available.select("year", "month", F.lit(True).alias("_avail"))
    return (requested.join(a, ["year", "month"], "left")
            .select("year", "month",
                    F.when(F.col("_avail"), F.lit("matched")).otherwise(F.lit("missing")).alias("status")))


def resolve_months(spark: SparkSession, available: DataFrame, start: str | None = None,
                   end: str | None = None) -> list[tuple[int, int]]:
    """Available months inside an inclusive range with open bounds.

    Returns the matched months (bounded by the calendar, not the data) for
    the caller to turn into partition filters.  Raises when nothing matches.
    """
    bounds = available.agg(F.min(F.col("year") * 12 + F.col("month") - 1).alias("lo"),
                           F.max(F.col("year") * 12 + F.col("month") - 1).alias("hi")).first()
    if bounds is None or bounds["lo"] is None:
        raise ValueError("no data available")
    s = parse_year_month(start) if start else divmod(bounds["lo"], 12)
    e = parse_year_month(end) if end else divmod(bounds["hi"], 12)
    if start is None:
        s = (s[0], s[1] + 1)
    if end is None:
        e = (e[0], e[1] + 1)
    cov = month_coverage(month_range(spark, s, e), available)
    matched = [(r["year"], r["month"]) for r in
               cov.where("status = 'matched'").orderBy("year", "month").collect()]
    if not matched:
        raise ValueError(f"no data available between {s} and {e}")
    return matched


def month_paths(base: str, months, padded: bool = True) -> list[str]:
    """``base/year=Y/month=MM`` (padded, source layout) or
    ``month=M`` (Spark's own partition naming).  Both parse to int 1."""
    fmt = "{b}/year={y}/month={m:02d}" if padded else "{b}/year={y}/month={m}"
    return [fmt.format(b=base.rstrip("/"), y=y, m=m) for y, m in months]
