"""Corrections of past months as signed deltas.

A corrected load of month M changes the monthly aggregates of M (and of months
its stray rows fall in).  Instead of recomputing all running totals from M on,
the difference *new - old* is appended to a ledger, one row per month and entity
that changed.  Running totals are read from base + ledger; folding adds the
ledger into the base.  Both tables have one row per month and entity, so reading
running totals never touches trips, and a correction reads the trips of the
corrected months only.

Aggregates must be exact (``money_mode="decimal"``), so that adding a delta equals
aggregating anew.  Entities that a correction adds or empties are handled: a month
without trips left has no row, as in a rebuild.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.operators.cumulative import project_cumulative, running_totals
from meterwise.operators.marts import MONTHLY_METRICS, SUM_DECIMAL, MartSpec, aggregate

MONTH = ("year_month", "pickup_year", "pickup_month")
METRICS = tuple(m for m, _, _ in MONTHLY_METRICS)
_LONG = ("monthly_trip_count", "monthly_passenger_count")


def _typed(name: str, c):
    return c.cast("long" if name in _LONG else SUM_DECIMAL).alias(name)


def monthly_base(fact: DataFrame, spec: MartSpec) -> DataFrame:
    """Exact monthly aggregates of an entity: the ledger's base."""
    return aggregate(fact, spec, "decimal").select(*MONTH, spec.entity, *[_typed(m, F.col(m)) for m in METRICS])


def correction_deltas(old: DataFrame, new: DataFrame, spec: MartSpec) -> DataFrame:
    """Signed changes of the monthly aggregates when trips ``old`` are replaced by
    ``new``: one aggregation over both, old ones negative; rows that did not
    change are left out."""
    signed = monthly_base(new, spec)
    minus = monthly_base(old, spec)
    signed = signed.unionByName(minus.select(*MONTH, spec.entity, *[(-F.col(m)).alias(m) for m in METRICS]))
    sums = signed.groupBy(*MONTH, spec.entity).agg(*[_typed(m, F.sum(m)) for m in METRICS])
    changed = None
    for m in METRICS:
        changed = (F.col(m) != 0) if changed is None else changed | (F.col(m) != 0)
    return sums.where(changed)


def append_correction(spark: SparkSession, path: str, deltas: DataFrame, correction: str) -> None:
    """Append deltas under ``correction=<name>``.  The folder of a name is written as a
    whole: a correction that is run again replaces its own rows, never adds them twice."""
    if not correction or not all(c.isalnum() or c in "-_." for c in correction):
        raise ValueError(f"bad correction name {correction!r}")
    deltas.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/correction={correction}")


def corrected_monthly(base: DataFrame, ledger: DataFrame | None, spec: MartSpec) -> DataFrame:
    """Monthly aggregates of base + ledger; months left without trips are gone."""
    cols = [*MONTH, spec.entity, *METRICS]
    rows = base.select(*cols)
    if ledger is not None:
        rows = rows.unionByName(ledger.select(*cols))
    sums = rows.groupBy(*MONTH, spec.entity).agg(*[_typed(m, F.sum(m)) for m in METRICS])
    return sums.where(F.col("monthly_trip_count") != 0)


def ledger_running_totals(base: DataFrame, ledger: DataFrame | None, spec: MartSpec, dim: DataFrame,
                          load_ts: bool = True) -> DataFrame:
    """The running-total mart from base + ledger."""
    monthly = corrected_monthly(base, ledger, spec)
    return project_cumulative(running_totals(monthly, spec.entity, "decimal"), spec, dim, load_ts)


def fold_ledger(spark: SparkSession, base_path: str, ledger_path: str, out_path: str, spec: MartSpec) -> list[str]:
    """Write base + ledger as a new base at ``out_path`` and return the names
    of the corrections it holds.  The caller switches to the new base and then
    drops these corrections (:func:`drop_corrections`); a correction
    that arrives meanwhile has another name and stays."""
    if out_path.rstrip("/") == base_path.rstrip("/"):
        raise ValueError("the new base is written beside the old one")
    ledger = spark.read.parquet(ledger_path)
    names = sorted(str(r[0]) for r in ledger.select("correction").distinct().collect())
    held = ledger.where(F.col("correction").cast("string").isin(names))
    corrected_monthly(spark.read.parquet(base_path), held, spec).write.mode("overwrite").parquet(out_path)
    return names


def drop_corrections(spark: SparkSession, ledger_path: str, names: list[str]) -> None:
    """Remove folded corrections from the ledger."""
    for name in names:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger_path.rstrip('/')}/correction={name}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
