"""Layer runners: Source -> Raw -> Cleaned -> Fact/Dim -> Marts.

A monthly load touches exactly the partitions it owns:

* Raw and Cleaned are partitioned by the *source* month of the load
  (``src_year``/``src_month``), so rerunning February rewrites February's
  load only, even when the February file holds January rows (G3).
* Fact and the hourly marts are rebuilt for the *pickup* months the load
  touched, from every load that holds rows of those months (G13: no full
  history rebuild for one new month).
* Cumulative marts are recomputed from the earliest touched month, seeded
  with the state just before it (N4).

A run is published after success (W8): it writes beside the layers, validates
there, and switches all of them at its end (:mod:`meterwise.sources.publish`); a
failed run leaves every layer as it was.

Each write carries an ``Observation`` so row counts and amounts come from
the write itself; validation reads the written tables (G8).
"""

from __future__ import annotations

import calendar
import datetime
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterwise.operators import clean as C
from meterwise.operators import cumulative as N
from meterwise.operators import marts as M
from meterwise.operators.dims import build_dim_date, build_dim_time, build_dim_vendor, build_dim_zone
from meterwise.operators.fact import build_fact, cleaned_for_months
from meterwise.operators.partial import build_daily_partial
from meterwise.operators.quality import continuity_summary, dsum, observe
from meterwise.session import (bounded_writes, checkpoint_dir, keeps_shuffle_setting, scratch_path, size_shuffles,
                               written_size)
from meterwise.sources import publish as P
from meterwise.sources.months import month_paths, months_of, resolve_months
from meterwise.sources.readers import detect_format, month_filter, read_loads, read_source
from meterwise.sources.writers import (RUN_LOG_SCHEMA, append_run_log, load_path, run_log_row,
                                       save_month, write_partitioned, write_table)


# Raw and Cleaned exist for every variant, Fact and marts for this one.
FACT_VARIANT = "yellow"


@dataclass
class Layout:
    """Folder layout of one deployment (all under shared storage)."""
    root: str
    variant: str = "yellow"
    marts: dict = field(default_factory=lambda: {
        "zone_hour": "mart/month_hour_zone", "vendor_hour": "mart/month_hour_vendor",
        "vendor_cumulative": "mart/month_vendor_cumulative",
        "zone_cumulative": "mart/month_zone_cumulative"})
    stage: P.Stage | None = None  # of the run at work

    def staged(self, run: str, whole: bool = False) -> Layout:
        """The layout as a run works on it."""
        return replace(self, stage=P.Stage(self.root, run, whole))

    def to(self, path: str) -> str:
        """Where a layer is written: beside it during a run."""
        return self.stage.to(path) if self.stage else path

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        return self.stage.read(spark, path) if self.stage else spark.read.parquet(path)

    def has(self, spark: SparkSession, path: str) -> bool:
        return self.stage.exists(spark, path) if self.stage else _exists(spark, path)

    def p(self, rel: str) -> str:
        return f"{self.root.rstrip('/')}/{rel}"

    @property
    def raw(self): return self.p(f"raw/{self.variant}")
    @property
    def cleaned(self): return self.p(f"cleaned/{self.variant}")
    @property
    def fact(self): return self.p("fact/trip")
    @property
    def dim_vendor(self): return self.p("dim/vendor")
    @property
    def partial_zone(self): return self.p("mart/partial_day_hour_zone")
    @property
    def run_log(self): return self.p("meta/run_log")
    @property
    def has_fact(self): return self.variant == FACT_VARIANT
    @property
    def load_months(self): return self.p(f"meta/load_months/{self.variant}")

    def dim(self, name: str) -> str:
        return self.p(f"dim/{name}")

    def mart(self, name: str) -> str:
        return self.p(self.marts[name])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _rows(obs, written: DataFrame) -> int:
    """Rows observed on a write; when the write had no rows to observe (an
    empty load makes Spark skip the metrics), count the written partitions
    instead (a Parquet footer count)."""
    try:
        return int(obs.get.get("rows", 0))
    except Exception:  # noqa: BLE001 - empty observation
        return written.count()


def load_raw(spark: SparkSession, layout: Layout, source: str | list[str], year: int, month: int,
             schema=None, files_per_partition: int | None = None, allow_empty: bool = True) -> dict:
    """O1 step 1: one monthly source file -> Raw (unmodified columns).

    ``allow_empty=False`` raises on an empty source (V3, the reference's
    behaviour) before anything is overwritten.
    """
    df, obs = observe(read_source(spark, source, schema, require_rows=not allow_empty), "raw")
    save_month(df, layout.to(layout.raw), year, month, files_per_partition)
    written = spark.read.parquet(load_path(layout.to(layout.raw), year, month))
    return {"rows": _rows(obs, written)}


def clean_loads(spark: SparkSession, layout: Layout, loads: list[tuple[int, int]],
                money_mode: str = "double", max_minutes: float = C.DEFAULT_MAX_MINUTES) -> dict:
    """O1 step 2: Raw loads -> Cleaned, same source-month partitions."""
    raw = read_loads(spark, layout.to(layout.raw), loads)
    cleaned = C.clean(raw, layout.variant, money_mode, max_minutes, keep=("src_year", "src_month"))
    out, obs = observe(cleaned, "cleaned")
    if len(loads) == 1:  # whole-folder overwrite: an empty result clears the load
        save_month(out, layout.to(layout.cleaned), *loads[0])
    else:
        # Dynamic overwrite keeps the old folder of a load that produced no
        # rows this time (G4): the loads that did produce rows ride on the
        # write as an observed metric (a set bounded by the number of loads),
        # and the others are cleared explicitly.
        seen = Observation("cleaned_loads")
        out = out.observe(seen, F.collect_set(F.struct("src_year", "src_month")).alias("loads"))
        write_partitioned(out, layout.to(layout.cleaned), ("src_year", "src_month"), mode="dynamic", cluster=False)
        try:
            produced = {(r["src_year"], r["src_month"]) for r in seen.get.get("loads", [])}
        except Exception:  # noqa: BLE001 - no metric arrived: ask the data instead
            produced = {(r["src_year"], r["src_month"])
                        for r in cleaned.select("src_year", "src_month").distinct().collect()}
        for y, m in sorted(set(loads) - produced):
            save_month(cleaned.limit(0), layout.to(layout.cleaned), y, m)
    written = (layout.read(spark, layout.cleaned).where(month_filter(loads, "src_year", "src_month"))
               if layout.has(spark, layout.cleaned) else out.limit(0))
    record_load_months(spark, layout, loads)
    return {"rows": _rows(obs, written)}


def record_load_months(spark: SparkSession, layout: Layout, loads: list[tuple[int, int]] | None = None) -> None:
    """Which pickup months each Cleaned load holds (load x month -> rows).

    Reads two integer columns of the written loads and keeps one row per
    (load, pickup month): a calendar-sized table.  It lets the fact builder
    read only the loads that hold a touched month (partition pruning on
    ``src_year``/``src_month``) instead of checking every file of history.
    """
    if not layout.has(spark, layout.cleaned):
        return
    c = layout.read(spark, layout.cleaned)
    if loads is not None:
        c = c.where(month_filter(loads, "src_year", "src_month"))
    lm = c.groupBy("src_year", "src_month", "pickup_year", "pickup_month").agg(F.count(F.lit(1)).alias("rows"))
    if loads is not None and len(loads) == 1:
        save_month(lm, layout.to(layout.load_months), *loads[0])
        return
    checkpoint_dir(spark)
    lm = lm.checkpoint(eager=True)  # calendar-sized; read twice below
    write_partitioned(lm, layout.to(layout.load_months), ("src_year", "src_month"),
                      mode="static" if loads is None else "dynamic")
    if loads is not None:  # loads that are now empty must not keep old entries
        have = {(r["src_year"], r["src_month"]) for r in lm.select("src_year", "src_month").distinct().collect()}
        for y, m in sorted(set(loads) - have):
            save_month(lm.limit(0), layout.to(layout.load_months), y, m)


def loads_holding(spark: SparkSession, layout: Layout, months: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Loads that hold rows of any of ``months`` (from the load-month table)."""
    lm = layout.read(spark, layout.load_months).where(month_filter(months, "pickup_year", "pickup_month"))
    return sorted((r["src_year"], r["src_month"]) for r in lm.select("src_year", "src_month").distinct().collect())


def months_by_load(spark: SparkSession, layout: Layout) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """The load-month table as (load, pickup month) pairs: calendar-sized."""
    if not layout.has(spark, layout.load_months):
        return []
    lm = layout.read(spark, layout.load_months)
    return [((r["src_year"], r["src_month"]), (r["pickup_year"], r["pickup_month"]))
            for r in lm.select("src_year", "src_month", "pickup_year", "pickup_month").distinct().collect()]


def held_months(spark: SparkSession, layout: Layout,
                loads: list[tuple[int, int]] | None = None) -> set[tuple[int, int]]:
    """Pickup months the loads hold now, by the load-month table."""
    if not layout.has(spark, layout.load_months):
        return set()
    lm = layout.read(spark, layout.load_months)
    if loads is not None:
        lm = lm.where(month_filter(loads, "src_year", "src_month"))
    return {(r["pickup_year"], r["pickup_month"])
            for r in lm.select("pickup_year", "pickup_month").distinct().collect()}


def drop_months(spark: SparkSession, layout: Layout, path: str, months) -> None:
    """Remove the partitions of months that no load holds any more (at the end of the run):
    a dynamic overwrite would keep them (G4)."""
    for y, m in sorted(months):
        part = f"year={y}/month={m}"
        if layout.stage:
            layout.stage.drop(path.rstrip("/"), part)
        else:
            P.delete(spark, f"{path.rstrip('/')}/{part}")


@keeps_shuffle_setting
def build_fact_for_loads(spark: SparkSession, layout: Layout, loads: list[tuple[int, int]],
                         money_mode: str = "double", before=()) -> tuple[list[tuple[int, int]], int]:
    """O2 step 1: Fact for the pickup months the loads touch.

    Touched are the months the loads hold now and those they held ``before``
    this run: a corrected load takes rows away as well.  The list is one row
    per month (collected: it chooses partitions).  Each touched month is
    rebuilt from every load holding it; a month that none holds any more is
    dropped.  Returns the touched months and the rows written for them.
    """
    pairs = months_by_load(spark, layout)  # asked once, for this run's loads and all others
    touched = sorted({m for load, m in pairs if load in set(loads)} | set(before))
    gone = set(touched) - {m for _, m in pairs}
    drop_months(spark, layout, layout.fact, gone)
    months = [m for m in touched if m not in gone]
    if not months:
        return touched, 0
    cleaned_all = layout.read(spark, layout.cleaned)
    sources = sorted({load for load, m in pairs if m in set(months)})
    size_shuffles(spark, [load_path(root, y, m) for y, m in sources for root in {layout.cleaned, layout.to(layout.cleaned)}])
    src = cleaned_all.where(month_filter(sources, "src_year", "src_month"))  # prunes load folders
    fact, obs = observe(build_fact(cleaned_for_months(src, months), with_ids=True, money_mode=money_mode), "fact")
    write_partitioned(fact, layout.to(layout.fact), ("year", "month"), mode="dynamic")
    return touched, _rows(obs, layout.read(spark, layout.fact).where(month_filter(months)))


def write_dims(spark: SparkSession, layout: Layout, zone_dim: DataFrame, held: set | None = None) -> None:
    """The zone, time and date dimensions.  The calendar spans the
    months that the load-month table names (``held``); no trip is read for it."""
    held = sorted(held_months(spark, layout) if held is None else held)
    write_table(build_dim_zone(zone_dim).coalesce(1), layout.to(layout.dim("zone")))
    if not layout.has(spark, layout.dim("time")):
        write_table(build_dim_time(spark).coalesce(1), layout.to(layout.dim("time")))
    if held:
        (y0, m0), (y1, m1) = held[0], held[-1]
        last = calendar.monthrange(y1, m1)[1]
        write_table(build_dim_date(spark, f"{y0:04d}-{m0:02d}-01", f"{y1:04d}-{m1:02d}-{last}").coalesce(1),
                    layout.to(layout.dim("date")))


@keeps_shuffle_setting
def build_daily_partials(spark: SparkSession, layout: Layout, months: list[tuple[int, int]] | None = None,
                         day: str | None = None, money_mode: str = "double") -> None:
    """A16 as a table: day x hour x zone partials under ``year=/month=/day=``.

    ``months`` (default all) or one ``day`` (``YYYY-MM-DD``) are rebuilt from
    the written Fact; only the partitions of those days are read and
    replaced.  A day that has no trips any more is dropped."""
    if day is not None:
        d = datetime.date.fromisoformat(day)
        months = [(d.year, d.month)]
    fact = spark.read.parquet(layout.fact)
    if months is not None:
        fact = fact.where(month_filter(months))
        drop_partials(spark, layout, months, day)
    if day is not None:
        fact = fact.where(F.col("pickup_date") == F.lit(day).cast("date"))
    partial = build_daily_partial(fact, money_mode=money_mode).withColumns(
        {"year": F.col("pickup_year"), "month": F.col("pickup_month"), "day": F.col("pickup_day")})
    write_partitioned(partial, layout.partial_zone, ("year", "month", "day"),
                      mode="static" if months is None else "dynamic")


def drop_partials(spark: SparkSession, layout: Layout, months, day: str | None = None) -> None:
    """Remove the partial folders of whole months, or of one day."""
    jvm = spark.sparkContext._jvm
    for y, m in months:
        rel = f"year={y}/month={m}" + (f"/day={datetime.date.fromisoformat(day).day}" if day else "")
        p = jvm.org.apache.hadoop.fs.Path(f"{layout.partial_zone}/{rel}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


HOURLY = (M.ZONE_HOUR, M.VENDOR_HOUR)
MONTHLY = {"vendor_cumulative": M.VENDOR_MONTH, "zone_cumulative": M.ZONE_MONTH}


def base_pass(spark: SparkSession, fact: DataFrame, money_mode: str) -> tuple[DataFrame, tuple]:
    """The only pass over the Fact that the dimensions, the four marts and
    their validation need.  All aggregates come from grouping sets and are
    written once, mart-sized, to the shared scratch folder; rows and amount of
    what was read are observed on the way.

    Exact sums add up, so in decimal mode the running totals roll up from the
    hourly marts; rounded doubles do not, so there the monthly aggregates are two
    more grouping sets of the same pass."""
    specs = [*HOURLY, *([] if money_mode == "decimal" else MONTHLY.values())]
    obs = Observation("base")
    seen = fact.observe(obs, F.count(F.lit(1)).alias("rows"), dsum(fact, "total_amount", "amount"))
    path = f"{scratch_path(spark, 'mart-base')}-{uuid.uuid4().hex[:12]}"
    base = M.aggregate_all(seen, specs, money_mode)
    schema = base.schema
    base.write.parquet(path)
    try:
        totals = (int(obs.get["rows"]), obs.get["amount"])
    except Exception:  # noqa: BLE001 - no rows, no metric
        totals = (0, None)
    written = spark.read.schema(schema).parquet(path)
    written.base_path = path
    return written, totals


def _drop_base(spark: SparkSession, base: DataFrame) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base.base_path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@keeps_shuffle_setting
def build_marts(spark: SparkSession, layout: Layout, months: list[tuple[int, int]], zone_dim: DataFrame,
                money_mode: str = "double", held: set | None = None) -> tuple | None:
    """O2 step 2 + O3 + O5: dims and the four marts for the touched months.
    Returns the rows and the amount of the Fact that was read for them.
    ``held`` (the months all loads hold now) saves asking for them again."""
    checkpoint_dir(spark)
    held = held_months(spark, layout) if held is None else held
    for mart in layout.marts.values():
        drop_months(spark, layout, layout.p(mart), set(months) - held)
    if not held:
        return None  # nothing is left to build
    size_shuffles(spark, [f"{layout.to(layout.fact)}/year={y}/month={m}" for y, m in months])
    fact = layout.read(spark, layout.fact).where(month_filter(months))
    base, totals = base_pass(spark, fact, money_mode)
    try:
        _marts_from_base(spark, layout, base, months, zone_dim, money_mode, held)
    finally:
        _drop_base(spark, base)
    return totals


def _marts_from_base(spark: SparkSession, layout: Layout, base: DataFrame, months, zone_dim: DataFrame,
                     money_mode: str, held: set) -> None:
    """Dimensions and marts of touched ``months`` from the aggregates of one pass."""
    # D1, incrementally: only codes of the touched months that the
    # dimension does not know yet are added; the common case (no new code)
    # costs one small probe and no rewrite.  The dimension is checkpointed
    # before it is rewritten in place.
    seen = build_dim_vendor(M.of_mart(base, M.VENDOR_HOUR))
    if layout.has(spark, layout.dim_vendor):
        old = layout.read(spark, layout.dim_vendor)
        fresh = seen.join(old.select(F.col("vendor_id").alias("_v")),
                          seen["vendor_id"].eqNullSafe(F.col("_v")), "left_anti")
        if not fresh.isEmpty():
            write_table(old.unionByName(fresh).checkpoint(eager=True), layout.to(layout.dim_vendor))
    else:
        write_table(seen, layout.to(layout.dim_vendor))
    dim_vendor = layout.read(spark, layout.dim_vendor)
    write_dims(spark, layout, zone_dim, held)
    for name, spec, dim in (("zone_hour", M.ZONE_HOUR, zone_dim), ("vendor_hour", M.VENDOR_HOUR, dim_vendor)):
        write_partitioned(M.finish_mart(M.of_mart(base, spec), spec, dim, money_mode), layout.to(layout.mart(name)),
                          mode="dynamic")
    start = months[0]
    k0 = start[0] * 12 + start[1]
    hourly_of = {"vendor_cumulative": "vendor_hour", "zone_cumulative": "zone_hour"}
    for name, spec, dim in (("vendor_cumulative", M.VENDOR_MONTH, dim_vendor),
                            ("zone_cumulative", M.ZONE_MONTH, zone_dim)):
        path = layout.mart(name)
        seed = None
        if layout.has(spark, path):
            # The seed is entity-sized; checkpointing it cuts the lineage to
            # the table about to be overwritten.
            seed = N.latest_state(layout.read(spark, path), spec.entity, start).checkpoint(eager=True)
        if money_mode == "decimal":
            # exact: roll the written hourly mart up, no pass over the fact
            hourly = layout.read(spark, layout.mart(hourly_of[name]))
            hourly = hourly.where(F.col("year") * 12 + F.col("month") >= k0) if seed is not None else hourly
            cum = N.cumulative_from_hourly(hourly, spec, dim, money_mode, True, seed)
        else:
            monthly = M.of_mart(base, spec)
            if seed is not None:
                # Only the touched months are aggregated; the monthly columns of
                # the other months since are in the written mart already.
                key = F.col("year") * 12 + F.col("month")
                kept = (layout.read(spark, path).where((key >= k0) & ~month_filter(months))
                        .withColumnsRenamed({"year": "pickup_year", "month": "pickup_month"}))
                monthly = monthly.unionByName(kept.select(*monthly.columns)).checkpoint(eager=True)
            cum = N.project_cumulative(N.running_totals(monthly, spec.entity, money_mode, seed), spec, dim, True)
        write_partitioned(cum, layout.to(path), mode="dynamic")


class _RunLog:
    """The run-log records of one run, appended in one write when the run ends
    (also when it fails, then with a ``failed`` record carrying the error).
    Every record tells the seconds since the one before it and, for written
    layers, bytes, files and rows per second of what this run wrote."""

    def __init__(self, spark: SparkSession, layout: Layout, loads):
        self.spark, self.layout, self.loads = spark, layout, loads
        self.run_id, self.records, self.clock = uuid.uuid4().hex, [], time.perf_counter()

    def add(self, layer: str, months, rows_in, rows_out, paths=(), status: str = "ok", **detail) -> None:
        now = time.perf_counter()
        seconds, self.clock = now - self.clock, now
        detail["seconds"] = round(seconds, 3)
        if paths:
            detail["bytes"], detail["files"] = written_size(self.spark, paths)
        if rows_out is not None:
            detail["rows_per_s"] = round(rows_out / max(seconds, 1e-3), 1)
        self.records.append(run_log_row(self.run_id, layer, months, rows_in, rows_out, status, detail))

    def __enter__(self):
        return self

    def __exit__(self, kind, error, trace):
        if error is not None:
            self.add("run", self.loads, None, None, status="failed", error=f"{type(error).__name__}: {error}")
        append_run_log(self.spark, self.layout.run_log, self.spark.createDataFrame(self.records, RUN_LOG_SCHEMA))


@contextmanager
def _published(log: _RunLog, whole: bool = False):
    """The layout of a run: what it writes stands beside the layers and takes
    their place when the run has ended well."""
    layout = log.layout.staged(log.run_id, whole)
    live, log.layout = log.layout, layout
    try:
        yield layout
        P.publish(log.spark, layout.stage)
    except BaseException:
        if not P.exists(log.spark, f"{layout.stage.folder}/_journal/_SUCCESS"):
            P.delete(log.spark, layout.stage.folder)
        raise
    finally:
        log.layout = live


def _finish_run(log: _RunLog, months, paths, whole: bool = False, totals: tuple | None = None) -> None:
    """Mart and validate records of a run; a failed check raises.  ``totals`` are
    the Fact's rows and amount as read for the marts."""
    v = validate_written(log.spark, log.layout, None if whole else months, 0.01, totals)
    named = [] if whole else months
    log.add("mart", named, v["fact_rows"], v.get("mart_rows"), paths)
    log.add("validate", named, v["fact_rows"], v["mart_trip_sum"], status="ok" if v["passed"] else "failed",
            amount_diff=str(v["amount_diff"]), failed=v.get("failed", []))
    if not v["passed"]:
        raise ValueError(f"validation of months {named or 'all'} failed: {v}")


@bounded_writes
def run_month(spark: SparkSession, layout: Layout, source: str | list[str], year: int, month: int,
              zone_dim: DataFrame, money_mode: str = "double",
              max_minutes: float = C.DEFAULT_MAX_MINUTES, schema=None, allow_empty: bool = False) -> str:
    """The monthly incremental run, with one run-log record per layer.

    An empty source file fails the run (and logs it) unless ``allow_empty``:
    a month is never replaced by nothing by accident.
    """
    loads = [(year, month)]
    P.recover(spark, layout.root)
    with _RunLog(spark, layout, loads) as log, _published(log) as layout:
        before = held_months(spark, layout, loads)
        raw = load_raw(spark, layout, source, year, month, schema, allow_empty=allow_empty)
        log.add("raw", loads, None, raw["rows"], [load_path(layout.to(layout.raw), year, month)])
        cl = clean_loads(spark, layout, loads, money_mode, max_minutes)
        log.add("cleaned", loads, raw["rows"], cl["rows"], [load_path(layout.to(layout.cleaned), year, month)])
        if not layout.has_fact:  # Fact and marts hold one variant
            return log.run_id
        months, rows = build_fact_for_loads(spark, layout, loads, money_mode, before)
        folders = [f"year={y}/month={m}" for y, m in months]
        held = held_months(spark, layout)
        left = sorted(held & set(months))
        log.add("fact", months, cl["rows"], rows, [f"{layout.to(layout.fact)}/{f}" for f in folders])
        totals = build_marts(spark, layout, months, zone_dim, money_mode, held) if months else None
        if left:
            _finish_run(log, left, [f"{layout.to(layout.mart(k))}/{f}" for k in layout.marts for f in folders], totals=totals)
        else:
            log.add("mart", months, 0, 0)
    return log.run_id


def run_range(spark: SparkSession, layout: Layout, source_root: str, zone_dim: DataFrame,
              start: str | None = None, end: str | None = None, padded: bool = True, **options) -> list[str]:
    """O1 over a range: the monthly run for every available month between the
    (open) bounds, in order; months outside stay as they are.  Raises when no
    month matches.  Returns the run ids."""
    months = resolve_months(spark, months_of(spark.read.parquet(source_root)), start, end)
    return [run_month(spark, layout, month_paths(source_root, [m], padded=padded), *m, zone_dim, **options)
            for m in months]


MART_COLUMNS = {  # mart -> (trip count, amount, entity of its running totals)
    "zone_hour": ("trip_count", "total_amount", None),
    "vendor_hour": ("trip_count", "total_amount", None),
    "zone_cumulative": ("monthly_trip_count", "monthly_total_amount", "pickup_location_id"),
    "vendor_cumulative": ("monthly_trip_count", "monthly_total_amount", "vendor_id"),
}


def validation_report(spark: SparkSession, layout: Layout, months: list[tuple[int, int]] | None = None,
                      tolerance: float = 0.01, fact_totals: tuple | None = None) -> DataFrame:
    """V1 + V2 on the *written* tables, one row per table: Cleaned and each of
    the four marts against the Fact, for ``months`` (default all).

    Trip counts must be equal.  Amounts must agree within ``tolerance`` (in
    double mode within 1e-9 of the total where that is more: sums of doubles
    depend on their order).  Running totals in exact mode must continue the
    month before (N5), over the whole mart.  ``fact_totals`` (rows and amount of
    these months, observed when the Fact was read) saves reading it again."""
    def read(path: str, year: str = "year", month: str = "month") -> DataFrame:
        df = layout.read(spark, path)
        return df if months is None else df.where(month_filter(months, year, month))

    def totals(df: DataFrame, name: str, trips, amount: str) -> DataFrame:
        return df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"),
                      F.coalesce(trips, F.lit(0)).cast("long").alias("trips"), dsum(df, amount, "amount"),
                      F.lit(0).cast("long").alias("violations"))

    sources = layout.read(spark, layout.cleaned)
    if months is not None:  # only the load folders that hold these months
        sources = sources.where(month_filter(loads_holding(spark, layout, months), "src_year", "src_month"))
        sources = sources.where(month_filter(months, "pickup_year", "pickup_month"))
    fact = read(layout.fact)
    exact = fact.schema["total_amount"].dataType.typeName() == "decimal"
    if fact_totals is None:
        of_fact = totals(fact, "fact", F.count(F.lit(1)), "total_amount")
    else:
        kind = fact.agg(dsum(fact, "total_amount", "amount")).schema["amount"].dataType
        rows, amount = fact_totals
        of_fact = spark.range(1).select(
            F.lit("fact").alias("name"), F.lit(rows).cast("long").alias("rows"), F.lit(rows).cast("long").alias("trips"),
            F.lit(amount).cast(kind).alias("amount"), F.lit(0).cast("long").alias("violations"))
    tables = [of_fact, totals(sources, "cleaned", F.count(F.lit(1)), "total_amount")]
    for name, (trips, amount, entity) in MART_COLUMNS.items():
        tables.append(totals(read(layout.mart(name)), name, F.sum(trips), amount))
        if entity and exact:
            steps = continuity_summary(layout.read(spark, layout.mart(name)), entity)
            tables.append(steps.select(F.lit(name).alias("name"), F.lit(0).cast("long").alias("rows"),
                                       F.lit(0).cast("long").alias("trips"), F.lit(None).alias("amount"),
                                       F.col("violations").cast("long").alias("violations")))
    per_table = reduce(lambda a, b: a.unionByName(b), tables).groupBy("name").agg(
        *[F.sum(c).alias(c) for c in ("rows", "trips", "amount", "violations")])
    # Six rows, one per table, side by side with the Fact's.
    rows = per_table.agg(F.collect_list(F.struct("*")).alias("t")).select(
        F.filter("t", lambda r: r["name"] == "fact")[0].alias("f"),
        F.explode(F.filter("t", lambda r: r["name"] != "fact")).alias("m"))
    diff = F.abs(F.coalesce("f.amount", F.lit(0)) - F.coalesce("m.amount", F.lit(0)))
    bound = F.lit(tolerance) if exact else F.greatest(F.lit(tolerance), F.abs(F.col("f.amount")) * 1e-9)
    return rows.select(
        "m.name", F.col("f.rows").alias("fact_rows"), F.col("m.rows").alias("rows"), "m.trips", "m.violations",
        F.col("f.amount").alias("fact_amount"), "m.amount", diff.alias("amount_diff"),
        ((F.col("m.trips") == F.col("f.rows")) & (F.col("m.violations") == 0)
         & F.coalesce(diff < bound, F.lit(True))).alias("passed"))


def validate_written(spark: SparkSession, layout: Layout, months: list[tuple[int, int]] | None = None,
                     tolerance: float = 0.01, fact_totals: tuple | None = None) -> dict:
    """The report of :func:`validation_report` in short (five rows back)."""
    rows = {r["name"]: r for r in validation_report(spark, layout, months, tolerance, fact_totals).collect()}
    failed = sorted(n for n, r in rows.items() if not r["passed"])
    return {"fact_rows": rows["cleaned"]["fact_rows"], "mart_trip_sum": rows["zone_hour"]["trips"],
            "mart_rows": sum(r["rows"] for n, r in rows.items() if n != "cleaned"),
            "amount_diff": max(r["amount_diff"] for r in rows.values()), "failed": failed, "passed": not failed}


@bounded_writes
@keeps_shuffle_setting
def backfill(spark: SparkSession, layout: Layout, source_root: str, zone_dim: DataFrame,
             money_mode: str = "double", max_minutes: float = C.DEFAULT_MAX_MINUTES, schema=None,
             files_per_partition: int | None = None, source_filter=None) -> dict:
    """O4 (full history): every monthly file under
    ``source_root/year=Y/month=MM`` through every layer, one job per layer.

    Partition discovery turns the folder names into the source month, so the
    Raw/Cleaned partitioning by load is the same as monthly runs produce.
    Every write is a *static* overwrite: a full rebuild must drop months that
    are no longer produced (G4), which dynamic overwrite would keep.  Pass an
    explicit ``schema`` to enforce one; otherwise every month is read with its
    own.  ``source_filter`` (a predicate on the folder columns
    ``year``/``month``) restricts the months of a *first* build; it is refused
    over existing layers, whose other months it would drop (use ``run_range``).

    A run-log record is kept per layer, with no months named: a whole build.
    """
    checkpoint_dir(spark)
    size_shuffles(spark, source_root)
    P.recover(spark, layout.root)
    if source_filter is not None and _exists(spark, layout.raw):
        raise ValueError(f"{layout.raw} exists: a filtered backfill would drop the other months")
    with _RunLog(spark, layout, []) as log, _published(log, whole=True) as staged:
        return _backfill(spark, staged, source_root, zone_dim, money_mode, max_minutes, schema,
                         files_per_partition, source_filter, log)


def _backfill(spark, layout, source_root, zone_dim, money_mode, max_minutes, schema, files_per_partition,
              source_filter, log: _RunLog) -> dict:
    narrow = files_per_partition is None  # rows stay with their load: nothing to move
    parquet = schema is None and detect_format(spark, source_root) == "parquet"
    src = read_loads(spark, source_root, None, "year", "month", padded=True) if parquet \
        else read_source(spark, source_root, schema)
    if source_filter is not None:
        src = src.where(source_filter)
    src = src.withColumnsRenamed({"year": "src_year", "month": "src_month"})
    raw, o_raw = observe(src, "raw")
    write_partitioned(raw, layout.to(layout.raw), ("src_year", "src_month"), mode="static",
                      files_per_partition=files_per_partition, cluster=not narrow)
    n_raw = o_raw.get.get("rows", 0)
    log.add("raw", [], None, n_raw, [layout.to(layout.raw)])
    cleaned, o_cl = observe(C.clean(read_loads(spark, layout.to(layout.raw)), layout.variant, money_mode, max_minutes,
                                    keep=("src_year", "src_month")), "cleaned")
    write_partitioned(cleaned, layout.to(layout.cleaned), ("src_year", "src_month"), mode="static",
                      files_per_partition=files_per_partition, cluster=not narrow)
    record_load_months(spark, layout)
    n_cl = o_cl.get.get("rows", 0)
    log.add("cleaned", [], n_raw, n_cl, [layout.to(layout.cleaned)])
    if not layout.has_fact:
        return {"raw_rows": n_raw, "cleaned_rows": n_cl, "fact_rows": 0}
    fact, o_fact = observe(build_fact(layout.read(spark, layout.cleaned), with_ids=True,
                                      money_mode=money_mode), "fact")
    write_partitioned(fact, layout.to(layout.fact), ("year", "month"), mode="static",
                      files_per_partition=files_per_partition)
    n_fact = o_fact.get.get("rows", 0)
    log.add("fact", [], n_cl, n_fact, [layout.to(layout.fact)])
    # The Fact is read once: dimension codes, marts and totals come from this pass.
    base, totals = base_pass(spark, layout.read(spark, layout.fact), money_mode)
    try:
        write_table(build_dim_vendor(M.of_mart(base, M.VENDOR_HOUR)), layout.to(layout.dim_vendor))
        write_dims(spark, layout, zone_dim)
        dim_vendor = layout.read(spark, layout.dim_vendor)
        for name, spec, dim in (("zone_hour", M.ZONE_HOUR, zone_dim), ("vendor_hour", M.VENDOR_HOUR, dim_vendor)):
            write_partitioned(M.finish_mart(M.of_mart(base, spec), spec, dim, money_mode), layout.to(layout.mart(name)),
                              mode="static")
        for name, hourly, dim in (("vendor_cumulative", "vendor_hour", dim_vendor),
                                  ("zone_cumulative", "zone_hour", zone_dim)):
            spec = MONTHLY[name]
            if money_mode == "decimal":  # exact roll-up of the hourly mart
                cum = N.cumulative_from_hourly(layout.read(spark, layout.mart(hourly)), spec, dim, money_mode)
            else:
                cum = N.project_cumulative(N.running_totals(M.of_mart(base, spec), spec.entity, money_mode), spec, dim,
                                           True)
            write_partitioned(cum, layout.to(layout.mart(name)), mode="static")
    finally:
        _drop_base(spark, base)
    _finish_run(log, None, [layout.to(layout.mart(k)) for k in layout.marts], whole=True, totals=totals)
    return {"raw_rows": n_raw, "cleaned_rows": n_cl, "fact_rows": n_fact}
