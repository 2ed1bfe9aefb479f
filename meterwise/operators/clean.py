"""Raw -> Cleaned for the four source variants.

A variant is data, not code: a :class:`VariantSpec` names the timestamp and
location columns, the variant's quality rules and its output projection, and
one function (:func:`clean`) applies any spec.  Every rule is a named
predicate so the same list drives the filter (F1-F4), the one-pass filter
statistics (F7) and the reject report (F8).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.functions.numeric import cast_long, money
from meterwise.functions.time import time_features

# Largest accepted trip duration in minutes (the reference caps at one day).
DEFAULT_MAX_MINUTES = 1440.0


@dataclass(frozen=True)
class VariantSpec:
    name: str
    pickup: str
    dropoff: str
    pu_location: str
    do_location: str
    # (output name, source column, kind): kind is long | money | string | raw
    columns: tuple = ()
    # rules beyond the shared time/location ones: (name, sql predicate)
    extra_rules: tuple = ()
    optional_doubles: tuple = ()


def _cols(*spec):
    return tuple(spec)


_TIME_BLOCK = ("pickup_datetime", "dropoff_datetime", "pickup_date", "year_month",
               "pickup_year", "pickup_month", "pickup_day", "pickup_hour", "pickup_dayofweek")

# Fixed values from the source variants' published layouts: column names,
# their cleaned names and the quality bounds (passengers 1..8, distance
# (0, 200]) that must be the same for results to match.
YELLOW = VariantSpec(
    name="yellow", pickup="tpep_pickup_datetime", dropoff="tpep_dropoff_datetime",
    pu_location="PULocationID", do_location="DOLocationID",
    columns=_cols(
        ("vendor_id", "VendorID", "long"),
        ("pickup_location_id", "PULocationID", "long"),
        ("dropoff_location_id", "DOLocationID", "long"),
        ("ratecode_id", "RatecodeID", "long"),
        ("payment_type", "payment_type", "long"),
        ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
        ("@time", None, None),
        ("passenger_count", "passenger_count", "long"),
        ("trip_distance", "trip_distance", "money"),
        ("trip_duration_sec", "trip_duration_sec", "raw"),
        ("trip_duration_min", "trip_duration_min", "raw"),
        ("fare_amount", "fare_amount", "money"),
        ("extra", "extra", "money"),
        ("mta_tax", "mta_tax", "money"),
        ("tip_amount", "tip_amount", "money"),
        ("tolls_amount", "tolls_amount", "money"),
        ("improvement_surcharge", "improvement_surcharge", "money"),
        ("total_amount", "total_amount", "money"),
        ("congestion_surcharge", "congestion_surcharge", "money"),
        ("airport_fee", "Airport_fee", "money"),
        ("cbd_congestion_fee", "cbd_congestion_fee", "money"),
    ),
    extra_rules=(
        ("passenger_count_positive", "passenger_count > 0"),
        ("passenger_count_max_8", "passenger_count <= 8"),
        ("trip_distance_positive", "trip_distance > 0"),
        ("trip_distance_max_200", "trip_distance <= 200"),
        ("fare_amount_positive", "fare_amount > 0"),
        ("total_amount_positive", "total_amount > 0"),
    ),
    optional_doubles=("cbd_congestion_fee",),
)

GREEN = VariantSpec(
    name="green", pickup="lpep_pickup_datetime", dropoff="lpep_dropoff_datetime",
    pu_location="PULocationID", do_location="DOLocationID",
    columns=_cols(
        ("vendor_id", "VendorID", "long"),
        ("pickup_location_id", "PULocationID", "long"),
        ("dropoff_location_id", "DOLocationID", "long"),
        ("ratecode_id", "RatecodeID", "long"),
        ("payment_type", "payment_type", "long"),
        ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
        ("trip_type", "trip_type", "long"),
        ("@time", None, None),
        ("passenger_count", "passenger_count", "long"),
        ("trip_distance", "trip_distance", "money"),
        ("trip_duration_sec", "trip_duration_sec", "raw"),
        ("trip_duration_min", "trip_duration_min", "raw"),
        ("fare_amount", "fare_amount", "money"),
        ("extra", "extra", "money"),
        ("mta_tax", "mta_tax", "money"),
        ("tip_amount", "tip_amount", "money"),
        ("tolls_amount", "tolls_amount", "money"),
        ("ehail_fee", "ehail_fee", "money"),
        ("improvement_surcharge", "improvement_surcharge", "money"),
        ("total_amount", "total_amount", "money"),
        ("congestion_surcharge", "congestion_surcharge", "money"),
        ("cbd_congestion_fee", "cbd_congestion_fee", "money"),
    ),
    extra_rules=YELLOW.extra_rules,
    optional_doubles=("cbd_congestion_fee",),
)

FHVHV = VariantSpec(
    name="fhvhv", pickup="pickup_datetime", dropoff="dropoff_datetime",
    pu_location="PULocationID", do_location="DOLocationID",
    columns=_cols(
        ("hvfhs_license_num", "hvfhs_license_num", "string"),
        ("dispatching_base_num", "dispatching_base_num", "string"),
        ("originating_base_num", "originating_base_num", "string"),
        ("pickup_location_id", "PULocationID", "long"),
        ("dropoff_location_id", "DOLocationID", "long"),
        ("request_datetime", "request_datetime", "raw"),
        ("on_scene_datetime", "on_scene_datetime", "raw"),
        ("@time", None, None),
        ("trip_distance", "trip_miles", "money"),
        ("trip_time", "trip_time", "long"),
        ("trip_duration_sec", "trip_duration_sec", "raw"),
        ("trip_duration_min", "trip_duration_min", "raw"),
        ("base_passenger_fare", "base_passenger_fare", "money"),
        ("tolls", "tolls", "money"),
        ("bcf", "bcf", "money"),
        ("sales_tax", "sales_tax", "money"),
        ("congestion_surcharge", "congestion_surcharge", "money"),
        ("airport_fee", "airport_fee", "money"),
        ("tips", "tips", "money"),
        ("driver_pay", "driver_pay", "money"),
        ("cbd_congestion_fee", "cbd_congestion_fee", "money"),
        ("shared_request_flag", "shared_request_flag", "string"),
        ("shared_match_flag", "shared_match_flag", "string"),
        ("wav_request_flag", "wav_request_flag", "string"),
        ("wav_match_flag", "wav_match_flag", "string"),
    ),
    extra_rules=(
        ("trip_miles_positive", "trip_miles > 0"),
        ("trip_miles_max_200", "trip_miles <= 200"),
        ("base_passenger_fare_positive", "base_passenger_fare > 0"),
    ),
    optional_doubles=("cbd_congestion_fee",),
)

FHV = VariantSpec(
    name="fhv", pickup="pickup_datetime", dropoff="dropOff_datetime",
    pu_location="PUlocationID", do_location="DOlocationID",
    columns=_cols(
        ("dispatching_base_num", "dispatching_base_num", "string"),
        ("affiliated_base_num", "Affiliated_base_number", "string"),
        ("pickup_location_id", "PUlocationID", "long"),
        ("dropoff_location_id", "DOlocationID", "long"),
        ("@time", None, None),
        ("trip_duration_sec", "trip_duration_sec", "raw"),
        ("trip_duration_min", "trip_duration_min", "raw"),
        ("sr_flag", "SR_Flag", "string"),
    ),
)

VARIANTS = {v.name: v for v in (YELLOW, GREEN, FHVHV, FHV)}


def get_variant(name: str) -> VariantSpec:
    if name not in VARIANTS:
        raise ValueError(f"unknown variant {name!r}; expected one of {sorted(VARIANTS)}")
    return VARIANTS[name]


def base_rules(spec: VariantSpec, max_minutes: float = DEFAULT_MAX_MINUTES) -> list[tuple[str, Column]]:
    """shared null / time-order / duration / location rules."""
    pu, do = F.col(spec.pickup), F.col(spec.dropoff)
    return [
        ("pickup_not_null", pu.isNotNull()),
        ("dropoff_not_null", do.isNotNull()),
        ("dropoff_after_pickup", do > pu),
        ("duration_positive", F.col("trip_duration_min") > 0),
        ("duration_max", F.col("trip_duration_min") <= F.lit(max_minutes)),
        ("pickup_location_not_null", F.col(spec.pu_location).isNotNull()),
        ("dropoff_location_not_null", F.col(spec.do_location).isNotNull()),
    ]


def rules(spec: VariantSpec, max_minutes: float = DEFAULT_MAX_MINUTES) -> list[tuple[str, Column]]:
    """All named rules of a variant (F1 + F2/F3/F4)."""
    return base_rules(spec, max_minutes) + [(n, F.expr(p)) for n, p in spec.extra_rules]


def _present(df: DataFrame, name: str) -> bool:
    return name.lower() in {c.lower() for c in df.columns}


def optional_doubles(df: DataFrame, names) -> dict:
    """Typed-null columns for the optional fees ``df`` lacks (the presence
    test is case-insensitive, like Spark's column resolution)."""
    return {n: F.lit(None).cast("double") for n in names if not _present(df, n)}


def add_optional_doubles(df: DataFrame, names) -> DataFrame:
    """P2 as a DataFrame step."""
    return df.withColumns(optional_doubles(df, names))


def with_features(df: DataFrame, spec: VariantSpec) -> DataFrame:
    """P1 + P2: time features and typed nulls for optional fee columns."""
    feats = time_features(spec.pickup, spec.dropoff)
    return df.withColumns({**optional_doubles(df, spec.optional_doubles), **feats})


def passes(spec: VariantSpec, max_minutes: float = DEFAULT_MAX_MINUTES) -> Column:
    """Conjunction of every rule; a null rule result drops the row (SQL
    three-valued logic, e.g. a null passenger count)."""
    out = None
    for _, r in rules(spec, max_minutes):
        out = r if out is None else (out & r)
    return out


def project(spec: VariantSpec, money_mode: str = "double", load_ts: bool = True) -> list[Column]:
    """P5-P8 + P17: the variant's ordered, typed output projection."""
    out = [F.lit(spec.name).alias("taxi_type")]
    for name, src, kind in spec.columns:
        if name == "@time":
            out += [F.col(c) for c in _TIME_BLOCK]
            continue
        if kind == "long":
            out.append(cast_long(src).alias(name))
        elif kind == "money":
            out.append(money(src, money_mode).alias(name))
        elif kind == "string":
            out.append(F.col(src).cast("string").alias(name))
        else:
            out.append(F.col(src).alias(name))
    if load_ts:
        out.append(F.current_timestamp().alias("created_at"))
    return out


def clean(df: DataFrame, variant: str | VariantSpec = "yellow", money_mode: str = "double",
          max_minutes: float = DEFAULT_MAX_MINUTES, load_ts: bool = True,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw -> Cleaned for one variant (lazy; no counts, no shows).

    ``keep`` carries extra input columns through (for example the
    ``src_year``/``src_month`` load partition).
    """
    spec = variant if isinstance(variant, VariantSpec) else get_variant(variant)
    feat = with_features(df, spec)
    cols = project(spec, money_mode, load_ts) + [F.col(c) for c in keep]
    return feat.where(passes(spec, max_minutes)).select(*cols)


def filter_stats(df: DataFrame, variant: str | VariantSpec = "yellow",
                 max_minutes: float = DEFAULT_MAX_MINUTES) -> DataFrame:
    """initial / kept / dropped / pass-rate in one aggregation pass."""
    spec = variant if isinstance(variant, VariantSpec) else get_variant(variant)
    feat = with_features(df, spec)
    ok = F.coalesce(passes(spec, max_minutes), F.lit(False))
    agg = feat.agg(F.count(F.lit(1)).alias("initial_count"),
                   F.count_if(ok).alias("kept_count"))
    return agg.select(
        "initial_count", "kept_count",
        (F.col("initial_count") - F.col("kept_count")).alias("dropped_count"),
        F.when(F.col("initial_count") > 0,
               F.col("kept_count").cast("double") * 100.0 / F.col("initial_count").cast("double"))
        .otherwise(F.lit(0.0)).alias("pass_rate_pct"))


def reject_reasons(df: DataFrame, variant: str | VariantSpec = "yellow",
                   max_minutes: float = DEFAULT_MAX_MINUTES) -> DataFrame:
    """F8: rows failing each rule (a row failing two rules counts twice).

    One pass: every rule becomes a ``count_if`` of the same aggregate, then
    the single wide row is unpivoted with ``stack``.  A rule whose result is
    null (e.g. ``passenger_count > 0`` on a null) counts as a failure, which
    is what the filter does with it.
    """
    spec = variant if isinstance(variant, VariantSpec) else get_variant(variant)
    feat = with_features(df, spec)
    rs = rules(spec, max_minutes)
    wide = feat.agg(*[F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rs])
    stack = "stack({k}, {pairs}) as (rule, rejected_count)".format(
        k=len(rs), pairs=", ".join(f"'{n}', `{n}`" for n, _ in rs))
    return wide.selectExpr(stack)


def legacy_transform(df: DataFrame, pickup: str = "tpep_pickup_datetime") -> DataFrame:
    """P18 + F5: the legacy single-file job - date parts, a rounded total and
    four positivity filters (no time-order or location rules)."""
    pu = F.col(pickup)
    out = df.withColumns({
        "pickup_date": F.to_date(pu), "pickup_hour": F.hour(pu), "pickup_dayofweek": F.dayofweek(pu),
        "pickup_month": F.month(pu), "pickup_year": F.year(pu),
        "total_amount_rounded": F.round(F.col("total_amount"), 2)})
    return out.where((F.col("passenger_count") > 0) & (F.col("trip_distance") > 0)
                     & (F.col("fare_amount") > 0) & (F.col("total_amount") > 0))
