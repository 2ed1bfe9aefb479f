"""Numeric casts, money handling and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, LongType

MONEY_DECIMAL = DecimalType(18, 2)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_double(c, decimals: int = 2) -> Column:
    """Cast to double *then* round, so the physical type is DOUBLE whatever
    the source file used (INT32 in some months, DOUBLE in others)."""
    return F.round(_c(c).cast(DoubleType()), decimals)


def cast_long(c) -> Column:
    """Stable LongType for ids and counts whose encoding drifts by month."""
    return _c(c).cast(LongType())


def to_decimal_money(c) -> Column:
    """Exact money: DECIMAL(18,2).  Decimal sums are order independent, so
    results are identical across partitionings and engines."""
    return _c(c).cast(MONEY_DECIMAL)


def money(c, mode: str = "double") -> Column:
    """Normalise a money/distance column.

    ``mode="double"`` follows the reference layer contract (double rounded to
    2 dp); ``mode="decimal"`` keeps exact DECIMAL(18,2), which makes sums
    independent of the order Spark happens to add rows in.
    """
    if mode == "decimal":
        return to_decimal_money(c)
    if mode == "double":
        return round_double(c, 2)
    raise ValueError(f"unknown money mode {mode!r}")


def guarded_ratio(num, den, decimals: int | None = 2, otherwise=0.0) -> Column:
    """``num / den`` when ``den > 0`` else ``otherwise``.

    The ``when`` guard keeps the division from ever being evaluated on a zero
    denominator, which matters under ANSI mode (on by default in Spark 4).
    Decimal inputs are divided as doubles so the result type is stable.
    """
    n, d = _c(num), _c(den)
    q = n.cast(DoubleType()) / d.cast(DoubleType())
    if decimals is not None:
        q = F.round(q, decimals)
    return F.when(d > 0, q).otherwise(F.lit(otherwise).cast(DoubleType()))
