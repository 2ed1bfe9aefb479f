"""Column-expression helpers (all JVM-side, codegen friendly)."""

from meterwise.functions.numeric import (
    cast_long, money, round_double, guarded_ratio, to_decimal_money, MONEY_DECIMAL,
)
from meterwise.functions.time import time_features, duration_seconds, year_month_label

__all__ = [
    "cast_long", "money", "round_double", "guarded_ratio", "to_decimal_money",
    "MONEY_DECIMAL", "time_features", "duration_seconds", "year_month_label",
]
