"""Catalog registration of layer tables.

External tables over the layer folders; new months are registered with
``ALTER TABLE ... ADD IF NOT EXISTS PARTITION ... LOCATION`` (cheap, one
partition) rather than ``MSCK REPAIR`` (lists the whole table).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _ident(name: str) -> str:
    if not all(part.replace("_", "").isalnum() for part in name.split(".")):
        raise ValueError(f"bad identifier {name!r}")
    return name


def register_table(spark: SparkSession, name: str, path: str, schema_ddl: str,
                   partition_cols: Iterable[str] = ("year", "month")) -> None:
    """Create (if absent) an external Parquet table partitioned by ``partition_cols``.

    ``schema_ddl`` lists data and partition columns, e.g.
    ``"trip_id STRING, fare_amount DOUBLE, year INT, month INT"``.
    """
    parts = ", ".join(_ident(c) for c in partition_cols)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ident(name)} ({schema_ddl}) USING parquet "
              f"PARTITIONED BY ({parts}) LOCATION '{path}'")


def add_month_partition(spark: SparkSession, name: str, path: str, year: int, month: int,
                        year_col: str = "year", month_col: str = "month") -> None:
    """Register one month's folder (Spark's own unpadded naming)."""
    loc = f"{path.rstrip('/')}/{year_col}={int(year)}/{month_col}={int(month)}"
    spark.sql(f"ALTER TABLE {_ident(name)} ADD IF NOT EXISTS PARTITION "
              f"({year_col}={int(year)}, {month_col}={int(month)}) LOCATION '{loc}'")


def switch_partition(spark: SparkSession, name: str, year: int, month: int, location: str,
                     year_col: str = "year", month_col: str = "month") -> None:
    """Point one month of a registered table to another folder: readers of the
    table see the old rows until this statement and the new ones after it."""
    if "'" in location:
        raise ValueError(f"bad location {location!r}")
    spark.sql(f"ALTER TABLE {_ident(name)} PARTITION ({year_col}={int(year)}, {month_col}={int(month)}) "
              f"SET LOCATION '{location}'")


def repair(spark: SparkSession, name: str) -> None:
    """Full partition discovery (expensive: lists every folder)."""
    spark.sql(f"MSCK REPAIR TABLE {_ident(name)}")
