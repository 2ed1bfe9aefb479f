"""Sources and sinks: readers, months, writers, catalog."""

from meterwise.sources.readers import (
    read_source, read_table, month_filter, read_zone_lookup, cast_to_schema,
    union_months, read_months_drift_safe,
)
from meterwise.sources.months import (
    parse_year_month, iter_months, month_range, months_of, month_coverage,
    resolve_months, month_paths,
)
from meterwise.sources.writers import (
    cluster_for_write, write_partitioned, write_table, with_source_month, save_month,
    save_by_data_month, partition_counts, compact, run_log_record, append_run_log,
)

__all__ = [
    "read_source", "read_table", "month_filter", "read_zone_lookup", "cast_to_schema",
    "union_months", "read_months_drift_safe", "parse_year_month", "iter_months",
    "month_range", "months_of", "month_coverage", "resolve_months", "month_paths",
    "cluster_for_write", "write_partitioned", "write_table", "with_source_month",
    "save_month", "save_by_data_month", "partition_counts", "compact",
    "run_log_record", "append_run_log",
]
