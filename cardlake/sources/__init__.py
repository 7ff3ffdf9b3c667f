"""Reading tables and slices of tables."""

from cardlake.sources.tables import (
    day_slice,
    read_table,
    run_day,
    table_exists,
    table_files,
    ymd_days,
    ymd_partition,
)

__all__ = [
    "day_slice",
    "read_table",
    "run_day",
    "table_exists",
    "table_files",
    "ymd_days",
    "ymd_partition",
]
