"""Writing ORC tables."""

from cardlake.sinks.orc import (
    append,
    append_partitions,
    laid_out,
    overwrite,
    overwrite_bucketed,
    ranged,
    replace_partitions,
    replace_whole,
    write_ranged,
)

__all__ = [
    "append",
    "append_partitions",
    "laid_out",
    "overwrite",
    "overwrite_bucketed",
    "ranged",
    "replace_partitions",
    "replace_whole",
    "write_ranged",
]
