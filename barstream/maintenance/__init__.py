"""Keeping Parquet datasets healthy: statistics, compaction, retention."""

from .catalog import compact_table, retain_table
from .compact import compact
from .files import file_stats, list_files
from .packing import compact_small
from .retain import retain_since

__all__ = [
    "compact",
    "compact_small",
    "compact_table",
    "file_stats",
    "list_files",
    "retain_since",
    "retain_table",
]
