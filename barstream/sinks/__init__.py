"""Writers, for batches and for streams."""

from .archive import read_archive, write_archive
from .console import write_console
from .files import write_history, write_symbols
from .lake import ctas, insert_partitions, load_ticks, write_fanned_out, write_raw
from .messages import write_messages

__all__ = [
    "ctas",
    "insert_partitions",
    "load_ticks",
    "read_archive",
    "write_archive",
    "write_console",
    "write_fanned_out",
    "write_history",
    "write_messages",
    "write_raw",
    "write_symbols",
]
