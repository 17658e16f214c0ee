"""Readers; every one has an explicit schema, so none infers."""

from .history import read_assets, read_history, read_pages, read_symbols, split_history
from .messages import read_messages, read_messages_stream
from .ticks import latest_ticks, read_ticks, read_ticks_stream

__all__ = [
    "latest_ticks",
    "read_assets",
    "read_history",
    "read_messages",
    "read_messages_stream",
    "read_pages",
    "read_symbols",
    "read_ticks",
    "read_ticks_stream",
    "split_history",
]
