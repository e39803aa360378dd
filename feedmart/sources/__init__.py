"""Scans and sinks: RSS/XML landing files, the table store, stand-in sources over test tables."""

from feedmart.sources.rss import parse_items, read_landing, write_feeds
from feedmart.sources.store import Store

__all__ = ["parse_items", "read_landing", "write_feeds", "Store"]
