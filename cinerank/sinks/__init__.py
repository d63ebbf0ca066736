"""Sinks: full-refresh table writes, the uid/mid access layout, the search-document
export, the keyed per-batch sink used by the stream, and the table of committed versions."""

from cinerank.sinks.tables import (
    compact_keyed,
    export_documents,
    read_keyed_latest,
    write_bucketed,
    write_clustered,
    write_keyed_batch,
    write_layout,
    write_table,
)
from cinerank.sinks.versioned import ConcurrentWrite, VersionedTable

__all__ = [
    "ConcurrentWrite", "VersionedTable", "compact_keyed", "export_documents", "read_keyed_latest", "write_bucketed", "write_clustered", "write_keyed_batch",
    "write_layout", "write_table",
]
