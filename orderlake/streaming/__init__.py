"""Incremental ingest of daily report drops (R1) and duplicate suppression (R2)."""

from orderlake.streaming.ingest import (  # noqa: F401
    compact_epochs, current_table, ingest_stream, suppress_duplicates, upsert_batch)
