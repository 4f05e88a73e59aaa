"""Structured Streaming variants (availableNow micro-batches, watermarks, dedup)."""

from tessera.streaming.quality_stream import (  # noqa: F401
    hourly_counts, read_table_stream, run_available_now, run_latest_now, silver_events)
