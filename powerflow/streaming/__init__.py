"""Structured Streaming ingest."""

from powerflow.streaming.ingest import (
    run_available,
    stream_enrich_guard,
    stream_ingest,
    stream_settled,
)

__all__ = ["run_available", "stream_enrich_guard", "stream_ingest", "stream_settled"]
