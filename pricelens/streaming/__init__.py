"""Structured Streaming ingest."""

from pricelens.streaming.ingest import stream_clean

__all__ = ["stream_clean"]
