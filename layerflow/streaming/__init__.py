"""Incremental landing of new files with Structured Streaming."""

from layerflow.streaming.landing import land_available, land_stream

__all__ = ["land_available", "land_stream"]
