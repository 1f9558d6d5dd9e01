"""Structured Streaming drivers of the incremental per-day usage merge."""

from usagetally.streaming.usage_stream import apply_batch, start_usage_stream

__all__ = ["apply_batch", "start_usage_stream"]
