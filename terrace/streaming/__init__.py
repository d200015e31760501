"""Structured Streaming entry points."""

from terrace.streaming.ingest import stream_ingest  # noqa: F401
from terrace.streaming.silver import stream_silver  # noqa: F401
