"""Structured Streaming entry points (incremental versions of batch operators)."""
from .ingest import stream_wide_ingest, wide_schema  # noqa: F401
