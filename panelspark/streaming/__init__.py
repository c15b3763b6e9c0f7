"""Incremental ingestion with Structured Streaming."""

from panelspark.streaming.landing import land_delimited

__all__ = ["land_delimited"]
