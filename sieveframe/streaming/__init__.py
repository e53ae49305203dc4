"""Operators on Structured Streaming."""

from .streams import HistorySink, UpsertTable, read_stream, run_available

__all__ = ["HistorySink", "UpsertTable", "read_stream", "run_available"]
