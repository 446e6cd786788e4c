"""Incremental processing of landed bronze files (Structured Streaming, availableNow)."""

from dailylake.streaming.ingest import bronze_stream, process_new_files

__all__ = ["bronze_stream", "process_new_files"]
