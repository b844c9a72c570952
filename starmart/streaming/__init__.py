"""Structured Streaming loader of the warehouse."""

from starmart.streaming.loader import BatchReport, WarehouseLoader
from starmart.streaming.pipeline import run_file_sink, run_to_completion, start_loader, stream_static_join

__all__ = ["BatchReport", "WarehouseLoader", "run_file_sink", "run_to_completion", "start_loader",
           "stream_static_join"]
