"""Thin adapters from storage and message buses to DataFrames."""

from .history import history_table, live_leaves, read_history
from .records import (
    kafka_options,
    kafka_records,
    record_files,
    table_stream,
    text_messages,
    whole_documents,
)

__all__ = [
    "history_table",
    "kafka_options",
    "kafka_records",
    "live_leaves",
    "read_history",
    "record_files",
    "table_stream",
    "text_messages",
    "whole_documents",
]
