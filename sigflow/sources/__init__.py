"""Readers: CSV files, message streams, lake tables and the test tables."""

from sigflow.sources.files import read_csv, read_csv_stream
from sigflow.sources.lake import read_lake, write_lake
from sigflow.sources.messages import read_message_stream, read_messages
from sigflow.sources.tables import load_table

__all__ = [
    "load_table",
    "read_csv",
    "read_csv_stream",
    "read_lake",
    "read_message_stream",
    "read_messages",
    "write_lake",
]
