"""Structured Streaming: ingest queries, sinks, event-time windows, control."""

from sigflow.streaming.control import run_for, run_to_completion, run_until_stopped, stop_all
from sigflow.streaming.ingest import (
    readings_stream,
    start_consume,
    start_consume_fanout,
    start_consume_generic,
    start_publish_csv,
    start_raw_tap,
)
from sigflow.streaming.sinks import (
    batch_folder_writer,
    fan_out,
    start_console,
    start_foreach_batch,
    start_lake_sink,
    start_publish,
)
from sigflow.streaming.windows import (
    compact_windows,
    dedup_first_stream,
    hourly_means_stream,
    latest_windows,
    untimed,
)

__all__ = [
    "batch_folder_writer", "compact_windows", "dedup_first_stream", "fan_out", "hourly_means_stream", "latest_windows",
    "readings_stream", "run_for", "run_to_completion", "run_until_stopped", "start_console",
    "start_consume", "start_consume_fanout", "start_consume_generic", "start_foreach_batch",
    "start_lake_sink", "start_publish", "start_publish_csv", "start_raw_tap", "stop_all", "untimed",
]
