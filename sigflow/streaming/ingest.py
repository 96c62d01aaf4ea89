"""The two ingest legs as streaming queries.

publish: CSV directory -> one JSON message per row -> Kafka topic or message files
consume: messages -> parsed and shaped readings -> lake table (+ optional taps)

Shaping is :func:`sigflow.operators.shape.messages_to_readings`, the same
function the batch path uses; ``create_ts`` is ``current_timestamp()``,
fixed once per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sigflow.operators.shape import (
    accepted,
    flatten_messages,
    judge_messages,
    messages_to_readings,
    pack_messages,
    rejected,
    with_typed_signals,
)
from sigflow.schemas import GENERIC_MESSAGE_SCHEMA
from sigflow.sources.files import read_csv_stream
from sigflow.sources.messages import read_message_stream
from sigflow.streaming.sinks import (
    batch_folder_writer,
    fan_out,
    start_console,
    start_foreach_batch,
    start_lake_sink,
    start_publish,
)


def start_publish_csv(
    spark: SparkSession,
    csv_dir: str,
    checkpoint: str,
    *,
    out_path: str | None = None,
    fmt: str = "text",
    bootstrap: str | None = None,
    topic: str | None = None,
    glob: str | None = "*.csv",
    max_files_per_trigger: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Publish every CSV row as a JSON message (null fields left out)."""
    raw = read_csv_stream(spark, csv_dir, glob=glob, max_files_per_trigger=max_files_per_trigger)
    return start_publish(
        pack_messages(raw), checkpoint, path=out_path, fmt=fmt,
        bootstrap=bootstrap, topic=topic, trigger=trigger,
    )


def readings_stream(
    spark: SparkSession,
    source: str | None = None,
    *,
    fmt: str = "text",
    strict: bool = False,
    **source_options,
) -> DataFrame:
    """Unbounded readings from a message source (files or Kafka)."""
    messages = read_message_stream(spark, source, fmt=fmt, **source_options)
    return messages_to_readings(messages, strict=strict)


def start_consume(
    spark: SparkSession,
    source: str | None,
    lake_path: str,
    checkpoint: str,
    *,
    fmt: str = "text",
    lake_format: str = "parquet",
    partition_by: list[str] | None = None,
    trigger: dict | None = None,
    strict: bool = False,
    sink: str = "batches",
    typed_casts: tuple[str, ...] | None = None,
    **source_options,
) -> StreamingQuery:
    """Messages -> readings -> lake table (append, exactly once per batch).

    ``sink="batches"`` writes one folder per (query id, batch) with overwrite,
    so retries are idempotent and a run from a new or emptied checkpoint is
    kept as a replay; read it with :func:`sigflow.sources.lake.read_lake`
    (extra ``app_id``/``batch_id`` columns come from the folder names).
    ``sink="table"`` uses the table format's streaming sink, which takes one
    checkpoint per table. ``typed_casts`` (e.g.
    ``("float", "double")``) also writes typed copies of the signals.
    """
    readings = readings_stream(spark, source, fmt=fmt, strict=strict, **source_options)
    if typed_casts:
        readings = with_typed_signals(readings, typed_casts)
    if sink == "batches":
        writer = batch_folder_writer(lake_path, fmt=lake_format, partition_by=partition_by)
        return start_foreach_batch(readings, writer, checkpoint, trigger=trigger)
    return start_lake_sink(
        readings, lake_path, checkpoint, fmt=lake_format,
        partition_by=partition_by, trigger=trigger,
    )


def start_raw_tap(
    spark: SparkSession, source: str | None = None, *, fmt: str = "text", num_rows: int = 20,
    trigger: dict | None = None, **source_options,
) -> StreamingQuery:
    """Console tap on the messages as they arrive, before any shaping."""
    messages = read_message_stream(spark, source, fmt=fmt, **source_options)
    return start_console(messages.selectExpr("CAST(value AS STRING) AS value"), num_rows=num_rows, trigger=trigger)


def start_consume_generic(
    spark: SparkSession,
    source: str | None,
    lake_path: str,
    checkpoint: str,
    *,
    schema: StructType = GENERIC_MESSAGE_SCHEMA,
    fmt: str = "text",
    lake_format: str = "parquet",
    trigger: dict | None = None,
    **source_options,
) -> StreamingQuery:
    """Simple messages (``{"id": ..., "value": ...}`` by default) flattened to
    columns and added to a lake table, one folder per (query id, batch)."""
    messages = read_message_stream(spark, source, fmt=fmt, **source_options)
    writer = batch_folder_writer(lake_path, fmt=lake_format)
    return start_foreach_batch(flatten_messages(messages, schema), writer, checkpoint, trigger=trigger)


def start_consume_fanout(
    spark: SparkSession,
    source: str | None,
    lake_path: str,
    raw_path: str,
    checkpoint: str,
    *,
    fmt: str = "text",
    trigger: dict | None = None,
    **source_options,
) -> StreamingQuery:
    """One read of the source feeding both the raw-message archive and the
    shaped lake table, each batch written once per (query id, target)."""
    messages = read_message_stream(spark, source, fmt=fmt, **source_options)

    def shaped(batch, batch_id):
        batch_folder_writer(lake_path)(messages_to_readings(batch), batch_id)

    def raw(batch, batch_id):
        batch_folder_writer(raw_path, fmt="text")(batch.selectExpr("CAST(value AS STRING) AS value"), batch_id)

    return start_foreach_batch(messages, fan_out([raw, shaped]), checkpoint, trigger=trigger)


def start_consume_split(
    spark: SparkSession,
    source: str | None,
    lake_path: str,
    rejected_path: str,
    checkpoint: str,
    *,
    raw_path: str | None = None,
    fmt: str = "text",
    lake_format: str = "parquet",
    partition_by: list[str] | None = None,
    trigger: dict | None = None,
    typed_casts: tuple[str, ...] | None = None,
    **source_options,
) -> StreamingQuery:
    """Messages split into the shaped lake table and a table of rejected ones.

    A message whose reading has a time goes to ``lake_path``, any other with its
    text and the reason to ``rejected_path`` (and, with ``raw_path``, all of them
    to the raw archive too): every message is in exactly one of the two. Each
    message is read and parsed once; each target has a folder per (query id,
    batch), so a retried batch replaces what it wrote to either.
    """
    judged = judge_messages(read_message_stream(spark, source, fmt=fmt, **source_options))
    into_lake = batch_folder_writer(lake_path, fmt=lake_format, partition_by=partition_by)
    into_rejected = batch_folder_writer(rejected_path, fmt=lake_format)

    def lake(batch, batch_id):
        readings = accepted(batch)
        into_lake(with_typed_signals(readings, typed_casts) if typed_casts else readings, batch_id)

    def junk(batch, batch_id):
        into_rejected(rejected(batch), batch_id)

    def raw(batch, batch_id):
        batch_folder_writer(raw_path, fmt="text")(batch.filter("value IS NOT NULL").select("value"), batch_id)

    writers = [lake, junk] + ([raw] if raw_path else [])
    return start_foreach_batch(judged, fan_out(writers), checkpoint, trigger=trigger)
