"""Streaming sinks.

* per-batch writers for ``foreachBatch``: each batch goes to its own
  ``app_id=Q/batch_id=N`` folder with overwrite, Q being the streaming
  query's id, which lives in its checkpoint. Re-running a batch after a
  failure replaces its output; a run from a new or emptied checkpoint has a
  new id and writes beside the old one, so nothing is lost or overwritten.
* lake sink: append to a path-based table (parquet by default, delta when
  installed). The file sink commits each micro-batch once, recording it in
  the table's metadata log, so a restart with the same checkpoint never
  writes a batch twice. That log is keyed on the batch number alone, so a
  new checkpoint's first batches would be skipped as already written;
  starting one into an existing table is refused. Delta keys commits on
  (query, version) and needs no such care.
* publish sink: messages (``value`` column) to Kafka or to message files.
* console taps for inspection, bounded to a few rows per batch.
* fan-out: one source read, several writers, via ``foreachBatch`` with the
  batch persisted once.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sigflow.streaming.control import with_trigger

BatchWriter = Callable[[DataFrame, int], None]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def start_lake_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append to the table at ``path``. Raises ``ValueError`` if a new
    checkpoint meets a table that another query has written: the file sink
    would drop its first batches without a word."""
    spark = df.sparkSession
    if fmt != "delta" and path_exists(spark, f"{path}/_spark_metadata") and not path_exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(
            f"{path} was written from another checkpoint; a new one needs a new table, or the per-batch sink"
        )
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return with_trigger(writer, trigger).start(path)


def start_publish(
    messages: DataFrame,
    checkpoint: str,
    *,
    path: str | None = None,
    fmt: str = "text",
    bootstrap: str | None = None,
    topic: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Publish the ``value`` column: ``fmt="kafka"`` to a topic (connector
    needed), ``fmt="text"`` as message files, one message per line."""
    writer = messages.select("value").writeStream.outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    if fmt == "kafka":
        writer = (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("topic", topic)
        )
        return with_trigger(writer, trigger).start()
    return with_trigger(writer.format(fmt), trigger).start(path)


def start_console(
    df: DataFrame, num_rows: int = 20, checkpoint: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Inspection tap: prints at most ``num_rows`` rows per micro-batch."""
    writer = (
        df.writeStream.format("console")
        .outputMode("append")
        .option("numRows", num_rows)
        .option("truncate", False)
    )
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()


def query_id(batch: DataFrame) -> str | None:
    """Id of the streaming query a micro-batch belongs to; None outside of one.

    The id is stored in the query's checkpoint: a restart keeps it, a new or
    emptied checkpoint gets another one.
    """
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def batch_folder_writer(
    path: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> BatchWriter:
    """Write each micro-batch to ``path/app_id=Q/batch_id=N`` with overwrite,
    Q being the streaming query's id (left out when called outside of one).

    A retried batch replaces its own folder (idempotent). A run from another
    checkpoint writes beside it: a replay is kept, as a transactional table
    keyed on (application, version) would keep it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        app = query_id(batch)
        base = os.path.join(path, f"app_id={app}") if app else path
        w = batch.write.mode("overwrite").format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(os.path.join(base, f"batch_id={batch_id}"))

    return write


def fan_out(writers: list[BatchWriter]) -> BatchWriter:
    """One micro-batch to several writers; the batch is computed once and
    kept (memory, spilling to disk) while the writers run."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for w in writers:
                w(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def start_foreach_batch(
    df: DataFrame,
    writer: BatchWriter,
    checkpoint: str,
    output_mode: str = "append",
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    w = (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(writer)
    )
    if query_name:
        w = w.queryName(query_name)
    return with_trigger(w, trigger).start()
