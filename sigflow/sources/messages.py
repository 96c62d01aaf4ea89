"""Message sources with a ``value`` column.

Two transports give the same shape: Kafka (``value`` binary) and a
directory of message files, one message per line (``value`` string). The
file form is what runs without a broker; everything downstream only uses
``value`` and casts it to string, so both feed the same operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _kafka_reader(reader, bootstrap: str, topic: str, starting_offsets: str,
                  fail_on_data_loss: bool, timeout_ms: int | None):
    reader = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if timeout_ms:
        reader = reader.option("kafka.request.timeout.ms", str(timeout_ms)).option(
            "kafka.session.timeout.ms", str(timeout_ms)
        )
    return reader


def read_message_stream(
    spark: SparkSession,
    path: str | None = None,
    *,
    fmt: str = "text",
    bootstrap: str | None = None,
    topic: str | None = None,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    timeout_ms: int | None = None,
    max_files_per_trigger: int | None = None,
    glob: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Unbounded frame with a ``value`` column.

    ``fmt="kafka"`` needs the Kafka connector on the classpath; ``fmt="text"``
    reads message files under ``path``. ``options`` go to the reader as given,
    e.g. ``{"maxOffsetsPerTrigger": "5000000"}`` to size Kafka micro-batches
    or ``{"maxBytesPerTrigger": "10g"}`` for files.
    """
    if fmt == "kafka":
        reader = _kafka_reader(
            spark.readStream, bootstrap, topic, starting_offsets, fail_on_data_loss, timeout_ms
        )
        return reader.options(**(options or {})).load()
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def read_messages(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """Bounded counterpart of :func:`read_message_stream` for message files."""
    return spark.read.format(fmt).load(path)
