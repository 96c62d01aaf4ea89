"""Event-time hourly means as a stream, and streaming replay removal.

Two forms of the means:

* partials (:func:`start_hourly_partials`): every micro-batch writes the sum and
  the count of each signal per hour, and reading adds them up. No watermark
  decides: files may come in any order, nothing is late, the means and the group
  of readings without a time are those of the batch report. There is no state
  to lose or to grow.
* windows (:func:`hourly_means_stream`): means per 1-hour event-time window with
  a watermark, for feeds whose disorder is known and whose readers want each
  window once, final. Rows older than the watermark are dropped as late, and a
  window's state is released once the watermark passes its end.

Output modes of the second form: ``update`` emits a window every time it
changes, so its last emission is the final value (use :func:`latest_windows` on
the written batches); ``append`` emits each window once, final, after the
watermark passes it, so the newest window waits for later data. For a stream
that runs indefinitely prefer ``append`` into a lake table: update-mode batch
folders grow with every micro-batch, so they suit bounded runs
(``availableNow``), or should be compacted now and then with
:func:`compact_windows`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigflow.functions.signals import signal_number
from sigflow.operators.aggregate import date_and_hour
from sigflow.schemas import SIGNAL_KEYS
from sigflow.sources.generations import read_table
from sigflow.streaming.sinks import batch_folder_writer, start_foreach_batch

_AVG_COLS = [f"avg_{k}" for k in SIGNAL_KEYS]


def untimed(readings: DataFrame) -> DataFrame:
    """Readings without an event time: they belong to no window, so a stream
    that must account for every row writes or counts them beside the means."""
    return readings.filter(F.col("signal_ts").isNull())


def hourly_means_stream(
    readings: DataFrame, watermark: str = "1 hour", cast: str = "double",
    keys: list[str] | None = None,
) -> DataFrame:
    """Means per hour of event time. The batch report has a group for readings
    without a time; here they are in no window (see :func:`untimed`)."""
    keys = keys or SIGNAL_KEYS
    cols = readings.columns
    w = F.window("signal_ts", "1 hour")
    return (
        readings.withWatermark("signal_ts", watermark)
        .groupBy(w.alias("window"))
        .agg(*[F.avg(signal_number(cols, k, cast)).alias(f"avg_{k}") for k in keys])
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *[f"avg_{k}" for k in keys],
        )
    )


def latest_windows(batches: DataFrame, value_cols: list[str] | None = None) -> DataFrame:
    """Final value per window from update-mode batches (``batch_id`` column):
    the row of the greatest batch id wins. A grouped aggregate, so it is
    reduced per task before the shuffle."""
    value_cols = value_cols or _AVG_COLS
    latest = F.max_by(F.struct(*value_cols), "batch_id").alias("v")
    return batches.groupBy("window_start", "window_end").agg(latest).select(
        "window_start", "window_end", *[F.col(f"v.{c}").alias(c) for c in value_cols]
    )


def compact_windows(spark, batches_path: str, out_path: str, fmt: str = "parquet") -> None:
    """Write the final value of every window in update-mode batch folders as
    one table (overwrite), so readers need not scan every micro-batch."""
    from sigflow.sources.lake import write_lake

    write_lake(latest_windows(spark.read.format(fmt).load(batches_path)), out_path, fmt=fmt)


def hourly_partials(
    readings: DataFrame, cast: str = "double", keys: list[str] | None = None, zone: str | None = None
) -> DataFrame:
    """Sum and count of each signal per (signal_date, hour): what
    :func:`merge_partials` needs of some of the readings to give the means of
    all. Grouped as the batch report, readings without a time included."""
    keys = keys or SIGNAL_KEYS
    date, hour = date_and_hour(zone)
    columns = []
    for k in keys:
        value = signal_number(readings.columns, k, cast)
        columns += [F.sum(value).alias(f"sum_{k}"), F.count(value).alias(f"n_{k}")]
    return readings.groupBy(date.alias("signal_date"), hour.alias("hour")).agg(*columns)


def merge_partials(partials: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Hourly means from any number of partials per hour, columns as in
    :func:`sigflow.operators.aggregate.avg_signals_hourly`."""
    keys = keys or SIGNAL_KEYS
    columns = []
    for k in keys:
        n = F.sum(f"n_{k}")
        columns.append(F.when(n > 0, F.sum(f"sum_{k}") / n).alias(f"avg_{k}"))
    return partials.groupBy("signal_date", "hour").agg(*columns)


def start_hourly_partials(
    readings: DataFrame, path: str, checkpoint: str, cast: str = "double", keys: list[str] | None = None,
    zone: str | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Stream the partials of every micro-batch into the table at ``path``, a folder
    per (query id, batch) that a retry overwrites: each reading counts once."""
    into = batch_folder_writer(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        into(hourly_partials(batch, cast, keys, zone), batch_id)

    return start_foreach_batch(readings, write, checkpoint, trigger=trigger)


def read_hourly(spark, path: str, keys: list[str] | None = None, up_to: int | dict[str, int] | None = None) -> DataFrame | None:
    """Hourly means of everything streamed into ``path`` so far (or up to a batch)."""
    partials = read_table(spark, path, up_to=up_to)
    return None if partials is None else merge_partials(partials, keys)


def dedup_first_stream(readings: DataFrame, watermark: str | None = None) -> DataFrame:
    """Streaming replay removal in keyed state: the first arrival of each reading
    is kept. State holds every distinct reading, so for long streams compare with
    the written table instead (:mod:`sigflow.streaming.arrivals`). A ``watermark``
    bounds the state and with it the disorder that is allowed: readings older
    than it are dropped, *first arrivals included*. Maps cannot be keys, so the
    signals are keyed by their JSON text. Readings without a time have no
    identity and pass through, as in the batch form."""
    timed = readings.filter(F.col("signal_ts").isNotNull()).withColumn("_signals_key", F.to_json("signals"))
    keys = ["signal_ts", "_signals_key"]
    if watermark:
        first = timed.withWatermark("signal_ts", watermark).dropDuplicatesWithinWatermark(keys)
    else:
        first = timed.dropDuplicates(keys)
    return first.drop("_signals_key").unionByName(untimed(readings))
