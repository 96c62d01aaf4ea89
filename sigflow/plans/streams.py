"""Streaming jobs run end to end on the given tables.

Each job lands its input under a fresh folder of the shared checkpoint root
(``spark.checkpoint.dir``) or of a folder the caller names, runs the
streaming queries with an ``availableNow`` trigger (all input, then stop),
removes the legs nobody reads any more and returns the sink's table, so the
result can be compared with a batch computation. Micro-batches are sized by
the number of files a batch takes (``files_per_batch``).
"""

from __future__ import annotations

import math
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigflow.functions.signals import flatten_signals
from sigflow.operators.quality import dedup_latest
from sigflow.operators.shape import pack_messages
from sigflow.plans.analysis import hourly_report
from sigflow.schemas import READINGS_SCHEMA, SIGNAL_KEYS
from sigflow.session import checkpoint_root, drop_folder
from sigflow.sources.generations import compact, drop_covered, read_table
from sigflow.sources.lake import read_lake, write_lake
from sigflow.sources.tables import events_as_raw, events_as_readings, load_table, messages_with_junk, replayed_readings
from sigflow.streaming.arrivals import start_first_arrivals
from sigflow.streaming.audit import AuditLog, fill_audit, observed, read_audit
from sigflow.streaming.control import run_to_completion
from sigflow.streaming.ingest import start_consume, start_consume_fanout, start_consume_split, start_publish_csv
from sigflow.streaming.sinks import batch_folder_writer, start_foreach_batch
from sigflow.streaming.windows import read_hourly, start_hourly_partials

AVAILABLE_NOW = {"availableNow": True}


# Files a micro-batch takes in the registered jobs.
FILES_PER_BATCH = 64
# Files that the jobs over out-of-order readings land, a micro-batch each or two.
LANDED_FILES = 6
# Rows, about, that a file of a replayed feed has; more rows come in more files, in as many micro-batches.
ROWS_A_FILE = 500_000


def run_folder(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A fresh folder for one run, below ``root`` or the shared checkpoint root."""
    return os.path.join(root or checkpoint_root(spark), "sigflow-runs", f"{name}-{uuid.uuid4().hex}")


def drop_legs(spark: SparkSession, base: str, *legs: str) -> None:
    for leg in legs:
        drop_folder(spark, f"{base}/{leg}")


def land_csv(df: DataFrame, path: str) -> None:
    """Write raw readings as CSV files with a header line (the feed's form)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def ingest_events(spark: SparkSession, sf_dir: str, files_per_batch: int = FILES_PER_BATCH, root: str | None = None) -> str:
    """CSV files -> publish stream -> message files -> consume stream -> lake.

    Returns the lake path. Both streams write every batch exactly once, so
    running either again with its checkpoint adds nothing.
    """
    base = run_folder(spark, "ingest", root)
    land_csv(events_as_raw(load_table(spark, sf_dir, "events")), f"{base}/csv")
    run_to_completion(start_publish_csv(
        spark, f"{base}/csv", f"{base}/ck_publish", out_path=f"{base}/messages",
        max_files_per_trigger=files_per_batch, trigger=AVAILABLE_NOW,
    ))
    run_to_completion(start_consume(
        spark, f"{base}/messages", f"{base}/lake", f"{base}/ck_consume",
        max_files_per_trigger=files_per_batch, trigger=AVAILABLE_NOW,
    ))
    drop_legs(spark, base, "csv", "messages", "ck_publish", "ck_consume")
    return f"{base}/lake"


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = read_lake(spark, ingest_events(spark, sf_dir))
    return lake.select("signal_date", "signal_ts", *flatten_signals())


def land_shuffled(readings: DataFrame, path: str, files: int = LANDED_FILES) -> None:
    """Land readings in so many files, each with readings of all days: every
    micro-batch but the first is late against the one before it. One write."""
    readings.repartition(files).write.parquet(path)


def files_for(rows: int) -> int:
    """Files that so many rows are landed in: a multiple of ``LANDED_FILES``, of about ``ROWS_A_FILE`` rows at most."""
    return LANDED_FILES * max(1, math.ceil(rows / (LANDED_FILES * ROWS_A_FILE)))


def land_newest_first(readings: DataFrame, path: str, files: int = LANDED_FILES) -> None:
    """Land readings by time, the newest in the first file: a backfill that goes
    back in time. One range-partitioned write."""
    readings.repartitionByRange(files, F.col("signal_ts").desc()).write.parquet(path)


def readings_files(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    return spark.readStream.schema(READINGS_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def hourly_stream_job(spark: SparkSession, sf_dir: str, files_per_batch: int = 1, root: str | None = None) -> DataFrame:
    """Readings files, newest first -> partial sums per micro-batch -> hourly means.

    Complete however the input is ordered and cut into micro-batches; columns
    window_start, window_end and the means.
    """
    base = run_folder(spark, "hourly", root)
    land_newest_first(events_as_readings(load_table(spark, sf_dir, "events")), f"{base}/readings")
    stream = readings_files(spark, f"{base}/readings", files_per_batch)
    run_to_completion(start_hourly_partials(stream, f"{base}/hourly", f"{base}/ck_hourly", trigger=AVAILABLE_NOW))
    drop_legs(spark, base, "readings", "ck_hourly")
    start = F.col("signal_date").cast("timestamp") + F.make_dt_interval(hours=F.col("hour"))
    return read_hourly(spark, f"{base}/hourly").select(
        start.alias("window_start"), (start + F.make_dt_interval(hours=F.lit(1))).alias("window_end"),
        *[f"avg_{k}" for k in SIGNAL_KEYS],
    )


def q_stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_stream_job(spark, sf_dir)


def land_messages(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Message files as the publish leg writes them, from ``events``."""
    pack_messages(events_as_raw(load_table(spark, sf_dir, "events"))).write.text(path)


def q_stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consume once, restart with the same checkpoint (adds nothing), then
    replay from a new checkpoint (adds everything again); replay removal
    leaves one row per reading."""
    base = run_folder(spark, "replay")
    land_messages(spark, sf_dir, f"{base}/messages")
    for ck in ("ck_first", "ck_first", "ck_replay"):
        run_to_completion(start_consume(
            spark, f"{base}/messages", f"{base}/lake", f"{base}/{ck}",
            trigger=AVAILABLE_NOW, max_files_per_trigger=FILES_PER_BATCH,
        ))
    drop_legs(spark, base, "messages", "ck_first", "ck_replay")
    lake = read_lake(spark, f"{base}/lake").select(*READINGS_SCHEMA.fieldNames())
    return dedup_latest(lake).select("signal_date", "signal_ts", *flatten_signals())


def q_stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read of the messages feeding the raw archive and the shaped table: the rows of both."""
    base = run_folder(spark, "fanout")
    land_messages(spark, sf_dir, f"{base}/messages")
    run_to_completion(start_consume_fanout(
        spark, f"{base}/messages", f"{base}/lake", f"{base}/raw", f"{base}/ck", trigger=AVAILABLE_NOW,
        max_files_per_trigger=FILES_PER_BATCH,
    ))
    drop_legs(spark, base, "messages", "ck")
    raw = spark.read.text(f"{base}/raw").select(F.lit("raw").alias("target"), "value")
    lake = spark.read.parquet(f"{base}/lake").select(
        F.lit("lake").alias("target"), "signal_date", "signal_ts", *flatten_signals())
    return lake.unionByName(raw, allowMissingColumns=True)


def q_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming replay removal: three ingests of the readings in files that mix all
    days, three micro-batches, first arrival kept."""
    base = run_folder(spark, "dedup-first")
    replayed = replayed_readings(load_table(spark, sf_dir, "events"))
    files = files_for(replayed.count())
    land_shuffled(replayed, f"{base}/readings", files)
    stream = readings_files(spark, f"{base}/readings", files // 3)
    run_to_completion(start_first_arrivals(stream, f"{base}/lake", f"{base}/ck", trigger=AVAILABLE_NOW))
    drop_legs(spark, base, "readings", "ck")
    return read_table(spark, f"{base}/lake").select("signal_date", "signal_ts", *flatten_signals())


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with junk among them, split by one stream: the rows of the shaped
    table and of the rejected one, with the reasons."""
    base = run_folder(spark, "quarantine")
    tables = (load_table(spark, sf_dir, t) for t in ("events", "conversations", "labels"))
    messages_with_junk(*tables).write.text(f"{base}/messages")
    run_to_completion(start_consume_split(
        spark, f"{base}/messages", f"{base}/lake", f"{base}/rejected", f"{base}/ck", trigger=AVAILABLE_NOW,
        max_files_per_trigger=FILES_PER_BATCH,
    ))
    drop_legs(spark, base, "messages", "ck")
    lake = read_table(spark, f"{base}/lake").select(
        F.lit("lake").alias("target"), "signal_date", "signal_ts", *flatten_signals())
    junk = read_table(spark, f"{base}/rejected").select(F.lit("rejected").alias("target"), "value", "reason")
    return lake.unionByName(junk, allowMissingColumns=True)


def _landed(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """Stream over the readings, landed in files that mix all days, a file a batch."""
    land_shuffled(events_as_readings(load_table(spark, sf_dir, "events")), f"{base}/readings")
    return readings_files(spark, f"{base}/readings", 1)


def q_stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits that the batches of a stream recorded while they were written, added up."""
    base = run_folder(spark, "audit")
    log = AuditLog(spark, f"{base}/audit")
    query = start_foreach_batch(
        observed(_landed(spark, sf_dir, base)), batch_folder_writer(f"{base}/lake"), f"{base}/ck", trigger=AVAILABLE_NOW
    )
    run_to_completion(query)
    log.catch_up(query)
    fill_audit(spark, f"{base}/lake", f"{base}/audit")
    drop_legs(spark, base, "readings", "ck", "lake")
    audit = read_audit(spark, f"{base}/audit")
    counts = [c for c in audit.columns if c.startswith(("num_", "null_"))]
    return audit.agg(
        *[F.sum(c).alias(c) for c in counts],
        *[f(c).alias(c) for f, x in ((F.min, "min"), (F.max, "max")) for c in (f"{x}_signal_ts", f"{x}_signal_date")],
    )


def q_lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings streamed in several batches, then compacted into day partitions, the
    batch folders removed: every row is still there."""
    base = run_folder(spark, "compacted")
    run_to_completion(start_foreach_batch(
        _landed(spark, sf_dir, base), batch_folder_writer(f"{base}/lake"), f"{base}/ck", trigger=AVAILABLE_NOW))
    compact(spark, f"{base}/lake")
    drop_covered(spark, f"{base}/lake")
    drop_legs(spark, base, "readings", "ck")
    return read_table(spark, f"{base}/lake").select("signal_date", "signal_ts", *flatten_signals())


# The lake is read as it was after the readings up to this day had come.
AS_OF_DAY = "2024-01-15"


def q_lake_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingests by one query, days up to ``AS_OF_DAY`` first, then compacted; the
    table as of the first ingest."""
    base = run_folder(spark, "as-of")
    readings = events_as_readings(load_table(spark, sf_dir, "events"))
    early = F.coalesce(F.col("signal_date") <= F.lit(AS_OF_DAY).cast("date"), F.lit(False))
    for part in (early, ~early):
        readings.filter(part).write.mode("append").parquet(f"{base}/readings")
        run_to_completion(start_foreach_batch(
            readings_files(spark, f"{base}/readings", FILES_PER_BATCH), batch_folder_writer(f"{base}/lake"),
            f"{base}/ck", trigger=AVAILABLE_NOW))
    compact(spark, f"{base}/lake", ended=True)
    drop_legs(spark, base, "readings", "ck")
    return read_table(spark, f"{base}/lake", up_to=0).select("signal_date", "signal_ts", *flatten_signals())


def q_save_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly report saved with overwrite (twice: a rerun replaces), read back."""
    base = run_folder(spark, "processed")
    report = hourly_report(events_as_readings(load_table(spark, sf_dir, "events")))
    write_lake(report, f"{base}/report")
    write_lake(report, f"{base}/report")
    return read_lake(spark, f"{base}/report")
