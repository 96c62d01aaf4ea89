"""Replay removal and ingest audits for the readings table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigflow.functions.signals import signal_value
from sigflow.schemas import SIGNAL_KEYS


# Columns that describe an ingest rather than a reading.
AUDIT_COLUMNS = ("create_date", "create_ts", "app_id", "batch_id")


def dedup_latest(readings: DataFrame, audit_cols: tuple[str, ...] = AUDIT_COLUMNS) -> DataFrame:
    """Keep the latest ingest of every reading.

    A reading is identified by all its non-audit columns (time, date, signals
    and any typed copies); among its copies the one with the greatest
    ``create_ts`` is kept, with that copy's audit columns (on ties the copy
    whose other audit columns sort last). This is a grouped
    aggregate, not a window: each task first reduces its own copies to one
    row, so a key with a huge number of replays never lands whole in one
    task. Rows without ``signal_ts`` have no identity and pass through
    unchanged (they are counted by :func:`ingest_audit`).
    """
    audit = [c for c in readings.columns if c in audit_cols]
    keys = [c for c in readings.columns if c not in audit]
    keyed = readings.filter(F.col("signal_ts").isNotNull())
    # one struct per copy, the ingest time first: all audit columns come from the same copy
    copy = F.struct("create_ts", *[c for c in audit if c != "create_ts"])
    latest = keyed.groupBy(*keys).agg(F.max(copy).alias("_latest"))
    columns = [F.col(f"_latest.{c}").alias(c) if c in audit else F.col(c) for c in readings.columns]
    untimed = readings.filter(F.col("signal_ts").isNull())
    return latest.select(*columns).unionByName(untimed)


def audit_counts(keys: list[str] | None = None) -> list[Column]:
    """Aggregates: rows, and null counts of the times, the signals map and each signal value."""
    return [
        F.count(F.lit(1)).alias("num_records"),
        F.count_if(F.col("signal_ts").isNull()).alias("null_signal_ts"),
        F.count_if(F.col("signal_date").isNull()).alias("null_signal_date"),
        F.count_if(F.col("signals").isNull()).alias("null_signals"),
        *[F.count_if(signal_value(k).isNull()).alias(f"null_{k}") for k in keys or SIGNAL_KEYS],
    ]


def ingest_audit(readings: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per ingest batch (``create_ts``): rows, time bounds and null counts (of
    the times, the signals map and each signal value)."""
    return readings.groupBy("create_date", "create_ts").agg(
        *audit_counts(keys),
        F.min("signal_ts").alias("min_signal_ts"),
        F.max("signal_ts").alias("max_signal_ts"),
        F.min("signal_date").alias("min_signal_date"),
        F.max("signal_date").alias("max_signal_date"),
    )
