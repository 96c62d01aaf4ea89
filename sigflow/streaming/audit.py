"""Continuous ingest audit: the audit's counts are taken while a micro-batch is written.

:func:`observed` attaches the audit's aggregates to a stream; they are computed
in the tasks that write the batch, so nothing is scanned a second time.
:class:`AuditLog` listens to the stream's progress and writes one small JSON
file per (query id, batch) when a batch has been committed. A failed batch
reports no progress and leaves no file; a batch that runs again after a failure
is recorded once.

A driver lost between a commit and its report leaves a batch without a record:
:func:`fill_audit` finds such batches of a lake table and counts them from
their own folders.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from sigflow.operators.quality import audit_counts
from sigflow.schemas import SIGNAL_KEYS
from sigflow.sources.generations import APP, BATCH, batch_folders, put_text, read_batches
from sigflow.streaming.sinks import path_exists

NAME = "ingest_audit"
FILE = "audit.json"


def observed(readings: DataFrame, keys: list[str] | None = None, name: str = NAME) -> DataFrame:
    """``readings`` with the audit's aggregates taken along the way. The write must
    run the batch once: persist it where several writers share it (as
    :func:`sigflow.streaming.sinks.fan_out` does), else rows count for each."""
    return readings.observe(name, *_recorded(keys))


# Recorded in microseconds: reported times come without their fractions of a second.
TIMES = ("min_signal_ts", "max_signal_ts", "create_ts")
DAYS = ("min_signal_date", "max_signal_date")


def _recorded(keys: list[str] | None) -> list[Column]:
    times = [F.unix_micros(f("signal_ts")).alias(n) for f, n in zip((F.min, F.max), TIMES)]
    days = [f("signal_date").cast("string").alias(n) for f, n in zip((F.min, F.max), DAYS)]
    return [*audit_counts(keys), *times, *days, F.unix_micros(F.max("create_ts")).alias("create_ts")]


class AuditLog(StreamingQueryListener):
    """Listener that keeps the audit of every committed batch below ``path``.

    Register it once with ``spark.streams.addListener``; it records all queries
    that carry the named metrics. After a bounded run call :meth:`catch_up`,
    as progress is reported after the query has gone on.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = NAME):
        super().__init__()
        self.spark, self.path, self.name = spark, path, name

    def record(self, app: str, batch: int, metrics: dict) -> None:
        if metrics.get("num_records"):
            folder = f"{self.path}/{APP}={app}/{BATCH}={batch}"
            put_text(self.spark, f"{folder}/{FILE}", json.dumps(metrics), overwrite=True)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (p.observedMetrics or {}).get(self.name)
        if row is not None:
            self.record(str(p.id), p.batchId, row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def catch_up(self, query: StreamingQuery) -> None:
        """Record what a query has reported and the listener may not have heard yet."""
        for p in query.recentProgress:
            row = (p.observedMetrics or {}).get(self.name)
            if row is not None:
                self.record(str(query.id), p.batchId, row.asDict())


def read_audit(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """The recorded audits, one row per (app_id, batch_id): columns as in
    :func:`sigflow.operators.quality.ingest_audit`."""
    counts = ["num_records", "null_signal_ts", "null_signal_date", "null_signals", *(f"null_{k}" for k in keys or SIGNAL_KEYS)]
    types = {**dict.fromkeys([*counts, *TIMES], "long"), **dict.fromkeys(DAYS, "date"), APP: "string", BATCH: "long"}
    recorded = spark.read.schema(", ".join(f"`{c}` {t}" for c, t in types.items())).json(path)
    out = recorded.withColumns({c: F.timestamp_micros(c) for c in TIMES})
    return out.select(APP, BATCH, F.to_date("create_ts").alias("create_date"), "create_ts", *counts, *TIMES[:2], *DAYS)


def fill_audit(spark: SparkSession, lake_path: str, path: str, keys: list[str] | None = None) -> int:
    """Record the batch folders of a lake table that have no audit yet, counted from
    their own rows; returns how many. Run it before a compaction's folders go.
    One row per missing batch reaches the driver; other batches are not read."""
    missing = [
        folder for (app, batch), folder in batch_folders(spark, lake_path).items()
        if not path_exists(spark, f"{path}/{APP}={app}/{BATCH}={batch}/{FILE}")
    ]
    if not missing:
        return 0
    rows = read_batches(spark, lake_path, sorted(missing))
    log = AuditLog(spark, path)
    for row in rows.groupBy(APP, BATCH).agg(*_recorded(keys)).toLocalIterator():
        metrics = row.asDict()
        log.record(metrics.pop(APP), metrics.pop(BATCH), metrics)
    return len(missing)
