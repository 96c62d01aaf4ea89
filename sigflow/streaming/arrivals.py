"""Replay removal on a stream: every reading's first arrival is kept, however late it comes.

Each micro-batch is compared with the table it is added to: rows whose reading
has arrived before, in any batch of any query, are left out. Nothing depends on
a watermark, so files may come in any order and batches may be cut anywhere;
the table ends up with exactly the distinct readings. Only the days that a
batch holds are read, and of them the time and a digest of the reading.

The comparison leaves out the batch's own folder: a batch that is written again
after a failure meets the same rows as the first time.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import MapType, TimestampType

from sigflow.operators.quality import AUDIT_COLUMNS
from sigflow.session import conf_override
from sigflow.sources.generations import APP, BATCH, read_table
from sigflow.streaming.sinks import BatchWriter, batch_folder_writer, query_id, start_foreach_batch
from sigflow.streaming.windows import untimed

KEY = "reading_key"
# A batch over more days is compared with the whole table, not day by day.
MOST_DAYS = 1_000
# Rows, about, that one task sorts to reduce replays; a batch with larger partitions is dealt out anew.
ROWS_A_TASK = 250_000


def reading_key(readings: DataFrame) -> Column:
    """128-bit digest of what identifies a reading: all columns but those of the
    ingest. Maps with equal entries are equal whatever the order of the entries."""

    def plain(f) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, MapType):
            return F.array_sort(F.map_entries(c)).alias(f.name)
        return (F.unix_micros(c) if isinstance(f.dataType, TimestampType) else c).alias(f.name)

    fields = [f for f in readings.schema.fields if f.name not in (*AUDIT_COLUMNS, KEY)]
    text = F.to_json(F.struct(*[plain(f) for f in fields]), {"ignoreNullFields": "false"})
    return F.substring(F.sha2(text, 256), 1, 32)


def distinct_readings(readings: DataFrame) -> DataFrame:
    """One row per timed reading, its earliest ingest, with its ``reading_key``. A
    grouped aggregate: a reading replayed millions of times costs a row per task."""
    keyed = readings.filter(F.col("signal_ts").isNotNull()).withColumn(KEY, reading_key(readings))
    audit = [c for c in ("create_ts", *AUDIT_COLUMNS) if c in readings.columns]
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in keyed.columns]), F.struct(*dict.fromkeys(audit)) if audit else F.col(KEY))
    return keyed.groupBy("signal_ts", KEY).agg(first.alias("_first")).select("_first.*")


def row_counts(batch: DataFrame) -> tuple[int, int]:
    """Rows of a kept (persisted) batch, and of its largest partition."""
    counts = batch.groupBy(F.spark_partition_id().alias("p")).count().agg(F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    return counts.rows or 0, counts.most or 0


def spread(batch: DataFrame, rows: int, most: int) -> DataFrame:
    """A batch in partitions of about ``ROWS_A_TASK`` rows, however few files or row
    groups it came in; ``rows`` and ``most`` are its :func:`row_counts`. Rows go by
    their reading and the partition they came in: whatever the order in which they
    are read they go the same way, the copies of a reading that came together stay
    together, and a reading with very many copies makes no partition larger than
    those it came in."""
    if most <= ROWS_A_TASK:
        return batch
    fields = [f for f in batch.schema.fields if f.name not in AUDIT_COLUMNS]
    plain = [F.map_entries(F.col(f"`{f.name}`")) if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`") for f in fields]
    return batch.repartition(math.ceil(rows / ROWS_A_TASK), F.xxhash64(F.spark_partition_id(), *plain))


def first_arrivals_writer(path: str, partition_by: list[str] | None = None) -> BatchWriter:
    """Adds a micro-batch's new readings to the table at ``path``, one folder per
    (query id, batch). Readings without a time have no identity and are all kept."""
    into = batch_folder_writer(path, partition_by=partition_by)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows, most = row_counts(batch)
            # a large batch needs more shuffle partitions than the session may name; small ones are merged by AQE
            width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS_A_TASK))
            with conf_override(spark, {"spark.sql.shuffle.partitions": str(width)}):
                new = distinct_readings(spread(batch, rows, most))
                table = read_table(spark, path)
                if table is not None:
                    own = (F.col(APP) == F.lit(query_id(batch))) & (F.col(BATCH) == batch_id)
                    days = batch.filter("signal_ts IS NOT NULL").select("signal_date").distinct().limit(MOST_DAYS + 1).collect()
                    written = table.filter(~F.coalesce(own, F.lit(False)))
                    if len(days) <= MOST_DAYS:
                        known = [d.signal_date for d in days if d.signal_date is not None]
                        on_day = F.col("signal_date").isin(known)
                        written = written.filter(on_day if len(known) == len(days) else on_day | F.col("signal_date").isNull())
                    new = new.join(written.select("signal_ts", KEY), ["signal_ts", KEY], "left_anti")
                rest = untimed(batch).withColumn(KEY, F.lit(None).cast("string"))
                into(new.select(*batch.columns, KEY).unionByName(rest), batch_id)
        finally:
            batch.unpersist()

    return write


def start_first_arrivals(
    readings: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
    trigger: dict | None = None, query_name: str | None = None,
) -> StreamingQuery:
    """Stream ``readings`` into the table at ``path``, each reading once; read it with
    :func:`sigflow.sources.generations.read_table`. One query at a time writes a
    table: two at once could each add a reading that the other has just added."""
    return start_foreach_batch(
        readings, first_arrivals_writer(path, partition_by), checkpoint, trigger=trigger, query_name=query_name
    )
