"""Streaming: junk input, restarts, replays, late data, fan-out, control."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from sigflow.operators.quality import dedup_latest
from sigflow.operators.shape import messages_to_readings
from sigflow.schemas import READINGS_SCHEMA
from sigflow.sources.files import read_csv
from sigflow.sources.lake import read_lake
from sigflow.sources.messages import read_messages
from sigflow.streaming.control import run_for, run_to_completion
from sigflow.session import drop_folder, stream_checkpoint
from sigflow.streaming.ingest import start_consume, start_consume_fanout, start_publish_csv, start_raw_tap
from sigflow.streaming.sinks import (
    batch_folder_writer,
    start_console,
    start_foreach_batch,
    start_lake_sink,
)
from sigflow.streaming.windows import dedup_first_stream, hourly_means_stream, latest_windows, untimed

NOW = {"availableNow": True}
HEADER = "Date/Time,LV ActivePower (kW),Wind Speed (m/s),Theoretical_Power_Curve (KWh),Wind Direction (°)"


def _clean_csv(days=3):
    lines = [HEADER]
    base = dt.datetime(2018, 1, 1)
    for i in range(days * 144):
        t = base + dt.timedelta(minutes=10 * i)
        lines.append(f"{t:%d %m %Y %H:%M},{i * 2.5},{i % 13},{i * 3.0},{i % 360}")
    return lines


def _write(path, lines, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    if mtime is not None:
        os.utime(path, (mtime, mtime))


@pytest.fixture()
def csv_junk(scratch):
    d = f"{scratch}/feed"
    clean = _clean_csv()
    parts = clean[5].split(",")
    parts[2] = "abc"  # bad double in one row
    clean[5] = ",".join(parts)
    clean.insert(10, "")
    clean.insert(20, "   ")
    _write(f"{d}/input.csv", clean)
    _write(f"{d}/producer.py", ["import os", "", "x = 1", "def f():", "    return 2"])
    _write(f"{d}/compose.yml", ["version: '3'", "services:", "  kafka:", "    image: x"])
    return d


def test_csv_junk_glob_and_no_glob(spark, csv_junk):
    clean = read_csv(spark, csv_junk)
    assert clean.count() == 432
    assert clean.filter(F.col("`Wind Speed (m/s)`").isNull()).count() == 1
    everything = read_csv(spark, csv_junk, glob=None)
    # non-blank lines minus the header line, per junk file: 4 - 1 and 4 - 1
    assert everything.count() == 432 + 3 + 3


def _publish_and_consume(spark, base, feed, glob="*.csv", consume_ck="ck_consume", lake="lake",
                         sink="batches"):
    run_to_completion(start_publish_csv(
        spark, feed, f"{base}/ck_publish", out_path=f"{base}/messages", glob=glob, trigger=NOW))
    run_to_completion(start_consume(
        spark, f"{base}/messages", f"{base}/{lake}", f"{base}/{consume_ck}", trigger=NOW, sink=sink))
    return read_lake(spark, f"{base}/{lake}").select(*READINGS_SCHEMA.fieldNames())


def test_ingest_junk_becomes_null_time_rows(spark, csv_junk, scratch):
    lake = _publish_and_consume(spark, scratch, csv_junk, glob=None)
    assert lake.count() == 438
    assert lake.filter(F.col("signal_ts").isNull()).count() == 6
    assert lake.filter(F.col("signals").isNull()).count() == 0
    assert lake.select("create_ts").distinct().count() == 1  # one micro-batch, one create_ts
    assert lake.agg(F.max("signal_ts")).first()[0] == dt.datetime(2018, 1, 3, 23, 50)


def test_stream_equals_batch_shaping(spark, csv_junk, scratch):
    lake = _publish_and_consume(spark, scratch, csv_junk)
    batch = messages_to_readings(read_messages(spark, f"{scratch}/messages"))
    cols = ["signal_date", "signal_ts", F.to_json("signals").alias("s")]
    assert sorted(lake.select(*cols).collect()) == sorted(batch.select(*cols).collect())


@pytest.mark.parametrize("sink", ["batches", "table"])
def test_restart_same_checkpoint_adds_nothing(spark, csv_junk, scratch, sink):
    first = _publish_and_consume(spark, scratch, csv_junk, sink=sink).count()
    again = _publish_and_consume(spark, scratch, csv_junk, sink=sink).count()
    assert first == again == 432


def test_new_checkpoint_keeps_every_row(spark, csv_junk, scratch):
    first = _publish_and_consume(spark, scratch, csv_junk).count()
    assert first == 432
    # a new consumer checkpoint re-reads everything from the start: a replay
    replayed = _publish_and_consume(spark, scratch, csv_junk, consume_ck="ck_new")
    assert replayed.count() == 2 * 432
    assert replayed.select("create_ts").distinct().count() == 2
    assert dedup_latest(replayed).count() == 432


def test_emptied_checkpoint_keeps_every_row(spark, csv_junk, scratch):
    """The usual way to backfill: same checkpoint path, emptied; the query gets a new id."""
    _publish_and_consume(spark, scratch, csv_junk)
    drop_folder(spark, f"{scratch}/ck_consume")
    assert _publish_and_consume(spark, scratch, csv_junk).count() == 2 * 432


def test_table_sink_refuses_a_new_checkpoint(spark, csv_junk, scratch):
    assert _publish_and_consume(spark, scratch, csv_junk, sink="table").count() == 432
    with pytest.raises(ValueError, match="another checkpoint"):
        _publish_and_consume(spark, scratch, csv_junk, consume_ck="ck_new", sink="table")
    assert read_lake(spark, f"{scratch}/lake").count() == 432


def test_two_lakes_from_one_source(spark, csv_junk, scratch):
    """Default checkpoints of the command line differ by target: both lakes are whole."""
    from sigflow.cli import main

    run_to_completion(start_publish_csv(
        spark, csv_junk, f"{scratch}/ck_publish", out_path=f"{scratch}/messages", trigger=NOW))
    for lake in ("a", "b", "a"):
        main(["consume", "--messages", f"{scratch}/messages", "--lake", f"{scratch}/{lake}", "--available-now",
              "--max-files-per-trigger", "3"])
    for lake in ("a", "b"):
        assert read_lake(spark, f"{scratch}/{lake}").count() == 432
    assert stream_checkpoint(spark, "consume", "m", "a") != stream_checkpoint(spark, "consume", "m", "b")


def _readings_file(path, rows, mtime):
    lines = [json.dumps({"Date/Time": f"{t:%d %m %Y %H:%M}", "LV ActivePower (kW)": p}) for t, p in rows]
    _write(path, lines, mtime)


def test_late_data_needs_a_batch_in_between(spark, scratch):
    d = f"{scratch}/msgs"
    h = lambda hh, mm: dt.datetime(2018, 1, 1, hh, mm)
    t0 = time.time() - 100
    _readings_file(f"{d}/m1.json", [(h(0, 10), 100.0), (h(0, 20), 300.0), (h(1, 10), 50.0)], t0)
    _readings_file(f"{d}/m2.json", [(h(3, 30), 10.0)], t0 + 10)     # watermark -> 02:30
    _readings_file(f"{d}/m3.json", [(h(3, 40), 20.0)], t0 + 20)     # filler batch
    _readings_file(f"{d}/m4.json", [(h(0, 30), 9999.0)], t0 + 30)   # too late for hour 0
    readings = messages_to_readings(
        spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(d))
    hourly = hourly_means_stream(readings, watermark="1 hour")
    run_to_completion(start_foreach_batch(
        hourly, batch_folder_writer(f"{scratch}/out"), f"{scratch}/ck", output_mode="update", trigger=NOW))
    final = {r.window_start: r.avg_ActivePower_kW for r in latest_windows(spark.read.parquet(f"{scratch}/out")).collect()}
    assert final == {h(0, 0): 200.0, h(1, 0): 50.0, h(3, 0): 15.0}
    from sigflow.streaming.windows import compact_windows

    compact_windows(spark, f"{scratch}/out", f"{scratch}/final")
    compacted = {r.window_start: r.avg_ActivePower_kW for r in spark.read.parquet(f"{scratch}/final").collect()}
    assert compacted == final


def test_append_mode_holds_back_open_window(spark, scratch):
    d = f"{scratch}/msgs"
    h = lambda hh, mm: dt.datetime(2018, 1, 1, hh, mm)
    t0 = time.time() - 100
    _readings_file(f"{d}/m1.json", [(h(0, 10), 1.0), (h(1, 10), 2.0)], t0)
    _readings_file(f"{d}/m2.json", [(h(2, 30), 3.0)], t0 + 10)
    readings = messages_to_readings(
        spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(d))
    q = start_lake_sink(hourly_means_stream(readings, "10 minutes"), f"{scratch}/lake", f"{scratch}/ck", trigger=NOW)
    run_to_completion(q)
    starts = sorted(r.window_start for r in read_lake(spark, f"{scratch}/lake").collect())
    assert h(2, 0) not in starts and h(0, 0) in starts


def test_fanout_reads_once_writes_both(spark, csv_junk, scratch):
    run_to_completion(start_publish_csv(
        spark, csv_junk, f"{scratch}/ck_publish", out_path=f"{scratch}/messages", trigger=NOW))
    q = start_consume_fanout(spark, f"{scratch}/messages", f"{scratch}/lake", f"{scratch}/raw",
                             f"{scratch}/ck_fan", trigger=NOW)
    run_to_completion(q)
    assert spark.read.parquet(f"{scratch}/lake").count() == 432
    assert spark.read.text(f"{scratch}/raw").count() == 432
    # a second checkpoint's batches stand beside the first one's
    _write(f"{scratch}/more/m.json", ['{"Date/Time": "01 02 2018 00:10"}'])
    run_to_completion(start_consume_fanout(
        spark, f"{scratch}/more", f"{scratch}/lake", f"{scratch}/raw", f"{scratch}/ck_other", trigger=NOW))
    assert spark.read.parquet(f"{scratch}/lake").count() == 433
    assert spark.read.text(f"{scratch}/raw").count() == 433


def test_batch_folder_writer_is_idempotent(spark, scratch):
    df = spark.range(10)
    w = batch_folder_writer(f"{scratch}/out")
    w(df, 3)
    w(df, 3)  # a retried batch replaces its own output
    assert spark.read.parquet(f"{scratch}/out").count() == 10


def test_time_boxed_run_and_console_tap(spark, csv_junk, scratch):
    run_to_completion(start_publish_csv(
        spark, csv_junk, f"{scratch}/ck_publish", out_path=f"{scratch}/messages", trigger=NOW))
    readings = messages_to_readings(spark.readStream.format("text").load(f"{scratch}/messages"))
    tap = start_console(readings, num_rows=3, trigger={"processingTime": "1 second"})
    t0 = time.time()
    run_for(tap, 3)
    assert not tap.isActive and time.time() - t0 < 30
    raw = start_raw_tap(spark, f"{scratch}/messages", num_rows=2, trigger=NOW)
    run_to_completion(raw, timeout_s=60)


def test_failure_propagates(spark, scratch):
    def boom(batch, batch_id):
        raise RuntimeError("sink down")

    stream = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    q = start_foreach_batch(stream, boom, f"{scratch}/ck", trigger={"processingTime": "1 second"})
    with pytest.raises(Exception):
        run_to_completion(q, timeout_s=60)
    assert not q.isActive


def test_dedup_first_stream(spark, scratch):
    rows = []
    base = dt.datetime(2018, 1, 1)
    for c in range(3):
        for i in range(20):
            rows.append((base.date(), base + dt.timedelta(minutes=10 * i), base.date(),
                         dt.datetime(2024, 2, 1 + c), {"ActivePower_kW": str(i)}))
    spark.createDataFrame(rows, READINGS_SCHEMA).write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(READINGS_SCHEMA).parquet(f"{scratch}/in")
    q = start_lake_sink(dedup_first_stream(stream, "1 hour"), f"{scratch}/lake", f"{scratch}/ck", trigger=NOW)
    run_to_completion(q)
    assert read_lake(spark, f"{scratch}/lake").count() == 20


def test_dedup_first_stream_passes_untimed_rows(spark, scratch):
    t = dt.datetime(2018, 1, 1)
    timed = [(t.date(), t, t.date(), t, {"ActivePower_kW": "1"})] * 3
    none = [(None, None, t.date(), t, {"ActivePower_kW": str(k % 2)}) for k in range(4)]
    spark.createDataFrame(timed + none, READINGS_SCHEMA).write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(READINGS_SCHEMA).parquet(f"{scratch}/in")
    q = start_lake_sink(dedup_first_stream(stream, "1 hour"), f"{scratch}/lake", f"{scratch}/ck", trigger=NOW)
    run_to_completion(q)
    rows = read_lake(spark, f"{scratch}/lake")
    assert rows.filter("signal_ts is null").count() == 4 and rows.filter("signal_ts is not null").count() == 1
    assert untimed(rows).count() == 4


def test_hourly_stream_in_several_batches(spark):
    """Landed a few days at a time, one file a batch: every window is complete."""
    from sigflow.plans.streams import hourly_stream_job
    from sigflow.sources.tables import load_table

    out = hourly_stream_job(spark, "/root/testdata/sf0.001")
    want = load_table(spark, "/root/testdata/sf0.001", "events").select(F.date_trunc("hour", "ts")).distinct().count()
    assert out.count() == want


def test_save_processed_overwrites(spark, scratch):
    from sigflow.plans.analysis import hourly_report
    from sigflow.sources.lake import write_lake
    from sigflow.sources.tables import events_as_readings, load_table

    report = hourly_report(events_as_readings(load_table(spark, "/root/testdata/sf0.001", "events")))
    write_lake(report, f"{scratch}/processed")
    write_lake(report, f"{scratch}/processed")  # a rerun replaces, never appends
    back = read_lake(spark, f"{scratch}/processed")
    assert back.count() == report.count()
    assert back.columns == report.columns


def test_kafka_source_needs_connector(spark):
    from sigflow.sources.messages import read_message_stream

    with pytest.raises(Exception) as err:
        read_message_stream(spark, fmt="kafka", bootstrap="localhost:9092", topic="dataset")
    assert "kafka" in str(err.value).lower()


def test_generic_messages_stream(spark, scratch):
    from sigflow.streaming.ingest import start_consume_generic

    _write(f"{scratch}/msgs/a.json", ['{"id": "t1", "value": 1.5}', '{"id": "t2"}', "junk"])
    run_to_completion(start_consume_generic(spark, f"{scratch}/msgs", f"{scratch}/lake", f"{scratch}/ck",
                                            trigger=NOW))
    lake = read_lake(spark, f"{scratch}/lake")
    rows = sorted((r.id, r.value) for r in lake.collect() if r.id)
    assert rows == [("t1", 1.5), ("t2", None)]
    assert lake.count() == 3  # junk kept as an all-null row


def test_state_width_override_is_restored(spark):
    from sigflow.session import conf_override, state_partitions

    before = spark.conf.get("spark.sql.shuffle.partitions")
    with conf_override(spark, {"spark.sql.shuffle.partitions": "3", "spark.sigflow.probe": "x"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sigflow.probe", None) is None
    assert state_partitions(spark)["spark.sql.shuffle.partitions"] == str(spark.sparkContext.defaultParallelism)
