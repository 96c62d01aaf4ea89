"""Junk messages are set apart without loss; audits are taken while batches are written."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from sigflow.operators.quality import ingest_audit
from sigflow.operators.shape import accepted, judge_messages, messages_to_readings, rejected
from sigflow.schemas import RAW_TIME, READINGS_SCHEMA, SIGNAL_KEYS
from sigflow.sources.generations import read_table
from sigflow.streaming.audit import AuditLog, fill_audit, observed, read_audit
from sigflow.streaming.control import run_to_completion
from sigflow.streaming.ingest import readings_stream, start_consume_split
from sigflow.streaming.sinks import batch_folder_writer, start_foreach_batch

NOW = {"availableNow": True}
JUNK = {
    None: "blank", "": "blank", " \t ": "blank", "import os": "not a JSON object", "7": "not a JSON object",
    '["a"]': "not a JSON object", "{": "not a JSON object", "{}": "no time", '{"x": 1}': "no time",
    json.dumps({RAW_TIME: None}): "no time", json.dumps({RAW_TIME: "soon"}): "unreadable time",
    json.dumps({RAW_TIME: "01 01 2018"}): "unreadable time", json.dumps({RAW_TIME: ""}): "unreadable time",
}


def message(i):
    return json.dumps({RAW_TIME: f"{1 + i % 28:02d} 01 2018 {i % 24:02d}:00", "LV ActivePower (kW)": str(i), "Wind Speed (m/s)": "x" if i % 5 else None})


def land(path, files):
    os.makedirs(path)
    for k, lines in enumerate(files):
        with open(f"{path}/{k}.txt", "w") as f:
            f.write("".join(line + "\n" for line in lines))
        os.utime(f"{path}/{k}.txt", (1_700_000_000 + 100 * k,) * 2)


def test_every_message_is_shaped_or_rejected(spark):
    texts = [message(i) for i in range(50)] + list(JUNK)
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    at = dt.datetime(2024, 2, 1)
    judged = judge_messages(messages, at)
    assert judged.count() == len(texts)
    assert {r.value: r.reason for r in rejected(judged).collect()} == JUNK
    # the accepted ones are those of the plain consumer that have a time
    plain = messages_to_readings(messages, at).filter("signal_ts is not null")
    cols = ["signal_date", "signal_ts", "create_ts", F.to_json("signals").alias("s")]
    assert accepted(judged).columns == READINGS_SCHEMA.fieldNames()
    assert sorted(accepted(judged).select(*cols).collect()) == sorted(plain.select(*cols).collect())
    assert judge_messages(messages.limit(0)).count() == 0
    # binary values, as a broker delivers them
    binary = judge_messages(messages.select(F.col("value").cast("binary").alias("value")), at)
    assert sorted(binary.select("value", "reason").collect(), key=str) == sorted(judged.select("value", "reason").collect(), key=str)


def test_messages_are_parsed_once(spark):
    judged = judge_messages(spark.createDataFrame([(message(1),)], "value string").repartition(2))
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_split_stream(spark, scratch):
    junk = [x for x in JUNK if x is not None]
    land(f"{scratch}/in", [[message(i) for i in range(30)] + junk[:4], junk[4:], [message(i) for i in range(30, 40)]])
    start = lambda: run_to_completion(start_consume_split(
        spark, f"{scratch}/in", f"{scratch}/lake", f"{scratch}/rejected", f"{scratch}/ck", raw_path=f"{scratch}/raw",
        trigger=NOW, max_files_per_trigger=1))
    start()
    start()  # restart: nothing is added
    lake, junked = read_table(spark, f"{scratch}/lake"), read_table(spark, f"{scratch}/rejected")
    assert lake.count() == 40 and lake.filter("signal_ts is null").count() == 0
    assert sorted((r.value, r.reason) for r in junked.collect()) == sorted((x, JUNK[x]) for x in junk)
    assert spark.read.text(f"{scratch}/raw").count() == 40 + len(junk)
    # counts agree with the audit of the plain consumer, which drops the blank ones
    audit = ingest_audit(messages_to_readings(spark.read.text(f"{scratch}/in"))).first()
    assert audit.num_records - audit.null_signal_ts == lake.count()
    assert audit.null_signal_ts == junked.filter("reason != 'blank'").count()


def as_audit(df):
    """Audit rows by their ingest time."""
    names = ["num_records", "null_signal_ts", "null_signal_date", "null_signals", *(f"null_{k}" for k in SIGNAL_KEYS),
             "min_signal_ts", "max_signal_ts", "min_signal_date", "max_signal_date"]
    return {r.create_ts: tuple(r[n] for n in names) for r in df.collect()}


def test_audit_of_every_batch(spark, scratch):
    land(f"{scratch}/in", [[message(i) for i in range(30)], ["import os", message(3)], [message(i) for i in range(30, 70)], ["", " "]])
    log = AuditLog(spark, f"{scratch}/audit")
    spark.streams.addListener(log)
    try:
        readings = observed(readings_stream(spark, f"{scratch}/in", max_files_per_trigger=1))
        q = start_foreach_batch(readings, batch_folder_writer(f"{scratch}/lake"), f"{scratch}/ck", trigger=NOW)
        run_to_completion(q)
        log.catch_up(q)
    finally:
        spark.streams.removeListener(log)
    lake = read_table(spark, f"{scratch}/lake")
    audit = read_audit(spark, f"{scratch}/audit")
    assert as_audit(audit) == as_audit(ingest_audit(lake)) and audit.count() == 3
    assert {(r.app_id, r.batch_id) for r in audit.collect()} == {(str(q.id), b) for b in range(3)}
    # the write itself took the counts: no second scan of the files
    assert fill_audit(spark, f"{scratch}/lake", f"{scratch}/audit") == 1  # the batch of blank lines: no rows, no record


def test_a_failed_batch_adds_no_audit(spark, scratch):
    land(f"{scratch}/in", [[message(i) for i in range(10)], [message(i) for i in range(10, 25)]])
    log = AuditLog(spark, f"{scratch}/audit")
    failed = []

    def flaky(batch, batch_id):
        batch_folder_writer(f"{scratch}/lake")(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(1)
            raise RuntimeError("sink down")

    def start():
        readings = observed(readings_stream(spark, f"{scratch}/in", max_files_per_trigger=1))
        return start_foreach_batch(readings, flaky, f"{scratch}/ck", trigger=NOW)

    q = start()
    with pytest.raises(Exception, match="sink down"):
        run_to_completion(q)
    log.catch_up(q)
    assert [r.batch_id for r in read_audit(spark, f"{scratch}/audit").collect()] == [0]
    q = start()
    run_to_completion(q)
    log.catch_up(q)
    audit = read_audit(spark, f"{scratch}/audit")
    assert sorted((r.batch_id, r.num_records) for r in audit.collect()) == [(0, 10), (1, 15)]
    assert as_audit(audit) == as_audit(ingest_audit(read_table(spark, f"{scratch}/lake")))


def test_batches_without_a_record_are_counted_later(spark, scratch):
    land(f"{scratch}/in", [[message(i) for i in range(10)], [message(i) for i in range(10, 25)] + ["junk"]])
    q = start_foreach_batch(
        readings_stream(spark, f"{scratch}/in", max_files_per_trigger=1), batch_folder_writer(f"{scratch}/lake"),
        f"{scratch}/ck", trigger=NOW)
    run_to_completion(q)
    assert fill_audit(spark, f"{scratch}/lake", f"{scratch}/audit") == 2
    assert fill_audit(spark, f"{scratch}/lake", f"{scratch}/audit") == 0
    assert as_audit(read_audit(spark, f"{scratch}/audit")) == as_audit(ingest_audit(read_table(spark, f"{scratch}/lake")))
    assert fill_audit(spark, f"{scratch}/none", f"{scratch}/audit") == 0
