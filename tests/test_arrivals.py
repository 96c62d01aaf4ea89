"""Streams whose result doesn't depend on the order of the input: replay removal and hourly means."""

import datetime as dt
import os
import random

import pytest
from locations import SF_SMALL
from pyspark.sql import functions as F

from sigflow.operators.aggregate import avg_signals_hourly
from sigflow.operators.quality import dedup_latest
from sigflow.schemas import READINGS_SCHEMA, SIGNAL_KEYS
from sigflow.sources.generations import compact, drop_covered, read_table
from sigflow.sources.tables import events_as_readings, load_table
from sigflow.streaming.arrivals import distinct_readings, first_arrivals_writer, reading_key, start_first_arrivals
from sigflow.streaming.control import run_to_completion
from sigflow.streaming.sinks import batch_folder_writer, start_foreach_batch
from sigflow.streaming.windows import hourly_partials, merge_partials, read_hourly, start_hourly_partials

NOW = {"availableNow": True}
BASE = dt.datetime(2018, 1, 1)


def reading(i, ingest=0, value=None):
    t = BASE + dt.timedelta(minutes=10 * i)
    c = dt.datetime(2024, 2, 1) + dt.timedelta(hours=ingest)
    return (t.date(), t, c.date(), c, {"ActivePower_kW": str(i % 7) if value is None else value, "WindSpeed_m_s": None})


def untimed_reading(k):
    c = dt.datetime(2024, 2, 1)
    return (None, None, c.date(), c, {"ActivePower_kW": str(k)})


def land(spark, path, files):
    """One parquet file per list of rows, taken in this order by a file stream."""
    os.makedirs(path)
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, READINGS_SCHEMA).coalesce(1).write.parquet(f"{path}-staged/{k}")
        part = next(f for f in os.listdir(f"{path}-staged/{k}") if f.endswith(".parquet"))
        os.rename(f"{path}-staged/{k}/{part}", f"{path}/{k}.parquet")
        os.utime(f"{path}/{k}.parquet", (1_700_000_000 + 100 * k,) * 2)


def stream(spark, path):
    return spark.readStream.schema(READINGS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def batch_files(order):
    """1,000 distinct readings in three files, each with replays of the others' and some without a time."""
    thirds = [range(0, 334), range(334, 667), range(667, 1000)]
    rng = random.Random(1)
    files = [[reading(i, k) for i in third] + [reading(i, k) for i in rng.sample(range(1000), 50)] + [untimed_reading(k)] * 2
             for k, third in enumerate(thirds)]
    return [files[k] for k in order]


def rows_of(df):
    cols = ["signal_date", "signal_ts", *(F.col("signals").getItem(k).alias(k) for k in SIGNAL_KEYS)]
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_first_arrivals_in_any_order(spark, scratch, order):
    files = batch_files(order)
    land(spark, f"{scratch}/in", files)
    run_to_completion(start_first_arrivals(stream(spark, f"{scratch}/in"), f"{scratch}/lake", f"{scratch}/ck", trigger=NOW))
    out = read_table(spark, f"{scratch}/lake")
    assert out.select("batch_id").distinct().count() == 3
    batch = spark.createDataFrame([r for f in files for r in f], READINGS_SCHEMA)
    assert rows_of(out) == rows_of(dedup_latest(batch))
    assert out.filter("signal_ts is not null").count() == 1000
    # of a reading's copies the one that came first, of one batch the earliest ingest, is kept
    came = {}
    for f in files:
        for row in sorted((r for r in f if r[1]), key=lambda r: r[3]):
            came.setdefault(row[1], row[3])
    assert {r.signal_ts: r.create_ts for r in out.filter("signal_ts is not null").collect()} == came


def test_first_arrivals_over_restarts_replays_and_compaction(spark, scratch):
    files = batch_files((2, 0, 1))
    land(spark, f"{scratch}/in", files[:2])
    start = lambda ck: run_to_completion(start_first_arrivals(
        stream(spark, f"{scratch}/in"), f"{scratch}/lake", f"{scratch}/{ck}", trigger=NOW))
    start("ck")
    start("ck")  # restart: nothing new
    timed = lambda: read_table(spark, f"{scratch}/lake").filter("signal_ts is not null")
    before = rows_of(timed())
    start("ck_replay")  # a replay from the start adds nothing
    assert rows_of(timed()) == before
    assert compact(spark, f"{scratch}/lake", ended=True) == 1
    drop_covered(spark, f"{scratch}/lake")
    assert rows_of(timed()) == before
    land(spark, f"{scratch}/more", files)
    for k in range(3):
        os.rename(f"{scratch}/more/{k}.parquet", f"{scratch}/in/again{k}.parquet")
    start("ck")
    assert timed().count() == 1000


def test_a_batch_written_again_keeps_its_rows(spark, scratch):
    """A retry compares with everything but what it wrote itself."""
    land(spark, f"{scratch}/in", [[reading(i) for i in range(20)], [reading(i) for i in range(10, 30)]])
    failed = []

    def flaky(batch, batch_id):
        first_arrivals_writer(f"{scratch}/lake")(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write, before the commit")

    run = lambda: run_to_completion(start_foreach_batch(
        stream(spark, f"{scratch}/in"), flaky, f"{scratch}/ck", trigger=NOW))
    with pytest.raises(Exception, match="lost after the write"):
        run()
    run()
    assert failed == [1]
    assert sorted(r.signal_ts for r in read_table(spark, f"{scratch}/lake").collect()) == [reading(i)[1] for i in range(30)]


def test_reading_key(spark):
    rows = [
        (BASE.date(), BASE, BASE.date(), BASE, {"a": "1", "b": None}),
        (BASE.date(), BASE, BASE.date(), BASE + dt.timedelta(days=3), {"b": None, "a": "1"}),
        (BASE.date(), BASE, BASE.date(), BASE, {"a": "1"}),
        (BASE.date(), BASE + dt.timedelta(microseconds=1), BASE.date(), BASE, {"a": "1"}),
        (BASE.date(), BASE, BASE.date(), BASE, None),
    ]
    df = spark.createDataFrame(rows, READINGS_SCHEMA)
    keys = [r.k for r in df.select(reading_key(df).alias("k")).collect()]
    assert keys[0] == keys[1] and len(set(keys)) == 4
    assert distinct_readings(df).count() == 4
    assert distinct_readings(df.limit(0)).count() == 0


def test_many_replays_of_one_reading_are_reduced_before_the_shuffle(spark):
    plan = distinct_readings(spark.createDataFrame([reading(0)] * 3, READINGS_SCHEMA))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "Aggregate" in above and "partial_min_by" in below


def test_a_batch_in_one_partition_is_spread_over_tasks(spark, scratch, monkeypatch):
    """A batch that comes in one large row group is not reduced in one task; nothing is lost, copies neither."""
    from sigflow.streaming import arrivals

    monkeypatch.setattr(arrivals, "ROWS_A_TASK", 100, raising=False)
    seen, reduce = [], arrivals.distinct_readings

    def looked_at(df):
        seen.append([r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()])
        return reduce(df)

    monkeypatch.setattr(arrivals, "distinct_readings", looked_at)
    rows = [reading(i, k) for k in range(3) for i in range(500)] + [untimed_reading(k) for k in range(40)]
    land(spark, f"{scratch}/in", [rows, rows, []])
    run_to_completion(start_first_arrivals(stream(spark, f"{scratch}/in"), f"{scratch}/lake", f"{scratch}/ck", trigger=NOW))
    assert [sum(sizes) for sizes in seen] == [1540, 1540, 0] and max(max(sizes, default=0) for sizes in seen) < 400
    out = read_table(spark, f"{scratch}/lake")
    timed = out.filter("signal_ts is not null")
    assert sorted((r.signal_ts, r.create_ts) for r in timed.collect()) == sorted(reading(i)[1:4:2] for i in range(500))
    assert out.filter("signal_ts is null").count() == 80


def test_more_readings_are_landed_in_more_files():
    from sigflow.plans import streams

    assert [streams.files_for(n) for n in (0, 1, 3_000_000, 3_000_001, 18_000_000)] == [6, 6, 6, 12, 36]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_hourly_partials_in_any_order_equal_the_batch_report(spark, scratch, order):
    files = batch_files(order)
    files[1][3] = reading(340, value="not a number")
    land(spark, f"{scratch}/in", files)
    run_to_completion(start_hourly_partials(stream(spark, f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ck", trigger=NOW))
    run_to_completion(start_hourly_partials(stream(spark, f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ck", trigger=NOW))
    want = avg_signals_hourly(spark.createDataFrame([r for f in files for r in f], READINGS_SCHEMA), cast="double")
    key = lambda df: sorted(((r.signal_date, r.hour, round(r.avg_ActivePower_kW, 9), r.avg_WindSpeed_m_s) for r in df.collect()), key=str)
    got = read_hourly(spark, f"{scratch}/out")
    assert got.columns == want.columns
    assert key(got) == key(want)
    assert got.filter("signal_date is null and hour is null").count() == 1  # the group without a time
    # up to the first batch: the means of the first file
    first = avg_signals_hourly(spark.createDataFrame(files[0], READINGS_SCHEMA), cast="double")
    assert key(read_hourly(spark, f"{scratch}/out", up_to=0)) == key(first)
    # compacted, nothing changes
    compact(spark, f"{scratch}/out")
    drop_covered(spark, f"{scratch}/out")
    assert key(read_hourly(spark, f"{scratch}/out")) == key(want)
    assert read_hourly(spark, f"{scratch}/nowhere") is None


def test_partials_of_a_given_table_in_another_zone(spark):
    readings = events_as_readings(load_table(spark, SF_SMALL, "events"))
    parts = [readings.filter(F.pmod(F.hash("signal_ts"), F.lit(3)) == k) for k in range(3)]
    partials = hourly_partials(parts[0], zone="Asia/Kolkata")
    for p in parts[1:]:
        partials = partials.unionByName(hourly_partials(p, zone="Asia/Kolkata"))
    want = avg_signals_hourly(readings, cast="double", zone="Asia/Kolkata")
    key = lambda df: sorted((r.signal_date, r.hour, *(round(r[f"avg_{k}"], 6) for k in SIGNAL_KEYS)) for r in df.collect())
    assert key(merge_partials(partials)) == key(want)


def test_stream_jobs_over_several_batches(spark):
    from sigflow.plans.streams import hourly_stream_job, q_dedup_first

    events = load_table(spark, SF_SMALL, "events")
    out = hourly_stream_job(spark, SF_SMALL)
    assert out.count() == events.select(F.date_trunc("hour", "ts")).distinct().count()
    assert out.agg(F.max("window_end")).first()[0] == events.agg(F.max(F.date_trunc("hour", "ts") + F.expr("interval 1 hour"))).first()[0]
    assert rows_of(spark.createDataFrame([], READINGS_SCHEMA)) == []
    readings = events_as_readings(events)
    first = q_dedup_first(spark, SF_SMALL)
    assert first.count() == distinct_readings(readings).count()


def test_a_failed_write_leaves_no_batch(spark, scratch):
    df = spark.createDataFrame([reading(0)], READINGS_SCHEMA)
    batch_folder_writer(f"{scratch}/t/app_id=q")(df, 0)
    assert read_table(spark, f"{scratch}/t").count() == 1
    os.remove(f"{scratch}/t/app_id=q/batch_id=0/_SUCCESS")
    assert read_table(spark, f"{scratch}/t") is None
