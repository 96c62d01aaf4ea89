"""Compaction of batch folders, reads by generation and up to a batch, crashes between the steps."""

import datetime as dt
import os

import pytest

from sigflow.sources import generations as gen
from sigflow.sources.generations import compact, drop_covered, generations, read_generation, read_table
from sigflow.streaming.sinks import batch_folder_writer

SCHEMA = "signal_date date, v int"


def write(spark, path, app, batch, values, day=None):
    d = lambda v: day or dt.date(2018, 1, 1 + v % 3) if v % 10 else None
    df = spark.createDataFrame([(d(v), v) for v in values], SCHEMA)
    batch_folder_writer(f"{path}/app_id={app}", partition_by=None)(df, batch)


def rows(df):
    return sorted((r.v, str(r.signal_date), r.app_id, r.batch_id) for r in df.collect()) if df is not None else None


@pytest.fixture()
def table(spark, scratch):
    """Two queries, five and three batches of 20 rows."""
    for app, n in (("q1", 5), ("q2", 3)):
        for b in range(n):
            write(spark, scratch, app, b, range(100 * b, 100 * b + 20))
    return scratch


def test_same_rows_before_during_and_after(spark, table):
    before = rows(read_table(spark, table))
    assert len(before) == 160
    assert compact(spark, table) == 1
    g = read_generation(spark, table)
    assert g.held == {"q1": 3, "q2": 1}  # the newest batch of a query may be written again
    assert rows(read_table(spark, table)) == before
    assert drop_covered(spark, table) == 6 and drop_covered(spark, table) == 0
    assert rows(read_table(spark, table)) == before
    # the newest batch is retried with other rows: the retry holds
    write(spark, table, "q1", 4, [7])
    write(spark, table, "q1", 5, [8])
    now = rows(read_table(spark, table))
    assert [r for r in now if r[2:] == ("q1", 4)] == [(7, "2018-01-02", "q1", 4)] and len(now) == 160 - 20 + 2
    assert compact(spark, table, ended={"q2"}) == 2
    assert read_generation(spark, table).held == {"q1": 4, "q2": 2}
    assert compact(spark, table) is None
    assert rows(read_table(spark, table)) == now
    drop_covered(spark, table)
    assert generations(spark, table) == [2] and rows(read_table(spark, table)) == now


def test_only_new_batches_are_rewritten(spark, table):
    compact(spark, table, ended=True)
    first = read_generation(spark, table).segments
    write(spark, table, "q1", 5, range(500, 520))
    compact(spark, table, ended=True)
    second = read_generation(spark, table).segments
    assert second[:1] == first and len(second) == 2
    days = os.listdir(f"{table}/_generations/data/segment={first[0]}")
    assert {d for d in days if d.startswith("signal_date=")} == {
        f"signal_date={x}" for x in ("2018-01-01", "2018-01-02", "2018-01-03", "__HIVE_DEFAULT_PARTITION__")}


def test_reads_by_generation_and_up_to_a_batch(spark, table):
    compact(spark, table)
    write(spark, table, "q1", 5, range(500, 520))
    compact(spark, table, ended=True)
    of = lambda **kw: {x[2:] for x in rows(read_table(spark, table, **kw))}
    assert of(generation=1) == {("q1", b) for b in range(4)} | {("q2", 0), ("q2", 1)}
    assert of(generation=2) == {("q1", b) for b in range(6)} | {("q2", b) for b in range(3)}
    assert of(up_to=1) == {(q, b) for q in ("q1", "q2") for b in (0, 1)}
    assert of(up_to={"q1": 4}) == {("q1", b) for b in range(5)}
    assert read_table(spark, table, up_to={}).count() == 0
    with pytest.raises(ValueError, match="no generation 9"):
        read_table(spark, table, generation=9)


@pytest.mark.parametrize("step", ["before the segment", "in the segment", "before publishing", "after publishing"])
def test_a_crash_between_steps_loses_nothing(spark, table, step, monkeypatch):
    before = rows(read_table(spark, table))
    publish = gen.put_text

    def crash(*args, **kwargs):
        if step == "after publishing":
            publish(*args, **kwargs)
        raise RuntimeError("driver lost")

    if step == "before the segment":
        monkeypatch.setattr(gen, "read_batches", crash)
    elif step in ("before publishing", "after publishing"):
        monkeypatch.setattr(gen, "put_text", crash)
    if step == "in the segment":  # half a segment that nothing names
        spark.createDataFrame([(None, 1)], SCHEMA).write.parquet(f"{table}/_generations/data/segment=half")
    else:
        with pytest.raises(RuntimeError, match="driver lost"):
            compact(spark, table)
    monkeypatch.undo()
    assert rows(read_table(spark, table)) == before
    drop_covered(spark, table)
    assert rows(read_table(spark, table)) == before
    compact(spark, table, ended=True)
    drop_covered(spark, table)
    assert rows(read_table(spark, table)) == before
    segments = os.listdir(f"{table}/_generations/data")
    assert len([s for s in segments if s.startswith("segment=")]) == len(read_generation(spark, table).segments)


def test_two_compactions_at_once(spark, table, monkeypatch):
    publish, before = gen.put_text, rows(read_table(spark, table))

    def late(spark_, path, text, overwrite=False):
        monkeypatch.setattr(gen, "put_text", publish)
        assert compact(spark, table) == 1  # another one is quicker
        publish(spark_, path, text, overwrite)

    monkeypatch.setattr(gen, "put_text", late)
    with pytest.raises(FileExistsError):
        compact(spark, table)
    assert rows(read_table(spark, table)) == before and generations(spark, table) == [1]


def test_columns_that_come_later(spark, table):
    compact(spark, table, ended=True)
    df = spark.createDataFrame([(None, 3, "x")], SCHEMA + ", note string")
    batch_folder_writer(f"{table}/app_id=q3")(df, 0)
    assert read_table(spark, table).filter("note = 'x'").count() == 1
    compact(spark, table, ended=True)
    out = read_table(spark, table)
    assert out.count() == 161 and out.filter("note is not null").count() == 1


def test_day_filters_reach_the_folders(spark, table):
    compact(spark, table, ended=True)
    plan = read_table(spark, table).filter("signal_date = date'2018-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(signal_date" in plan


def test_tables_without_batches(spark, scratch):
    assert read_table(spark, f"{scratch}/none") is None
    assert compact(spark, f"{scratch}/none") is None and drop_covered(spark, f"{scratch}/none") == 0
    df = spark.createDataFrame([(1,)], "v int")  # no day to partition by
    batch_folder_writer(f"{scratch}/plain/app_id=q")(df, 0)
    assert compact(spark, f"{scratch}/plain", ended=True) == 1
    assert read_table(spark, f"{scratch}/plain", generation=1).collect()[0].v == 1
