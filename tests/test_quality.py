"""Replay removal and ingest audit (replay3 fixture)."""

import datetime as dt

from pyspark.sql import functions as F

from sigflow.operators.quality import dedup_latest, ingest_audit
from sigflow.schemas import READINGS_SCHEMA

T = [dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2), dt.datetime(2024, 2, 3)]


def _clean(n=432):
    base = dt.datetime(2018, 1, 1)
    rows = []
    for i in range(n):  # 3 days x 144 ten-minute rows
        ts = base + dt.timedelta(minutes=10 * i)
        rows.append((ts.date(), ts, {"ActivePower_kW": str(i * 1.5), "WindSpeed_m_s": str(i % 7),
                                     "PowerCurve_kWh": None, "WindDirection_deg": "10"}))
    return rows


def _replay3(spark):
    rows = []
    for c in T:
        rows += [(d, ts, c.date(), c, s) for d, ts, s in _clean()]
        rows += [(None, None, c.date(), c, {"ActivePower_kW": None}) for _ in range(2)]
    return spark.createDataFrame(rows, READINGS_SCHEMA)


def test_dedup_latest_keeps_newest(spark):
    out = dedup_latest(_replay3(spark))
    timed = out.filter(F.col("signal_ts").isNotNull())
    assert timed.count() == 432
    assert timed.select("create_ts").distinct().collect()[0][0] == T[-1]
    # untimed rows have no identity: all kept
    assert out.filter(F.col("signal_ts").isNull()).count() == 6


def test_dedup_latest_idempotent(spark):
    once = dedup_latest(_replay3(spark))
    twice = dedup_latest(once)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_dedup_is_aggregate_not_window(spark):
    plan = dedup_latest(_replay3(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "partial_max" in plan or "partial_max_by" in plan


def test_ingest_audit(spark):
    rows = {r.create_ts: r for r in ingest_audit(_replay3(spark)).collect()}
    assert set(rows) == set(T)
    r = rows[T[0]]
    assert (r.num_records, r.null_signal_ts, r.null_signal_date) == (434, 2, 2)
    assert r.min_signal_ts == dt.datetime(2018, 1, 1) and r.max_signal_ts == dt.datetime(2018, 1, 3, 23, 50)
    assert (r.null_signals, r.null_ActivePower_kW, r.null_WindSpeed_m_s, r.null_PowerCurve_kWh) == (0, 2, 2, 434)
