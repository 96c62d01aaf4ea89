"""Signal lookup (map_edge), mapping-driven renames and the long join."""

import datetime as dt

from pyspark.sql import functions as F

from sigflow.functions.signals import signal_value
from sigflow.operators.aggregate import avg_signals_hourly, distinct_signals_daily
from sigflow.operators.mapping import mapping_join_long, rename_mapped, signal_mapping
from sigflow.schemas import SIGNAL_MAPPING, SIGNAL_MAPPING_LEGACY_LABEL


def test_map_edge_lookup(spark):
    df = spark.createDataFrame(
        [({"ActivePower_kW": "1.5"},), ({"ActivePower_kW": None},), ({"ActivePower_kW": "abc"},),
         ({},), ({"WindSpeed_m_s": "2"},)],
        "signals map<string,string>",
    )
    got = [r.v for r in df.select(signal_value("ActivePower_kW", "double").alias("v")).collect()]
    assert got == [1.5, None, None, None, None]


def test_float_and_double_means_differ(spark):
    ts = dt.datetime(2018, 1, 1, 0, 10)
    df = spark.createDataFrame(
        [(dt.date(2018, 1, 1), ts, {"ActivePower_kW": "380.0477905"})],
        "signal_date date, signal_ts timestamp, signals map<string,string>",
    )
    f = avg_signals_hourly(df, "float", ["ActivePower_kW"]).first().avg_ActivePower_kW
    d = avg_signals_hourly(df, "double", ["ActivePower_kW"]).first().avg_ActivePower_kW
    assert d == 380.0477905 and f != d and abs(f - d) < 1e-4


def test_null_date_is_own_group(spark):
    df = spark.createDataFrame(
        [(None, None, {"ActivePower_kW": None}), (None, None, {"ActivePower_kW": None})],
        "signal_date date, signal_ts timestamp, signals map<string,string>",
    )
    from sigflow.plans.analysis import hourly_indicator

    row = hourly_indicator(df).first()
    assert row.signal_date is None and row.hour is None and row.avg_ActivePower_kW is None
    assert row.generation_indicator == "Exceptional"
    assert distinct_signals_daily(df).first().distinct_signal_count == 0


def test_rename_present_only_and_order(spark):
    df = spark.createDataFrame([(1.0, "Low", 3)], "avg_ActivePower_kW double, generation_indicator string, hour int")
    out = rename_mapped(df, signal_mapping(spark))
    assert out.columns == ["active_power_average", "generation_mapping", "hour"]


def test_rename_legacy_label_and_chain(spark):
    rows = SIGNAL_MAPPING[:-1] + [SIGNAL_MAPPING_LEGACY_LABEL]
    df = spark.createDataFrame([(1.0, "Low")], "avg_ActivePower_kW double, generation_indicator string")
    out = rename_mapped(df, signal_mapping(spark, rows, view=None))
    assert out.columns == ["active_power_average", "generation_status"]
    # rows apply in order: a -> b then b -> c renames a to c; c -> a afterwards does nothing to b
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y")], "sig_name string, sig_mapping_name string")
    df2 = spark.createDataFrame([(1, 2)], "a int, z int")
    assert rename_mapped(df2, chain).columns == ["c", "z"]


def test_rename_round_trip(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "avg_ActivePower_kW double, avg_WindSpeed_m_s double")
    fwd = signal_mapping(spark, view=None)
    back = fwd.select(F.col("sig_mapping_name").alias("sig_name"), F.col("sig_name").alias("sig_mapping_name"))
    assert rename_mapped(rename_mapped(df, fwd), back).columns == df.columns


def test_mapping_join_long_broadcasts(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 3.0)], "hour int, avg_ActivePower_kW double, avg_WindSpeed_m_s double, other double")
    out = mapping_join_long(df, signal_mapping(spark, view=None), ["hour"])
    got = sorted((r.sig_name, r.sig_mapping_name, r.value) for r in out.collect())
    assert got == [("avg_ActivePower_kW", "active_power_average", 1.0),
                   ("avg_WindSpeed_m_s", "wind_speed_average", 2.0), ("other", "other", 3.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_mapping_join_long_first_row_wins_and_unmapped(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0)], "hour int, a double, b double")
    mapping = spark.createDataFrame([("a", "first"), ("a", "second"), ("zzz", "unused")],
                                    "sig_name string, sig_mapping_name string")
    got = sorted((r.sig_name, r.sig_mapping_name) for r in mapping_join_long(df, mapping, ["hour"]).collect())
    assert got == [("a", "first"), ("b", "b")]


def test_approx_distinct_close_to_exact(spark):
    from sigflow.sources.tables import events_as_readings, load_table

    r = events_as_readings(load_table(spark, "/root/testdata/sf0.01", "events"))
    exact = {x.signal_date: x.distinct_signal_count for x in distinct_signals_daily(r).collect()}
    approx = {x.signal_date: x.distinct_signal_count for x in distinct_signals_daily(r, approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[d] - exact[d]) <= 0.1 * exact[d] for d in exact)


def test_hours_in_a_fixed_zone_ignore_session_zone(spark):
    import datetime as dt2

    df = spark.createDataFrame([(dt2.date(2018, 1, 1), dt2.datetime(2018, 1, 1, 23, 50), {"ActivePower_kW": "1"})],
                               "signal_date date, signal_ts timestamp, signals map<string,string>")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        hours = set()
        for session_zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            hours.add(avg_signals_hourly(df, "double", ["ActivePower_kW"], zone="Asia/Kolkata").first().hour)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert len(hours) == 1
    assert hours == {5}  # 23:50 UTC is 05:20 at +05:30


def test_dates_move_with_hours_in_a_zone(spark):
    """00:10 and 23:40 of one UTC day lie on two days at +05:30."""
    day = dt.date(2018, 1, 1)
    df = spark.createDataFrame(
        [(day, dt.datetime(2018, 1, 1, 0, 10), {"ActivePower_kW": "100"}),
         (day, dt.datetime(2018, 1, 1, 23, 40), {"ActivePower_kW": "900"}),
         (day, None, {"ActivePower_kW": "7"})],
        "signal_date date, signal_ts timestamp, signals map<string,string>")
    rows = avg_signals_hourly(df, "double", ["ActivePower_kW"], zone="Asia/Kolkata").collect()
    assert {(r.signal_date, r.hour, r.avg_ActivePower_kW) for r in rows} == {
        (day, 5, 100.0), (dt.date(2018, 1, 2), 5, 900.0), (day, None, 7.0)}


def test_mapping_of_any_size(spark):
    """Twelve thousand rows that apply, and as many that do not: no row is refused or fetched."""
    n = 12_000
    rows = spark.range(n).selectExpr("concat('c', id) as sig_name", "concat('d', id) as sig_mapping_name", "id as place")
    chain = spark.createDataFrame([("a", "b", n + 1), ("b", "c", n + 2), ("a", "never", n + 3), ("c", "d", n + 4)],
                                  "sig_name string, sig_mapping_name string, place long")
    mapping = rows.unionByName(chain).repartition(5)
    df = spark.createDataFrame([(1, 2, 3)], "a int, c7 int, k int")
    assert rename_mapped(df, mapping, order_col="place").columns == ["d", "d7", "k"]
    long = mapping_join_long(df.select("k", "a", "c7"), mapping, ["k"], order_col="place")
    assert sorted((r.sig_name, r.sig_mapping_name) for r in long.collect()) == [("a", "b"), ("c7", "d7")]


def test_rename_follows_the_order_column(spark):
    mapping = spark.createDataFrame([("b", "c", 1), ("a", "b", 2), ("b", "z", 3), ("z", "a", 4)],
                                    "sig_name string, sig_mapping_name string, place int").repartition(3)
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_mapped(df, mapping, order_col="place").columns == ["a", "c"]


def test_both_ways_of_renaming_follow_the_rows_one_by_one(spark):
    import random

    from sigflow.operators.mapping import _ordered, _replay, _steps

    rng = random.Random(3)
    for _ in range(6):
        rows = [(rng.choice("abcdef"), rng.choice("abcdef"), k) for k in range(rng.randint(0, 9))]
        columns = ["a", "b", "c"]
        names = {c: c for c in columns}
        for old, new, _place in rows:
            names = {c: new if n == old else n for c, n in names.items()}
        want = {c: n for c, n in names.items() if n != c}
        mapping = _ordered(spark.createDataFrame(rows, "sig_name string, sig_mapping_name string, place int"), "place")
        assert _replay(mapping.collect(), columns) == want
        assert _steps(mapping, columns) == want


def test_rename_reads_a_small_mapping_once(spark):
    """One job for the default mapping; rows without a name or place change nothing."""
    df = spark.createDataFrame([(1.0, "Low")], "avg_ActivePower_kW double, generation_indicator string")
    mapping = spark.createDataFrame([("generation_indicator", "label", 2), ("avg_ActivePower_kW", None, 1), (None, "x", 3),
                                     ("avg_ActivePower_kW", "p", None)], "sig_name string, sig_mapping_name string, place int")
    assert rename_mapped(df, mapping, order_col="place").columns == ["avg_ActivePower_kW", "label"]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-round-rename", "rename")
    rename_mapped(df, signal_mapping(spark, view=None))
    jobs = tracker.getJobIdsForGroup("one-round-rename")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 1


def test_report_leaves_the_users_view_alone(spark):
    from sigflow.plans.analysis import hourly_report
    from sigflow.sources.tables import events_as_readings, load_table

    spark.range(3).createOrReplaceTempView("mapping_table")
    hourly_report(events_as_readings(load_table(spark, "/root/testdata/sf0.001", "events")))
    assert spark.table("mapping_table").columns == ["id"]
