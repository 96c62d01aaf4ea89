"""Physical-plan properties that matter at scale."""

import re

from pyspark.sql import functions as F

from locations import SF_SMALL
from sigflow.operators.text import route_intent
from sigflow.plans import catalog
from sigflow.plans.analysis import hourly_report
from sigflow.sources.lake import read_lake, write_lake
from sigflow.sources.tables import events_as_readings, load_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_count_prunes_and_spreads_hot_days(spark):
    p = plan(catalog.q_distinct_signals_daily(spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in p
    # the first shuffle is keyed on (date, ts), so one busy day spreads out
    assert re.search(r"hashpartitioning\(signal_date#\d+, signal_ts#\d+", p)


def test_hourly_means_partial_aggregate_before_shuffle(spark):
    p = plan(catalog.q_avg_signals_hourly(spark, SF_SMALL))
    assert p.index("partial_avg") > p.index("Exchange")  # partial is below (printed after) the exchange
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in p


def test_day_filter_prunes_partitions_of_lake_table(spark, scratch):
    readings = events_as_readings(load_table(spark, SF_SMALL, "events"))
    write_lake(readings, f"{scratch}/lake", partition_by=["signal_date"])
    lake = read_lake(spark, f"{scratch}/lake")
    day = hourly_report(lake).filter(F.col("signal_date") == F.lit("2024-01-19").cast("date"))
    p = plan(day)
    assert re.search(r"PartitionFilters: \[isnotnull\(signal_date#\d+\), \(signal_date#\d+ = 2024-01-19\)\]", p)
    assert day.count() > 0


def test_route_intent_combines_before_shuffle(spark):
    p = plan(route_intent(load_table(spark, SF_SMALL, "conversations")))
    assert "partial_max_by" in p


def test_text_extraction_once(spark):
    from sigflow.plans import venues

    turns = load_table(spark, SF_SMALL, "conversations")
    span = "(?s)\\["  # the JSON-array span pattern
    # once per branch (records and their keys), no inferred duplicate, no join of the records
    p = plan(venues.venue_results(turns))
    assert p.count(span) == 2 and "LeftSemi" not in p
    # the whole span is parsed once; the records are read from its first element
    records = plan(venues.venue_records(turns))
    assert records.count("from_json") == 2 and records.count(span) == 1


def test_sorted_lake_write_skips_row_groups(spark, scratch):
    readings = events_as_readings(load_table(spark, "/root/testdata/sf0.01", "events"))
    write_lake(readings, f"{scratch}/lake", sort_by=["signal_ts"])
    lake = read_lake(spark, f"{scratch}/lake")
    day = lake.filter(F.col("signal_ts") < F.lit("2024-01-02").cast("timestamp"))
    assert "PushedFilters: [IsNotNull(signal_ts), LessThan(signal_ts" in plan(day)
    assert day.count() == readings.filter(F.col("signal_ts") < F.lit("2024-01-02").cast("timestamp")).count()
