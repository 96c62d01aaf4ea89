"""One key holding a third of all rows: results stay whole and exact."""

import datetime as dt

from pyspark.sql import functions as F

from sigflow.operators.aggregate import avg_signals_hourly, distinct_signals_daily
from sigflow.operators.quality import dedup_latest
from sigflow.operators.text import cap_items, last_user_turn, route_intent, with_fallback

N = 9000
HOT = N // 3
BASE = dt.datetime(2018, 1, 1)


def _readings(spark):
    rows = []
    for i in range(HOT):  # one reading replayed HOT times
        rows.append((BASE, {"ActivePower_kW": "1.0"}, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)))
    for i in range(N - HOT):
        rows.append((BASE + dt.timedelta(minutes=i + 1), {"ActivePower_kW": str(float(i))}, dt.datetime(2024, 1, 1)))
    df = spark.createDataFrame(rows, "signal_ts timestamp, signals map<string,string>, create_ts timestamp")
    return df.select(F.to_date("signal_ts").alias("signal_date"), "signal_ts",
                     F.to_date("create_ts").alias("create_date"), "create_ts", "signals").repartition(8)


def test_dedup_hot_reading(spark):
    out = dedup_latest(_readings(spark))
    assert out.count() == N - HOT + 1
    hot = out.filter(F.col("signal_ts") == F.lit(BASE)).collect()
    assert len(hot) == 1 and hot[0].create_ts == dt.datetime(2024, 1, 1) + dt.timedelta(seconds=HOT - 1)


def test_aggregates_with_hot_day(spark):
    r = _readings(spark)
    days = {x.signal_date: x.distinct_signal_count for x in distinct_signals_daily(r).collect()}
    assert sum(days.values()) == N - HOT + 1
    hourly = avg_signals_hourly(r, "double").agg(F.sum("avg_ActivePower_kW")).first()[0]
    assert hourly > 0


def _turns(spark):
    rows = [(0, t, "user" if t % 2 else "assistant", f"text {t}") for t in range(HOT)]
    rows += [(c, t, "user", f"c{c} t{t}") for c in range(1, (N - HOT) // 3 + 1) for t in range(3)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)


def test_text_picks_with_hot_conversation(spark):
    turns = _turns(spark)
    last = {r.conv_id: r.text for r in last_user_turn(turns).collect()}
    assert last[0] == f"text {HOT - 1 if (HOT - 1) % 2 else HOT - 2}" and last[5] == "c5 t2"
    routes = route_intent(turns, ["text"])
    assert routes.filter("conv_id = 0").first().route == "search_venues_node"
    capped = cap_items(turns, ["conv_id"], ["turn"], n=6)
    assert sorted(r.turn for r in capped.filter("conv_id = 0").collect()) == list(range(6))
    assert capped.filter("conv_id = 5").count() == 3


def test_fallback_with_hot_request(spark):
    requests = spark.createDataFrame([(c, None) for c in range(50)], "conv_id long, location string")
    recs = spark.range(HOT).select(F.lit(0).cast("long").alias("conv_id"), F.col("id").alias("pos"))
    for f in ["name", "location", "capacity", "priceRange", "description", "image", "phone", "email"]:
        recs = recs.withColumn(f, F.lit("x"))
    recs = recs.withColumn("rating", F.lit(1.0)).withColumn("amenities", F.array(F.lit("a"))) \
        .withColumn("features", F.array(F.lit("b")))
    out = with_fallback(requests, recs, ["conv_id"])
    assert out.filter("conv_id = 0").count() == HOT
    assert out.filter("conv_id != 0").count() == 49
