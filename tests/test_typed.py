"""Typed signal copies: same results as parsing the map, narrower scans."""

from pyspark.sql import functions as F

from locations import SF_ORACLE
from sigflow.operators.aggregate import avg_signals_hourly
from sigflow.operators.quality import dedup_latest
from sigflow.operators.shape import with_typed_signals
from sigflow.sources.lake import read_lake, write_lake
from sigflow.sources.tables import events_as_readings, load_table, replayed_readings


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_typed_copies_give_identical_means(spark, scratch):
    readings = events_as_readings(load_table(spark, SF_ORACLE, "events"))
    write_lake(with_typed_signals(readings), f"{scratch}/typed")
    typed = read_lake(spark, f"{scratch}/typed")
    for cast in ("float", "double"):
        assert _rows(avg_signals_hourly(typed, cast)) == _rows(avg_signals_hourly(readings, cast))
    plan = avg_signals_hourly(typed, "float")._jdf.queryExecution().executedPlan().toString()
    assert "signals:" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_dedup_with_typed_and_batch_columns(spark):
    replayed = with_typed_signals(replayed_readings(load_table(spark, "/root/testdata/sf0.001", "events")))
    replayed = replayed.withColumn("batch_id", F.lit(7)).withColumn("app_id", F.lit("a"))
    out = dedup_latest(replayed)
    assert out.count() == 1000
    assert out.columns == replayed.columns
    assert out.select("create_ts").distinct().count() == 1


def test_stream_hourly_reads_typed_copies(spark, scratch):
    from sigflow.streaming.control import run_to_completion
    from sigflow.streaming.sinks import batch_folder_writer, start_foreach_batch
    from sigflow.streaming.windows import hourly_means_stream, latest_windows

    readings = events_as_readings(load_table(spark, "/root/testdata/sf0.001", "events"))
    typed = with_typed_signals(readings, ("double",))
    typed.write.parquet(f"{scratch}/typed")
    stream = spark.readStream.schema(typed.schema).parquet(f"{scratch}/typed")
    hourly = hourly_means_stream(stream, watermark="1 hour", cast="double")
    assert "ActivePower_kW_double" in hourly._jdf.queryExecution().analyzed().toString()
    run_to_completion(start_foreach_batch(hourly, batch_folder_writer(f"{scratch}/out"), f"{scratch}/ck",
                                          output_mode="update", trigger={"availableNow": True}))
    got = {r.window_start: r.avg_ActivePower_kW for r in latest_windows(spark.read.parquet(f"{scratch}/out")).collect()}
    want = {r.h: r.v for r in readings.groupBy(F.date_trunc("hour", "signal_ts").alias("h")).agg(
        F.avg(F.col("signals")["ActivePower_kW"].try_cast("double")).alias("v")).collect()}
    assert got == want
