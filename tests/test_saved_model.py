"""The model as a saved pipeline, on batches and streams; residuals in data-driven bins."""

import random

import pytest
from locations import SF_SMALL
from pyspark.sql import functions as F

from sigflow.operators import ml
from sigflow.plans import modeling, streams
from sigflow.sources.generations import read_table
from sigflow.sources.tables import events_as_readings, load_table
from sigflow.streaming.control import run_to_completion

DAY = "2024-01-19"


@pytest.fixture(scope="module")
def fitted(spark):
    frame = modeling.ml_frame(events_as_readings(load_table(spark, SF_SMALL, "events")))
    model, test = modeling.fit_on_split(frame, key_cols=["signal_date", "hour"])
    return frame, model, test


def rows(df):
    return sorted((str(r.signal_date), r.hour, r.active_power_average, r.prediction) for r in df.collect())


def test_scores_after_a_reload_equal_the_models(spark, fitted, scratch):
    frame, model, _ = fitted
    modeling.save_model(frame, model, f"{scratch}/model")
    modeling.save_model(frame, model, f"{scratch}/model")  # a rerun replaces it
    pipeline = ml.load_pipeline(f"{scratch}/model")
    want = rows(modeling.predict_day(model, frame, DAY))
    assert want and rows(modeling.score_report(pipeline, frame.report, DAY)) == want
    # the day reaches the scan
    frame.report.write.partitionBy("signal_date").parquet(f"{scratch}/report")
    plan = modeling.score_report(pipeline, spark.read.parquet(f"{scratch}/report"), DAY)
    assert f"signal_date#" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:120]
    assert rows(plan) == want


def test_scores_on_a_stream(spark, fitted, scratch):
    frame, model, _ = fitted
    pipeline = modeling.save_model(frame, model, f"{scratch}/model")
    frame.report.repartition(4).write.parquet(f"{scratch}/report")
    report = spark.readStream.schema(frame.report.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/report")
    for _ in range(2):  # a restart adds nothing
        run_to_completion(modeling.start_scoring(
            pipeline, report, f"{scratch}/scores", f"{scratch}/ck", trigger=streams.AVAILABLE_NOW))
    out = read_table(spark, f"{scratch}/scores")
    assert out.select("batch_id").distinct().count() == 4
    assert rows(out) == rows(modeling.score_report(pipeline, frame.report))
    assert rows(out.filter(F.col("signal_date") == DAY)) == rows(modeling.predict_day(model, frame, DAY))


def test_a_band_that_the_fit_has_not_seen_is_scored(spark, fitted, scratch):
    frame, model, _ = fitted
    pipeline = modeling.save_model(frame, model, f"{scratch}/model")
    row = frame.report.limit(1).withColumns({"generation_mapping": F.lit("Unheard of"), "hour": F.lit(99)})
    scored = modeling.score_report(pipeline, frame.report.limit(1).unionByName(row)).collect()
    assert len(scored) == 2 and all(r.prediction is not None for r in scored)
    nothing = frame.report.limit(1).withColumn("wind_speed_average", F.lit(None).cast("double"))
    assert modeling.score_report(pipeline, nothing).collect() == []


def test_model_command_saves_and_score_command_loads(spark, fitted, scratch):
    from sigflow.cli import main

    frame, _, _ = fitted
    frame.report.write.parquet(f"{scratch}/report")
    main(["model", "--report", f"{scratch}/report", "--out", f"{scratch}/out", "--day", DAY])
    main(["score", "--model", f"{scratch}/out/model", "--report", f"{scratch}/report", "--out", f"{scratch}/scores", "--day", DAY])
    assert rows(spark.read.parquet(f"{scratch}/scores")) == rows(spark.read.parquet(f"{scratch}/out/day_predictions"))
    main(["score", "--model", f"{scratch}/out/model", "--report", f"{scratch}/report", "--out", f"{scratch}/streamed",
          "--stream", "--available-now", "--checkpoint", f"{scratch}/ck"])
    assert read_table(spark, f"{scratch}/streamed").count() == frame.report.count()


def frame_of(spark, values):
    return spark.createDataFrame([(float(v) if v is not None else None, 0.0, k % 7) for k, v in enumerate(values)],
                                 "active_power_average double, prediction double, part int")


def brute_bins(values, bins):
    """Exact quantiles: of n sorted values the one in place ceil(n * i / bins)."""
    s = sorted(values)
    cuts = []
    for i in range(1, bins):
        c = s[max(0, -(-len(s) * i // bins) - 1)]
        if c not in cuts:
            cuts.append(c)
    edges = [None, *cuts, None]
    return [(k, lo, hi, sum((lo is None or v >= lo) and (hi is None or v < hi) for v in s))
            for k, (lo, hi) in enumerate(zip(edges, edges[1:]))]


def test_quantile_bins_are_exact_over_few_rows(spark):
    rng = random.Random(1)
    for values in ([rng.gauss(0, 9) for _ in range(150)], [rng.randrange(4) for _ in range(120)], [5.0], [1.0, 1.0]):
        got = ml.residual_quantile_bins(frame_of(spark, [*values, None, float("nan")]), 8).collect()
        assert sorted(map(tuple, got)) == brute_bins(values, 8)
    assert ml.residual_quantile_bins(frame_of(spark, [None]), 8).collect() == []
    assert [tuple(r) for r in ml.residual_quantile_bins(frame_of(spark, [3, 4]), 1).collect()] == [(0, None, None, 2)]


def test_quantile_error_within_the_sketchs_promise(spark):
    n, bins = 60_000, 10
    df = spark.range(n).select(
        (F.pow(F.rand(7) * 3, 9)).alias("active_power_average"), F.lit(0.0).alias("prediction"), (F.col("id") % 24).alias("hour"),
    ).checkpoint()
    values = sorted(r[0] for r in df.select("active_power_average").collect())
    for by in (None, ["hour"]):  # one sketch of all rows, or 24 merged ones
        got = sorted(ml.residual_quantile_bins(df, bins, by=by).collect())
        assert sum(r.n for r in got) == n and len(got) == bins
        for r in got:  # counts over the bounds are exact
            assert r.n == sum((r.lo is None or v >= r.lo) and (r.hi is None or v < r.hi) for v in values)
        import bisect

        for k, r in enumerate(got[1:], 1):
            rank = bisect.bisect_right(values, r.lo) / n
            assert abs(rank - k / bins) <= 2 * ml.SKETCH_RANK_ERROR


def test_sketches_of_parts_merge_later(spark, scratch):
    df = frame_of(spark, range(140))
    ml.residual_sketches(df, ["part"]).write.parquet(f"{scratch}/sketches")
    stored = spark.read.parquet(f"{scratch}/sketches")
    assert stored.count() == 7
    assert sorted(ml.sketch_bounds(stored, 4).collect()) == sorted(ml.sketch_bounds(ml.residual_sketches(df), 4).collect())
