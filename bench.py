"""Benchmark the headline jobs; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5, after 1 warm-up). Each batch query is forced to run
in full through the no-op sink; the figure per query is the median.

As in the original application, analytics read the readings table that
ingest wrote: setup lands ``events`` as that table (and a three-ingest replay
of it, and a copy with typed signal columns) once, as multi-file parquet;
``lineitem`` is landed the same way for the regression. Ingest itself is timed separately
(``shape_signals`` batch, ``stream_ingest`` streaming).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from sigflow.session import build_session  # noqa: E402


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    shuffle = cpus
    spark = build_session(f"local[{cpus}]", app_name="sigflow-bench", shuffle_partitions=shuffle,
                          extra_conf={"spark.driver.memory": "8g"},
                          checkpoint_dir=tempfile.mkdtemp(prefix="sigflow-bench-"))

    from sigflow.operators import aggregate, ml
    from sigflow.operators.mapping import mapping_join_long, signal_mapping
    from sigflow.operators.quality import dedup_latest, ingest_audit
    from sigflow.operators.shape import messages_to_readings, pack_messages, with_typed_signals
    from sigflow.plans import catalog, modeling, streams
    from sigflow.plans.analysis import hourly_report
    from sigflow.sources.lake import read_lake
    from sigflow.sources.messages import read_messages
    from sigflow.sources.tables import (
        events_as_raw,
        events_as_readings,
        lineitem_regression_frame,
        load_table,
        replayed_readings,
    )
    from sigflow.streaming.control import run_to_completion
    from sigflow.streaming.ingest import start_consume

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = streams.run_folder(spark, "bench")
    events = load_table(spark, sf_dir, "events")
    events_as_readings(events).repartition(cpus).write.parquet(f"{base}/readings")
    replayed_readings(events).repartition(cpus).write.parquet(f"{base}/replayed")
    with_typed_signals(events_as_readings(events)).repartition(cpus).write.parquet(f"{base}/typed")
    lake = read_lake(spark, f"{base}/readings")
    typed_lake = read_lake(spark, f"{base}/typed")
    replayed = read_lake(spark, f"{base}/replayed")
    # message files as the publish leg writes them (one JSON object per line)
    pack_messages(events_as_raw(events)).repartition(cpus).write.text(f"{base}/messages")

    def lr_fit():
        frame = modeling.ml_frame(lake)
        model, test = modeling.fit_on_split(frame)
        ml.regression_metrics(model.transform(test)).collect()

    load_table(spark, sf_dir, "lineitem").repartition(cpus).write.parquet(f"{base}/lineitem")
    lineitem = read_lake(spark, f"{base}/lineitem")

    def lr_fit_lineitem():
        features = ["l_quantity", "l_discount", "l_tax"]
        frame = ml.assemble_features(lineitem_regression_frame(lineitem), features)
        ml.fit_linear_regression(frame, label="label")

    batch = {
        "hourly_means": lambda: run_noop(aggregate.avg_signals_hourly(lake, cast="float")),
        "hourly_means_double": lambda: run_noop(aggregate.avg_signals_hourly(lake, cast="double")),
        "hourly_means_typed": lambda: run_noop(aggregate.avg_signals_hourly(typed_lake, cast="float")),
        "distinct_count": lambda: run_noop(aggregate.distinct_signals_daily(lake)),
        "band_rename": lambda: run_noop(hourly_report(lake)),
        "replay_removal": lambda: run_noop(dedup_latest(replayed)),
        "ingest_audit": lambda: run_noop(ingest_audit(replayed)),
        "mapping_join_long": lambda: run_noop(mapping_join_long(
            aggregate.avg_signals_hourly(lake), signal_mapping(spark, view=None), ["signal_date", "hour"])),
        "shape_messages": lambda: run_noop(messages_to_readings(read_messages(spark, f"{base}/messages"))),
        "route_intent": lambda: run_noop(catalog.q_route_intent(spark, sf_dir)),
        "venue_results": lambda: run_noop(catalog.q_fallback_record(spark, sf_dir)),
        "lr_fit": lr_fit,
        "lr_fit_lineitem": lr_fit_lineitem,
    }
    results: dict[str, float] = {}
    for name, fn in batch.items():
        fn()  # warm-up
        results[name] = statistics.median(timed(fn) for _ in range(runs))

    # Streaming ingest: message files -> shaped readings -> parquet lake
    # (availableNow). The message files are landed once; every run uses a new
    # checkpoint and output folder. The first run is the cold figure.
    rows = events.count()
    stream_times = []
    for i in range(runs + 1):
        q = lambda i=i: run_to_completion(start_consume(
            spark, f"{base}/messages", f"{base}/lake{i}", f"{base}/ck{i}", trigger={"availableNow": True}))
        stream_times.append(timed(q))
    cold, warm = stream_times[0], statistics.median(stream_times[1:])
    results["stream_ingest"] = warm

    out = {
        "metric": "sum_of_median_query_sec",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in results.items()},
        "sf": float(re.search(r"sf([0-9.]+)", sf_dir).group(1)) if re.search(r"sf([0-9.]+)", sf_dir) else None,
        "cpus": cpus,
        "shuffle_partitions": shuffle,
        "runs": runs,
        "stream_rows": rows,
        "stream_rows_per_sec_warm": round(rows / warm, 1),
        "stream_rows_per_sec_cold": round(rows / cold, 1),
        "stream_cold_sec": round(cold, 4),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
