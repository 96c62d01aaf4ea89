"""Command-line entry points for the stages.

    python -m sigflow.cli publish --csv-dir D --out M [--seconds N]
    python -m sigflow.cli consume --messages M --lake L [--partition-by-date] [--taps]
    python -m sigflow.cli report  --lake L --out R [--cast float|double]
    python -m sigflow.cli model   --report R --out O [--day YYYY-MM-DD]
    python -m sigflow.cli score   --model O/model --report R --out S [--day YYYY-MM-DD | --stream]
    python -m sigflow.cli compact --lake L [--ended] [--drop]

Streaming stages run until stopped, or for ``--seconds``, or with
``--available-now`` (all current input, then stop). Checkpoints default to
folders under the session's ``spark.checkpoint.dir`` (``--checkpoint-root``
where the cluster names none), one per stage, source and target. ``--kafka
HOST:PORT --topic T`` swaps message files for a Kafka topic (connector jar
required). Micro-batches are sized with ``--max-files-per-trigger`` or
``--max-offsets-per-trigger`` and paced with ``--every``.
"""

from __future__ import annotations

import argparse
import logging

from sigflow.session import build_session, stream_checkpoint
from sigflow.streaming.control import stop_all

log = logging.getLogger("sigflow")


def _trigger(args) -> dict | None:
    if args.available_now:
        return {"availableNow": True}
    return {"processingTime": args.every} if args.every else None


def _finish(spark, query, args) -> None:
    from sigflow.streaming.control import run_for, run_to_completion, run_until_stopped

    if args.available_now:
        run_to_completion(query)
    elif args.seconds:
        run_for(query, args.seconds)
    else:
        run_until_stopped(spark, query)


def cmd_publish(spark, args) -> None:
    from sigflow.streaming.ingest import start_publish_csv

    fmt = "kafka" if args.kafka else "text"
    target = args.out or f"{args.kafka}/{args.topic}"
    q = start_publish_csv(
        spark, args.csv_dir, args.checkpoint or stream_checkpoint(spark, "publish", args.csv_dir, target),
        max_files_per_trigger=args.max_files_per_trigger,
        out_path=args.out, fmt=fmt, bootstrap=args.kafka, topic=args.topic,
        glob=None if args.all_files else "*.csv", trigger=_trigger(args),
    )
    _finish(spark, q, args)


def cmd_consume(spark, args) -> None:
    from sigflow.streaming.ingest import readings_stream, start_consume, start_consume_split, start_raw_tap
    from sigflow.streaming.sinks import start_console

    fmt = "kafka" if args.kafka else "text"
    source_opts = {"bootstrap": args.kafka, "topic": args.topic} if args.kafka else {}
    if args.max_offsets_per_trigger:
        source_opts["options"] = {"maxOffsetsPerTrigger": str(args.max_offsets_per_trigger)}
    source_opts["max_files_per_trigger"] = args.max_files_per_trigger
    source = args.messages or f"{args.kafka}/{args.topic}"
    ck = args.checkpoint or stream_checkpoint(spark, "consume", source, args.lake)
    if args.raw_tap:
        start_raw_tap(spark, args.messages, fmt=fmt, trigger=_trigger(args), **source_opts)
    if args.taps:
        start_console(readings_stream(spark, args.messages, fmt=fmt, **source_opts), trigger=_trigger(args))
    options = {
        "fmt": fmt, "lake_format": args.lake_format, "partition_by": ["signal_date"] if args.partition_by_date else None,
        "trigger": _trigger(args), "typed_casts": tuple(args.typed.split(",")) if args.typed else None, **source_opts,
    }
    if args.rejected:
        q = start_consume_split(spark, args.messages, args.lake, args.rejected, ck, **options)
    elif args.distinct:
        from sigflow.streaming.arrivals import start_first_arrivals

        readings = readings_stream(spark, args.messages, fmt=fmt, **source_opts)
        q = start_first_arrivals(readings, args.lake, ck, options["partition_by"], trigger=_trigger(args))
    else:
        q = start_consume(spark, args.messages, args.lake, ck, sink=args.sink, **options)
    _finish(spark, q, args)


def cmd_report(spark, args) -> None:
    from sigflow.operators.aggregate import distinct_signals_daily
    from sigflow.plans.analysis import hourly_report
    from sigflow.sources.lake import read_lake, write_lake

    readings = read_lake(spark, args.lake, args.lake_format)
    write_lake(hourly_report(readings, cast=args.cast, zone=args.zone), args.out, fmt=args.lake_format)
    if args.daily_out:
        write_lake(distinct_signals_daily(readings), args.daily_out, fmt=args.lake_format)


def cmd_model(spark, args) -> None:
    from sigflow.operators.ml import fit_label_index, regression_metrics, residual_histogram
    from sigflow.plans.modeling import ModelFrame, fit_on_split, model_coefficients, predict_day, save_model
    from sigflow.sources.lake import read_lake, write_lake

    report = read_lake(spark, args.report, args.lake_format)
    frame = ModelFrame(report, fit_label_index(report))
    model, test = fit_on_split(frame)
    scored = model.transform(test)
    save_model(frame, model, f"{args.out}/model")
    write_lake(model_coefficients(model), f"{args.out}/coefficients")
    write_lake(regression_metrics(scored), f"{args.out}/metrics")
    write_lake(residual_histogram(scored, args.bin_width), f"{args.out}/residuals")
    write_lake(predict_day(model, frame, args.day), f"{args.out}/day_predictions")


def cmd_score(spark, args) -> None:
    from sigflow.operators.ml import load_pipeline
    from sigflow.plans.modeling import score_report, start_scoring
    from sigflow.sources.lake import read_lake, write_lake

    pipeline = load_pipeline(args.model)
    report = read_lake(spark, args.report, args.lake_format)
    if not args.stream:
        write_lake(score_report(pipeline, report, args.day), args.out, fmt=args.lake_format)
        return
    rows = spark.readStream.schema(report.schema).format(args.lake_format)
    if args.max_files_per_trigger:
        rows = rows.option("maxFilesPerTrigger", args.max_files_per_trigger)
    ck = args.checkpoint or stream_checkpoint(spark, "score", args.report, args.out)
    _finish(spark, start_scoring(pipeline, rows.load(args.report), args.out, ck, trigger=_trigger(args)), args)


def cmd_compact(spark, args) -> None:
    from sigflow.sources.generations import compact, drop_covered

    log.info("generation %s", compact(spark, args.lake, ended=args.ended))
    if args.drop:
        log.info("%d batch folders removed", drop_covered(spark, args.lake))


def main(argv=None, stop: bool = False) -> None:
    """Run one stage. A failure is logged and re-raised; with ``stop`` the
    session is stopped afterwards either way (the command-line default)."""
    p = argparse.ArgumentParser(prog="sigflow")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=None)
    p.add_argument("--lake-format", default="parquet")
    p.add_argument("--checkpoint-root", default=None, help="shared folder, where spark.checkpoint.dir is not set")
    sub = p.add_subparsers(dest="cmd", required=True)

    def streaming(sp):
        sp.add_argument("--checkpoint", default=None)
        sp.add_argument("--available-now", action="store_true")
        sp.add_argument("--seconds", type=float, default=None)
        sp.add_argument("--every", default=None, help='micro-batch interval, e.g. "10 seconds"')
        sp.add_argument("--max-files-per-trigger", type=int, default=None)
        sp.add_argument("--kafka", default=None)
        sp.add_argument("--topic", default=None)

    sp = sub.add_parser("publish")
    sp.add_argument("--csv-dir", required=True)
    sp.add_argument("--out", default=None)
    sp.add_argument("--all-files", action="store_true", help="read every file, not only *.csv")
    streaming(sp)

    sp = sub.add_parser("consume")
    sp.add_argument("--messages", default=None)
    sp.add_argument("--lake", required=True)
    sp.add_argument("--partition-by-date", action="store_true")
    sp.add_argument("--max-offsets-per-trigger", type=int, default=None)
    sp.add_argument("--taps", action="store_true", help="print shaped readings")
    sp.add_argument("--raw-tap", action="store_true", help="print messages as they arrive")
    sp.add_argument("--sink", default="batches", choices=["batches", "table"])
    sp.add_argument("--typed", default=None, help="also write typed signal copies, e.g. float,double")
    sp.add_argument("--rejected", default=None, help="table for messages that give no reading with a time")
    sp.add_argument("--distinct", action="store_true", help="add each reading once, whatever is replayed")
    streaming(sp)

    sp = sub.add_parser("report")
    sp.add_argument("--lake", required=True)
    sp.add_argument("--out", required=True)
    sp.add_argument("--daily-out", default=None)
    sp.add_argument("--cast", default="float", choices=["float", "double"])
    sp.add_argument("--zone", default=None, help="time zone for hours, e.g. Asia/Kolkata (default: session)")

    sp = sub.add_parser("model")
    sp.add_argument("--report", required=True)
    sp.add_argument("--out", required=True)
    sp.add_argument("--day", default="2018-01-19")
    sp.add_argument("--bin-width", type=float, default=100.0)

    sp = sub.add_parser("score")
    sp.add_argument("--model", required=True)
    sp.add_argument("--report", required=True)
    sp.add_argument("--out", required=True)
    sp.add_argument("--day", default=None, help="only this day (not with --stream)")
    sp.add_argument("--stream", action="store_true", help="follow the report's files")
    streaming(sp)

    sp = sub.add_parser("compact")
    sp.add_argument("--lake", required=True)
    sp.add_argument("--ended", action="store_true", help="no query will write again: compact the newest batches too")
    sp.add_argument("--drop", action="store_true", help="remove the batch folders that were compacted")

    args = p.parse_args(argv)
    spark = build_session(args.master, app_name=f"sigflow-{args.cmd}",
                          shuffle_partitions=args.shuffle_partitions,
                          delta=args.lake_format == "delta", checkpoint_dir=args.checkpoint_root)
    command = {
        "publish": cmd_publish, "consume": cmd_consume, "report": cmd_report, "model": cmd_model,
        "score": cmd_score, "compact": cmd_compact,
    }
    try:
        command[args.cmd](spark, args)
    except Exception:
        log.critical("sigflow %s failed", args.cmd, exc_info=True)
        raise
    finally:
        if stop:
            stop_all(spark)
            spark.stop()


if __name__ == "__main__":
    main(stop=True)
