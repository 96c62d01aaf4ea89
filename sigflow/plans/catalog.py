"""Registered queries over the given tables, with DuckDB oracle SQL.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables. The
oracle SQL computes the same result from the same parquet tables; output
column names match exactly. Queries without an oracle are checked by tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigflow.functions.messages import row_to_json
from sigflow.functions.signals import flatten_signals, signal_value
from sigflow.functions.timeparse import parse_signal_date, parse_signal_ts
from sigflow.operators import aggregate as agg
from sigflow.operators import ml
from sigflow.operators import text
from sigflow.operators.mapping import mapping_join_long, signal_mapping
from sigflow.operators.quality import dedup_latest, ingest_audit
from sigflow.operators.shape import (
    flatten_messages,
    messages_to_readings,
    pack_messages,
    parse_messages,
)
from sigflow.plans import modeling, streams, venues
from sigflow.plans.analysis import hourly_indicator, hourly_report
from sigflow.schemas import LR_FEATURES, LR_LABEL, RAW_FIELDS, SIGNAL_KEYS
from sigflow.session import ensure_checkpoint_dir
from sigflow.sources.generations import read_table
from sigflow.sources.tables import (
    FIXED_CREATE_TS,
    events_as_raw,
    events_as_readings,
    events_time_text,
    lineitem_regression_frame,
    load_table,
    order_notes,
    replayed_readings,
)
from sigflow.streaming.control import run_to_completion

Query = Callable[[SparkSession, str], DataFrame]

# Day scored in the day filter: the given events cover January 2024.
EVENTS_DAY = "2024-01-19"
# Bin width (kW) for residual and scatter summaries.
BIN_WIDTH = 100.0

_READING_COLS = ["signal_date", "signal_ts", "create_date", "create_ts"]


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_readings(load_table(spark, sf_dir, "events"))


def _flat(readings: DataFrame) -> DataFrame:
    return readings.select(*_READING_COLS, *flatten_signals())


# --- sources, projections, parsing ------------------------------------------

def q_scan_readings(spark, sf_dir):
    return _flat(_readings(spark, sf_dir))


def q_parse_event_time(spark, sf_dir):
    text = events_time_text(load_table(spark, sf_dir, "events"))
    return text.select(
        "event_id",
        "raw_time",
        parse_signal_date("raw_time").alias("signal_date"),
        parse_signal_ts("raw_time").alias("signal_ts"),
    )


def q_signal_lookup(spark, sf_dir):
    readings = _readings(spark, sf_dir)
    return readings.select(
        "signal_ts", *[signal_value(k, "double").alias(f"{k}_value") for k in SIGNAL_KEYS]
    )


def q_row_to_json(spark, sf_dir):
    raw = events_as_raw(load_table(spark, sf_dir, "events"), keep=["event_id"])
    return raw.select("event_id", row_to_json(raw, RAW_FIELDS).alias("value"))


def q_json_parse(spark, sf_dir):
    msgs = pack_messages(events_as_raw(load_table(spark, sf_dir, "events")))
    data = parse_messages(msgs)
    return data.select(
        F.col("data.`Date/Time`").alias("date_time"),
        F.col("data.`LV ActivePower (kW)`").alias("active_power"),
        F.col("data.`Wind Speed (m/s)`").alias("wind_speed"),
        F.col("data.`Theoretical_Power_Curve (KWh)`").alias("power_curve"),
        F.col("data.`Wind Direction (°)`").alias("wind_direction"),
    )


def q_shape_signals(spark, sf_dir):
    msgs = pack_messages(events_as_raw(load_table(spark, sf_dir, "events")))
    return _flat(messages_to_readings(msgs, create_ts=FIXED_CREATE_TS))


def q_json_flatten(spark, sf_dir):
    events = load_table(spark, sf_dir, "events")
    msgs = events.select(
        F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), "value")).alias("value")
    )
    return flatten_messages(msgs)


# --- aggregations and the analysis report ------------------------------------

def q_distinct_signals_daily(spark, sf_dir):
    return agg.distinct_signals_daily(_readings(spark, sf_dir))


def q_avg_signals_hourly(spark, sf_dir):
    return agg.avg_signals_hourly(_readings(spark, sf_dir), cast="float")


def q_avg_signals_hourly_double(spark, sf_dir):
    return agg.avg_signals_hourly(_readings(spark, sf_dir), cast="double")


def q_avg_signals_hourly_zone(spark, sf_dir):
    """Hourly means by the wall clock of a zone half an hour off the full hours."""
    return agg.avg_signals_hourly(_readings(spark, sf_dir), cast="double", zone="Asia/Kolkata")


def q_generation_indicator(spark, sf_dir):
    return hourly_indicator(_readings(spark, sf_dir), cast="float")


def q_rename_mapped(spark, sf_dir):
    return hourly_report(_readings(spark, sf_dir), cast="float")


def q_mapping_join_long(spark, sf_dir):
    hourly = agg.avg_signals_hourly(_readings(spark, sf_dir), cast="float")
    return mapping_join_long(hourly, signal_mapping(spark, view=None), ["signal_date", "hour"])


def q_day_filter(spark, sf_dir):
    report = hourly_report(_readings(spark, sf_dir), cast="float")
    return report.filter(F.col("signal_date") == F.lit(EVENTS_DAY).cast("date"))


def q_row_count(spark, sf_dir):
    return agg.row_count(agg.avg_signals_hourly(_readings(spark, sf_dir), cast="double"))


# --- replay removal and audit --------------------------------------------------

def q_dedup_latest(spark, sf_dir):
    return _flat(dedup_latest(replayed_readings(load_table(spark, sf_dir, "events"))))


def q_ingest_audit(spark, sf_dir):
    return ingest_audit(replayed_readings(load_table(spark, sf_dir, "events")))


# --- model inputs and evaluation -------------------------------------------------

def _ml_report(spark, sf_dir):
    return hourly_report(_readings(spark, sf_dir), cast="double")


def q_label_index(spark, sf_dir):
    indexed = modeling.ml_frame(_readings(spark, sf_dir)).indexed()
    return indexed.select("signal_date", "hour", "generation_mapping", "generation_status_index")


def q_drop_invalid_features(spark, sf_dir):
    indexed = modeling.ml_frame(_readings(spark, sf_dir)).indexed()
    return ml.drop_invalid_features(indexed).select("signal_date", "hour", LR_LABEL, *LR_FEATURES)


def q_hash_split(spark, sf_dir):
    report = _ml_report(spark, sf_dir)
    return ml.hash_split(report, ["signal_date", "hour"]).select("signal_date", "hour", "is_train")


def q_regression_metrics(spark, sf_dir):
    # The theoretical power curve is the physical predictor of active power.
    predicted = _ml_report(spark, sf_dir).withColumn("prediction", F.col("theo_power_curve_average"))
    return ml.regression_metrics(predicted)


# --- model fit and scoring -------------------------------------------------------
# The split follows the row key's hash, so SQL can solve the same normal
# equations; figures are rounded past the digits in which two solvers agree.

DIGITS = 4


def _rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, DIGITS) for c in doubles})


def _fitted(spark, sf_dir):
    ml_df = modeling.ml_frame(_readings(spark, sf_dir))
    model, test = modeling.fit_on_split(ml_df, key_cols=["signal_date", "hour"])
    return ml_df, model, test


def _scored_test(spark, sf_dir):
    _, model, test = _fitted(spark, sf_dir)
    return model.transform(test)


def q_lr_fit(spark, sf_dir):
    _, model, _ = _fitted(spark, sf_dir)
    return _rounded(modeling.model_coefficients(model))


def q_lr_predict_day(spark, sf_dir):
    ml_df, model, _ = _fitted(spark, sf_dir)
    return _rounded(modeling.predict_day(model, ml_df, EVENTS_DAY))


def q_lr_score_saved(spark, sf_dir):
    """Scores of the model after it was saved and loaded: one day in a batch, and the whole report as a stream."""
    base = streams.run_folder(spark, "model")
    ml_df, model, _ = _fitted(spark, sf_dir)
    modeling.save_model(ml_df, model, f"{base}/model")
    pipeline = ml.load_pipeline(f"{base}/model")
    day = modeling.score_report(pipeline, ml_df.report, EVENTS_DAY).select(F.lit("batch").alias("run"), "*")
    ml_df.report.write.parquet(f"{base}/report")
    report = spark.readStream.schema(ml_df.report.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/report")
    run_to_completion(modeling.start_scoring(
        pipeline, report, f"{base}/scores", f"{base}/ck", trigger=streams.AVAILABLE_NOW))
    streamed = read_table(spark, f"{base}/scores").drop("app_id", "batch_id").select(F.lit("stream").alias("run"), "*")
    return day.unionByName(streamed).withColumn("prediction", F.round("prediction", DIGITS))


def q_lr_evaluate(spark, sf_dir):
    return _rounded(ml.regression_metrics(_scored_test(spark, sf_dir)))


def q_residual_histogram(spark, sf_dir):
    return ml.residual_histogram(_scored_test(spark, sf_dir), BIN_WIDTH)


def q_residual_quantiles(spark, sf_dir):
    """Residuals of the test part in ten bins of about equal counts, the bounds from a quantile sketch."""
    return _rounded(ml.residual_quantile_bins(_scored_test(spark, sf_dir), 10))


def q_scatter_bins(spark, sf_dir):
    return ml.scatter_bins(_scored_test(spark, sf_dir), BIN_WIDTH)


def q_lr_fit_lineitem(spark, sf_dir):
    frame = lineitem_regression_frame(load_table(spark, sf_dir, "lineitem"))
    features = ["l_quantity", "l_discount", "l_tax"]
    model = ml.fit_linear_regression(ml.assemble_features(frame, features), label="label")
    return _rounded(ml.coefficients_frame(spark, model, features))


# --- text jobs over conversations and documents -------------------------------

# A keyword list that occurs in the given (multilingual) conversation texts.
DATA_KEYWORDS = ["with", "und", "que"]


def _turns(spark, sf_dir):
    return load_table(spark, sf_dir, "conversations")


def _joined(df: DataFrame) -> DataFrame:
    """Array columns as '|'-joined text, for engine-neutral comparison."""
    return df.withColumns({c: F.array_join(c, "|") for c in ("amenities", "features")})


def q_drop_blank_turns(spark, sf_dir):
    return text.drop_blank_turns(_turns(spark, sf_dir))


def q_last_user_turn(spark, sf_dir):
    return text.last_user_turn(_turns(spark, sf_dir))


def q_route_intent(spark, sf_dir):
    return text.route_intent(_turns(spark, sf_dir))


def q_route_intent_keywords(spark, sf_dir):
    return text.route_intent(_turns(spark, sf_dir), keywords=DATA_KEYWORDS)


def q_extract_json_array(spark, sf_dir):
    docs = text.extract_json_array(load_table(spark, sf_dir, "documents"))
    return docs.select("doc_id", F.size("venues").alias("venue_count"))


def q_json_arrays(spark, sf_dir):
    """Records of all JSON arrays in a note per order (two arrays in most of them), normalised."""
    notes = text.extract_json_arrays(order_notes(load_table(spark, sf_dir, "lineitem")))
    lists = notes.select("l_orderkey", F.posexplode_outer("venue_lists").alias("list_no", "venues"))
    return _joined(text.normalise_records(lists, ["l_orderkey", "list_no"]))


def q_normalise_records(spark, sf_dir):
    return _joined(venues.venue_records(_turns(spark, sf_dir)))


def q_cap_items(spark, sf_dir):
    return venues.articles(_turns(spark, sf_dir)).select("conv_id", "turn")


def q_search_key(spark, sf_dir):
    return venues.request_keys(_turns(spark, sf_dir))


def q_fallback_record(spark, sf_dir):
    return _joined(venues.venue_results(_turns(spark, sf_dir)))


def _prepared(fn: Query) -> Query:
    """Run a query in the session settings its results depend on: hours and
    dates are read in UTC, and lineage cuts need the shared checkpoint root."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {
    "scan_readings": q_scan_readings,
    "parse_event_time": q_parse_event_time,
    "signal_lookup": q_signal_lookup,
    "row_to_json": q_row_to_json,
    "json_parse": q_json_parse,
    "shape_signals": q_shape_signals,
    "json_flatten": q_json_flatten,
    "distinct_signals_daily": q_distinct_signals_daily,
    "avg_signals_hourly": q_avg_signals_hourly,
    "avg_signals_hourly_double": q_avg_signals_hourly_double,
    "avg_signals_hourly_zone": q_avg_signals_hourly_zone,
    "generation_indicator": q_generation_indicator,
    "rename_mapped": q_rename_mapped,
    "mapping_join_long": q_mapping_join_long,
    "day_filter": q_day_filter,
    "row_count": q_row_count,
    "dedup_latest": q_dedup_latest,
    "ingest_audit": q_ingest_audit,
    "label_index": q_label_index,
    "drop_invalid_features": q_drop_invalid_features,
    "hash_split": q_hash_split,
    "regression_metrics": q_regression_metrics,
    "residual_histogram": q_residual_histogram,
    "residual_quantiles": q_residual_quantiles,
    "scatter_bins": q_scatter_bins,
    "lr_fit": q_lr_fit,
    "lr_predict_day": q_lr_predict_day,
    "lr_score_saved": q_lr_score_saved,
    "lr_evaluate": q_lr_evaluate,
    "lr_fit_lineitem": q_lr_fit_lineitem,
    "drop_blank_turns": q_drop_blank_turns,
    "last_user_turn": q_last_user_turn,
    "route_intent": q_route_intent,
    "route_intent_keywords": q_route_intent_keywords,
    "extract_json_array": q_extract_json_array,
    "json_arrays": q_json_arrays,
    "normalise_records": q_normalise_records,
    "cap_items": q_cap_items,
    "search_key": q_search_key,
    "fallback_record": q_fallback_record,
    "stream_ingest": streams.q_stream_ingest,
    "stream_hourly": streams.q_stream_hourly,
    "stream_replay": streams.q_stream_replay,
    "stream_fanout": streams.q_stream_fanout,
    "dedup_first": streams.q_dedup_first,
    "stream_quarantine": streams.q_stream_quarantine,
    "stream_audit": streams.q_stream_audit,
    "lake_compacted": streams.q_lake_compacted,
    "lake_as_of": streams.q_lake_as_of,
    "save_processed": streams.q_save_processed,
}
QUERIES = {k: _prepared(v) for k, v in QUERIES.items()}
