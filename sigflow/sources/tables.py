"""Loading the given parquet tables and shaping them into sigflow inputs.

The given ``events`` table stands in for the sensor feed. Its rows are mapped
column by column (fixed rule, below) to either a raw reading (the CSV/message
layout) or directly to the shaped readings table. ``conversations`` feeds the
text jobs. Every adapter is a projection, so the work grows with the table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigflow.functions.signals import signals_map
from sigflow.schemas import (
    RAW_ACTIVE_POWER,
    RAW_POWER_CURVE,
    RAW_TIME,
    RAW_WIND_DIRECTION,
    RAW_WIND_SPEED,
)

# Fixed audit values for batch adapters (never now(): results must be repeatable).
FIXED_CREATE_TS = _dt.datetime(2024, 2, 1, 0, 0, 0)
# Replays of one feed, as three ingests of the same rows at different times.
REPLAY_CREATE_TS = [
    _dt.datetime(2024, 2, 1, 0, 0, 0),
    _dt.datetime(2024, 2, 2, 6, 30, 0),
    _dt.datetime(2024, 2, 3, 12, 45, 0),
]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Mapping rule events -> signal values (fixed):
#   ActivePower_kW    = value * 12
#   WindSpeed_m_s     = props.k
#   PowerCurve_kWh    = event_id % 3600
#   WindDirection_deg = user_id % 360
def _event_signal_values() -> dict[str, Column]:
    return {
        "ActivePower_kW": F.col("value") * 12,
        "WindSpeed_m_s": F.get_json_object("props", "$.k"),
        "PowerCurve_kWh": F.col("event_id") % 3600,
        "WindDirection_deg": F.col("user_id") % 360,
    }


def events_as_readings(
    events: DataFrame, create_ts: _dt.datetime = FIXED_CREATE_TS
) -> DataFrame:
    """Shaped readings straight from ``events`` (full timestamp precision)."""
    ts = F.col("ts").cast("timestamp")
    created = F.lit(create_ts).cast("timestamp")
    return events.select(
        F.to_date(ts).alias("signal_date"),
        ts.alias("signal_ts"),
        F.to_date(created).alias("create_date"),
        created.alias("create_ts"),
        signals_map(_event_signal_values()).alias("signals"),
    )


def replayed_readings(events: DataFrame, create_times=REPLAY_CREATE_TS) -> DataFrame:
    """The same feed ingested once per ``create_times`` entry (a replay log).

    One scan of ``events``: each row is emitted once per ingest time.
    """
    readings = events_as_readings(events).drop("create_date", "create_ts")
    ingests = F.explode(F.array(*[F.lit(ts).cast("timestamp") for ts in create_times]))
    replayed = readings.select("*", ingests.alias("create_ts"))
    return replayed.select(
        "signal_date", "signal_ts", F.to_date("create_ts").alias("create_date"), "create_ts", "signals"
    )


def events_as_raw(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Raw readings (CSV layout): ``dd MM yyyy HH:mm`` text and four doubles,
    after the ``keep`` columns of ``events``."""
    v = _event_signal_values()
    return events.select(
        *(keep or []),
        F.date_format("ts", "dd MM yyyy HH:mm").alias(RAW_TIME),
        v["ActivePower_kW"].cast("double").alias(RAW_ACTIVE_POWER),
        v["WindSpeed_m_s"].cast("double").alias(RAW_WIND_SPEED),
        v["PowerCurve_kWh"].cast("double").alias(RAW_POWER_CURVE),
        v["WindDirection_deg"].cast("double").alias(RAW_WIND_DIRECTION),
    )


def events_time_text(events: DataFrame) -> DataFrame:
    """Event times written in the forms the lenient feed parser accepted.

    Form by ``event_id % 4``: 0 zero-padded; 1 unpadded day, month, hour and
    minute; 2 leading blank and trailing seconds; 3 bare date.
    """
    ts = F.col("ts")
    unpadded = F.concat_ws(
        " ",
        F.dayofmonth(ts).cast("string"),
        F.month(ts).cast("string"),
        F.year(ts).cast("string"),
        F.concat(F.hour(ts).cast("string"), F.lit(":"), F.minute(ts).cast("string")),
    )
    form = F.col("event_id") % 4
    text = (
        F.when(form == 0, F.date_format(ts, "dd MM yyyy HH:mm"))
        .when(form == 1, unpadded)
        .when(form == 2, F.concat(F.lit(" "), F.date_format(ts, "dd MM yyyy HH:mm:ss")))
        .otherwise(F.date_format(ts, "dd MM yyyy"))
    )
    return events.select("event_id", text.alias("raw_time"))


def order_notes(lineitem: DataFrame) -> DataFrame:
    """A note per order, as a chat assistant writes one: prose with up to two JSON arrays
    of records, the returned items and the others, and brackets and quotes that
    belong to neither. An order has a handful of items."""
    record = F.struct(
        F.col("l_linenumber").alias("line"),
        F.struct(
            F.concat(F.lit("part ["), F.col("l_partkey").cast("string"), F.lit("]")).alias("name"),
            F.col("l_quantity").cast("int").cast("string").alias("capacity"),
            F.col("l_linenumber").alias("rating"),
            F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string"))).alias("phone"),
        ).alias("v"),
    )
    returned = F.col("l_returnflag") == "R"
    lists = {n: F.transform(F.sort_array(F.collect_list(F.when(c, record))), lambda r: r.v) for n, c in (("a", returned), ("b", ~returned))}
    orders = lineitem.groupBy("l_orderkey").agg(*[v.alias(k) for k, v in lists.items()])
    text = F.concat(
        F.lit('Returned [see 1], the 12" ones:\n'), F.to_json("a"), F.lit("\nnot returned: "), F.to_json("b"), F.lit(" [end")
    )
    return orders.select("l_orderkey", text.alias("text"))


def messages_with_junk(events: DataFrame, conversations: DataFrame, labels: DataFrame) -> DataFrame:
    """A feed as brokers deliver it: readings as messages, their times in the forms of
    :func:`events_time_text` (a bare date has no time of day), among messages
    that are no JSON (the turns' roles) and JSON of other jobs (the labels)."""
    raw = events_as_raw(events, keep=["event_id"]).drop(RAW_TIME)
    timed = raw.join(events_time_text(events).withColumnRenamed("raw_time", RAW_TIME), "event_id")
    fields = [RAW_TIME, *(c for c in raw.columns if c != "event_id")]
    readings = timed.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields])).alias("value"))
    other = labels.select(F.to_json(F.struct("doc_id", "quality", "toxic")).alias("value"))
    return readings.unionByName(other).unionByName(conversations.select(F.col("role").alias("value")))


def lineitem_regression_frame(lineitem: DataFrame) -> DataFrame:
    """Numeric frame for regression at scale: price from quantity, discount, tax."""
    return lineitem.select(
        F.col("l_extendedprice").alias("label"),
        "l_quantity",
        "l_discount",
        "l_tax",
    )
