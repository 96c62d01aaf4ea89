"""Message packing, parsing and shaping into the readings table.

The same functions serve bounded and unbounded frames: a stream is shaped
by exactly the code that shapes a batch.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sigflow.functions.messages import parse_message, row_to_json
from sigflow.functions.signals import signal_value, signals_map, typed_column
from sigflow.functions.timeparse import parse_signal_date, parse_signal_ts
from sigflow.schemas import (
    GENERIC_MESSAGE_SCHEMA,
    MESSAGE_SCHEMA,
    RAW_TIME,
    READINGS_SCHEMA,
    SIGNAL_KEYS,
    SIGNAL_SOURCES,
)


# Text that JSON parsing reads as no value at all.
JSON_BLANK = r"^[ \t\n\r]*\z"


def pack_messages(raw: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One ``value`` column: each row as a JSON object (null fields left out)."""
    return raw.select(row_to_json(raw, columns).alias("value"))


def parse_messages(
    messages: DataFrame, schema: StructType = MESSAGE_SCHEMA, strict: bool = False
) -> DataFrame:
    """``data`` struct per message, keeping messages whose struct is not null.

    Malformed text still yields a struct (of nulls) and is kept, as in the
    original consumer; ``strict=True`` also requires a time field.
    """
    # The struct is null exactly for a null message and for one holding only
    # JSON whitespace. Testing the text says the same without parsing: a
    # filter on the parsed struct would be pushed below the projection and
    # parse every message a second time.
    text = F.col("value").cast("string")
    present = messages.filter(text.isNotNull() & ~text.rlike(JSON_BLANK))
    parsed = present.select(parse_message("value", schema).alias("data"))
    if strict:
        parsed = parsed.filter(F.col(f"data.`{RAW_TIME}`").isNotNull())
    return parsed


def shape_readings(
    parsed: DataFrame, create_ts: _dt.datetime | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Readings table from parsed messages, after the ``keep`` columns.

    ``create_date``/``create_ts`` default to ``current_date()`` /
    ``current_timestamp()``, which a stream fixes once per micro-batch; pass a
    value for repeatable batch output.
    """
    raw_time = F.col(f"data.`{RAW_TIME}`")
    if create_ts is None:
        create_date_col, create_ts_col = F.current_date(), F.current_timestamp()
    else:
        create_date_col = F.lit(create_ts.date())
        create_ts_col = F.lit(create_ts).cast("timestamp")
    # The time is parsed once; when it parses, its date is the text's date, so
    # the date pattern is only tried on rows without a time (bare dates, junk).
    staged = parsed.select(*dict.fromkeys([*(keep or []), "data"]), parse_signal_ts(raw_time).alias("signal_ts"))
    return staged.select(
        *(keep or []),
        F.coalesce(F.to_date("signal_ts"), parse_signal_date(raw_time)).alias("signal_date"),
        "signal_ts",
        create_date_col.alias("create_date"),
        create_ts_col.alias("create_ts"),
        signals_map({k: F.col(f"data.`{src}`") for k, src in SIGNAL_SOURCES.items()}).alias(
            "signals"
        ),
    )


# Why a message gave no reading with a time.
BLANK, NOT_AN_OBJECT, NO_TIME, UNREADABLE_TIME = "blank", "not a JSON object", "no time", "unreadable time"
_CORRUPT = "_corrupt_record"


def judge_messages(messages: DataFrame, create_ts: _dt.datetime | None = None) -> DataFrame:
    """Every message with its reading and why it is none: the readings columns,
    ``value`` and ``reason``. The reason is null exactly where the reading has a
    time; no message is left out, also not the null and blank ones that
    :func:`parse_messages` drops. Each message is parsed once."""
    text = F.col("value").cast("string")
    schema = StructType([*MESSAGE_SCHEMA.fields, StructField(_CORRUPT, StringType())])
    parsed = messages.select(
        text.alias("value"), F.from_json(text, schema, {"columnNameOfCorruptRecord": _CORRUPT}).alias("data")
    )
    raw_time = F.col(f"data.`{RAW_TIME}`")
    shaped = shape_readings(parsed, create_ts, keep=["value", "data"])
    reason = (
        F.when(F.col("signal_ts").isNotNull(), F.lit(None))
        .when(F.col("data").isNull(), BLANK)
        .when(F.col(f"data.{_CORRUPT}").isNotNull(), NOT_AN_OBJECT)
        .when(raw_time.isNull(), NO_TIME)
        .otherwise(UNREADABLE_TIME)
    )
    return shaped.withColumn("reason", reason).drop("data")


def accepted(judged: DataFrame) -> DataFrame:
    """Readings of the messages that gave one with a time."""
    return judged.filter(F.col("reason").isNull()).select(*READINGS_SCHEMA.fieldNames())


def rejected(judged: DataFrame) -> DataFrame:
    """The other messages as they came, with the reason and the ingest's time."""
    return judged.filter(F.col("reason").isNotNull()).select("value", "reason", "create_date", "create_ts")


def with_typed_signals(
    readings: DataFrame, casts: tuple[str, ...] = ("float", "double"), keys: list[str] | None = None
) -> DataFrame:
    """Add typed copies of the signal values (``ActivePower_kW_float`` ...).

    Written once at ingest, they let aggregates scan narrow numeric columns
    instead of reading and parsing the whole text map on every query. Each
    copy is the same ``try_cast`` an aggregate would apply to the map text,
    so results are identical either way; the map itself is kept.
    """
    keys = keys or SIGNAL_KEYS
    return readings.withColumns(
        {typed_column(k, c): signal_value(k, c) for c in casts for k in keys}
    )


def messages_to_readings(
    messages: DataFrame, create_ts: _dt.datetime | None = None, strict: bool = False
) -> DataFrame:
    return shape_readings(parse_messages(messages, strict=strict), create_ts)


def flatten_messages(messages: DataFrame, schema: StructType = GENERIC_MESSAGE_SCHEMA) -> DataFrame:
    """Parse and flatten a simple message into top-level columns."""
    return messages.select(parse_message("value", schema).alias("data")).select("data.*")
