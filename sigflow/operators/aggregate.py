"""Aggregations over the readings table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigflow.functions.banding import generation_band
from sigflow.functions.signals import signal_number
from sigflow.schemas import SIGNAL_KEYS


def distinct_signals_daily(readings: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct event times per day; null times are not counted, and the
    null date is a group of its own.

    The exact plan de-duplicates on ``(signal_date, signal_ts)`` first, so the
    first shuffle is keyed on both columns and one busy day is spread over
    many tasks; the second shuffle carries one partial count per day and task.
    """
    distinct = (
        F.approx_count_distinct("signal_ts") if approx else F.count_distinct("signal_ts")
    )
    return readings.groupBy("signal_date").agg(distinct.alias("distinct_signal_count"))


def date_and_hour(zone: str | None = None) -> tuple[Column, Column]:
    """Date and hour of a reading: as recorded, with the hour in the session
    time zone, or both taken from the time in ``zone`` whatever the session's
    zone is. A reading without a time keeps its recorded date."""
    if zone is None:
        return F.col("signal_date"), F.hour("signal_ts")
    wall = F.convert_timezone(None, F.lit(zone), F.col("signal_ts").cast("timestamp_ntz"))
    return F.coalesce(F.to_date(wall), "signal_date"), F.hour(wall)


def avg_signals_hourly(
    readings: DataFrame, cast: str = "float", keys: list[str] | None = None, zone: str | None = None
) -> DataFrame:
    """Mean of each signal per ``(signal_date, hour)``.

    Values are map text converted with ``try_cast`` to ``cast`` ("float" as in
    the analysis script, "double" as in the notebook), so the two variants
    differ in low digits. A table written with typed copies of the signals
    (:func:`sigflow.operators.shape.with_typed_signals`) is read through them
    instead of the map. Hours are taken in the session time zone unless
    ``zone`` is given, which moves dates and hours together. Partial aggregation runs before the shuffle, so a hot
    hour costs one row per task, not one row per reading.
    """
    keys = keys or SIGNAL_KEYS
    cols = readings.columns
    date, hour = date_and_hour(zone)
    return readings.groupBy(date.alias("signal_date"), hour.alias("hour")).agg(
        *[F.avg(signal_number(cols, k, cast)).alias(f"avg_{k}") for k in keys]
    )


def with_generation_indicator(
    hourly: DataFrame, power_col: str = "avg_ActivePower_kW", out_col: str = "generation_indicator"
) -> DataFrame:
    return hourly.withColumn(out_col, generation_band(power_col))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
