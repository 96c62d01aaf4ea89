"""The hourly analysis report over the readings table.

readings -> hourly means -> generation band -> mapping-driven renames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from sigflow.operators.aggregate import avg_signals_hourly, with_generation_indicator
from sigflow.operators.mapping import rename_mapped, signal_mapping


def hourly_indicator(readings: DataFrame, cast: str = "float", zone: str | None = None) -> DataFrame:
    return with_generation_indicator(avg_signals_hourly(readings, cast=cast, zone=zone))


def hourly_report(
    readings: DataFrame, cast: str = "float", mapping: DataFrame | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Hourly means with their band, columns renamed through the mapping."""
    spark = readings.sparkSession
    mapping = mapping if mapping is not None else signal_mapping(spark, view=None)
    return rename_mapped(hourly_indicator(readings, cast=cast, zone=zone), mapping)
