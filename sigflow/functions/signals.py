"""The ``signals`` map: building it and reading typed values out of it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigflow.schemas import SIGNAL_KEYS


def signals_map(values: dict[str, Column]) -> Column:
    """``map<string,string>`` of signal key -> raw text value (nullable)."""
    parts: list[Column] = []
    for key, col in values.items():
        parts += [F.lit(key), col.cast("string")]
    return F.create_map(*parts)


def signal_value(key: str, cast: str | None = None, signals: str = "signals") -> Column:
    """Value of one signal; a missing key is null.

    With ``cast`` the text is converted by ``try_cast`` so non-numeric text
    becomes null instead of failing the job.
    """
    v = F.col(signals).getItem(key)
    return v.try_cast(cast) if cast else v


def flatten_signals(keys: list[str] | None = None, signals: str = "signals") -> list[Column]:
    """One string column per signal key, named by the key."""
    return [F.col(signals).getItem(k).alias(k) for k in (keys or SIGNAL_KEYS)]


def typed_column(key: str, cast: str) -> str:
    """Name of the materialised typed copy of a signal, e.g. ``ActivePower_kW_float``."""
    return f"{key}_{cast}"


def signal_number(df_columns: list[str], key: str, cast: str, signals: str = "signals") -> Column:
    """Numeric value of a signal: the typed copy when the table has one
    (same ``try_cast``, applied at ingest), else parsed from the map."""
    name = typed_column(key, cast)
    return F.col(name) if name in df_columns else signal_value(key, cast, signals)
