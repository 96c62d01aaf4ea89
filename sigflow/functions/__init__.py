"""Column-level building blocks (pure ``Column -> Column`` helpers)."""

from sigflow.functions.banding import generation_band
from sigflow.functions.messages import parse_message, row_to_json
from sigflow.functions.signals import (
    flatten_signals,
    signal_number,
    signal_value,
    signals_map,
    typed_column,
)
from sigflow.functions.text import is_blank, strip_text
from sigflow.functions.timeparse import parse_signal_date, parse_signal_ts

__all__ = [
    "flatten_signals",
    "generation_band",
    "is_blank",
    "parse_message",
    "parse_signal_date",
    "parse_signal_ts",
    "row_to_json",
    "signal_number",
    "signal_value",
    "signals_map",
    "strip_text",
    "typed_column",
]
