"""DataFrame -> DataFrame operators."""

from sigflow.operators.aggregate import (
    avg_signals_hourly,
    distinct_signals_daily,
    row_count,
    with_generation_indicator,
)
from sigflow.operators.mapping import mapping_join_long, rename_mapped, signal_mapping
from sigflow.operators.ml import (
    assemble_features,
    drop_invalid_features,
    fit_label_index,
    fit_linear_regression,
    hash_split,
    label_index,
    random_split,
    regression_metrics,
    residual_histogram,
    scatter_bins,
)
from sigflow.operators.quality import dedup_latest, ingest_audit
from sigflow.operators.shape import (
    flatten_messages,
    messages_to_readings,
    pack_messages,
    parse_messages,
    shape_readings,
    with_typed_signals,
)
from sigflow.operators.text import (
    cap_items,
    drop_blank_turns,
    extract_json_array,
    last_user_turn,
    normalise_records,
    route_intent,
    search_key,
    with_fallback,
)

__all__ = [
    "assemble_features", "avg_signals_hourly", "cap_items", "dedup_latest", "distinct_signals_daily",
    "drop_blank_turns", "drop_invalid_features", "extract_json_array", "fit_label_index",
    "fit_linear_regression", "flatten_messages", "hash_split", "ingest_audit", "label_index",
    "last_user_turn", "mapping_join_long", "messages_to_readings", "normalise_records", "pack_messages",
    "parse_messages", "random_split", "regression_metrics", "rename_mapped", "residual_histogram",
    "route_intent", "row_count", "scatter_bins", "search_key", "shape_readings", "signal_mapping",
    "with_fallback", "with_generation_indicator", "with_typed_signals",
]
