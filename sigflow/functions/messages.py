"""Row <-> message (JSON text) projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def row_to_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Pack the given (default: all) columns into one JSON object string.

    Null fields are left out of the object, as ``to_json`` does.
    """
    cols = columns if columns is not None else df.columns
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]))


def parse_message(value: Column | str, schema: StructType) -> Column:
    """Decode a message value (binary or string) into a struct.

    Malformed text and ``{}`` give a struct of nulls, not null; only a null
    or empty value gives null.
    """
    v = F.col(value) if isinstance(value, str) else value
    return F.from_json(v.cast("string"), schema)
