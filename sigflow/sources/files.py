"""CSV readings from a directory, batch or stream.

Columns bind by position under the declared schema, the header line of
every file is dropped, blank lines are skipped and a bad number becomes
null while its row is kept. ``glob`` restricts which files are read: the
original feed read *every* file in its directory, scripts included, which
is how junk rows got in; pass ``glob=None`` to reproduce that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sigflow.schemas import RAW_CSV_SCHEMA


def _csv_options(reader, schema: StructType, glob: str | None, header: bool):
    reader = reader.schema(schema).option("header", header).option("mode", "PERMISSIVE")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType = RAW_CSV_SCHEMA,
    glob: str | None = "*.csv",
    header: bool = True,
) -> DataFrame:
    return _csv_options(spark.read, schema, glob, header).csv(path)


def read_csv_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = RAW_CSV_SCHEMA,
    glob: str | None = "*.csv",
    header: bool = True,
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    reader = _csv_options(spark.readStream, schema, glob, header).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)
